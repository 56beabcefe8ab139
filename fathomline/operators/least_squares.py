"""Bounded least squares from sums of products: a trust region whose scaling and steps keep off the bounds.

After Branch, Coleman and Li (1999). The caller sums products of residuals and slopes over all rows, wherever those are;
nothing here grows with their number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np


@dataclass
class Solution:
    """x; half the sum of squares there; which parameters are at a bound; covariance (nan at bounds); rounds taken."""

    x: np.ndarray
    cost: float
    bound: np.ndarray
    covariance: np.ndarray
    rounds: int


def _inside_radius(h: np.ndarray, g: np.ndarray, radius: float) -> np.ndarray:
    """The lowest point of the quadratic g.p + p.h.p / 2 within the radius, for h without negative curvature."""
    values, vectors = np.linalg.eigh(h)
    values, part = np.maximum(values, 0.0), vectors.T @ g
    length = lambda shift: np.linalg.norm(part / np.maximum(values + shift, 1e-300))
    low, high = 0.0, np.linalg.norm(g) / radius
    if length(0.0) <= radius:
        high = 0.0
    else:
        for _ in range(200):  # the length falls as the shift rises
            middle = (low + high) / 2
            low, high = (middle, high) if length(middle) > radius else (low, middle)
    return -vectors @ (part / np.maximum(values + high, 1e-300))


def _to_bounds(x: np.ndarray, step: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[float, np.ndarray]:
    """How many steps lead to the first bound, and which parameters reach it there."""
    with np.errstate(divide="ignore", invalid="ignore"):
        each = np.where(step > 0, (high - x) / step, np.where(step < 0, (low - x) / step, np.inf))
    first = each.min()
    return max(float(first), 0.0), each <= first


def _to_radius(start: np.ndarray, along: np.ndarray, radius: float) -> float:
    """How far along a direction the sphere is."""
    a, b, c = along @ along, start @ along, start @ start - radius * radius
    return (-b + np.sqrt(max(b * b - a * c, 0.0))) / a if a > 0 else 0.0


def _lowest(h: np.ndarray, g: np.ndarray, start: np.ndarray, along: np.ndarray, near: float, far: float) -> np.ndarray:
    """The lowest point of the quadratic on a part of a line."""
    curve, slope = along @ h @ along, along @ (g + h @ start)
    places = [near, far] + ([-slope / curve] if curve > 0 and near < -slope / curve < far else [])
    value = lambda t: slope * t + curve * t * t / 2
    return start + min(places, key=value) * along


def minimise(sums: Callable[[np.ndarray], np.ndarray], x: np.ndarray, low: np.ndarray, high: np.ndarray, rows: int, rounds: int = 100, gradient: float = 1e-10, change: float = 1e-12) -> Solution:
    """Parameters within bounds for which the squares of the residuals sum up to least.

    sums(x) gives the matrix of summed products of (residual, slopes by each parameter), from one pass over the rows, one
    for each step that is tried. Parameters are scaled by the steepness of the slopes. Each is scaled once more by its distance to the
    bound that the gradient points to, so that steps bend along bounds; a step that hits one is compared with its
    reflection and with the steepest way down. rows: their number, for the covariance.
    """
    low, high = np.asarray(low, float), np.asarray(high, float)
    room = np.where(np.isfinite(high - low), high - low, 1.0)
    x = np.clip(np.asarray(x, float), low + 1e-10 * room, high - 1e-10 * room)
    steep, radius, products = np.zeros(len(x)), None, np.asarray(sums(x), float)
    taken, first = 0, products[0, 0] / 2
    for taken in range(1, rounds + 1):
        cost, g, b = products[0, 0] / 2, products[1:, 0], products[1:, 1:]
        steep = np.maximum(steep, np.sqrt(np.maximum(np.diag(b), 0)))
        scale = 1 / np.where(steep > 0, steep, 1.0)
        toward = np.where(g < 0, high - x, x - low)
        bounded = np.isfinite(toward)
        if np.abs(g * np.where(bounded, toward, 1.0)).max(initial=0) < gradient * max(cost, 1e-300) ** 0.5:
            break
        d = scale * np.sqrt(np.where(bounded, toward / scale, 1.0))
        gh, h = d * g, b * np.outer(d, d) + np.diag(np.where(bounded, np.abs(g) * scale, 0.0))
        radius = radius if radius is not None else max(np.linalg.norm(x / d), 1.0)
        moved = False
        for _ in range(60):
            p = _inside_radius(h, gh, radius)
            reach, hit = _to_bounds(x, d * p, low, high)
            if reach <= 1:
                keep = max(0.995, 1 - np.abs(g * toward).max(where=bounded, initial=0))
                back = np.where(hit, -p, p)
                start = reach * p
                far = min(_to_radius(start, back, radius), _to_bounds(x + d * start, d * back, low, high)[0])
                down = min(_to_radius(0 * p, -gh, radius), _to_bounds(x, -d * gh, low, high)[0])
                choices = [keep * start, _lowest(h, gh, 0 * p, -gh, 0.0, keep * down)]
                if far > 0:
                    choices.append(_lowest(h, gh, start, back, (1 - keep) * far, keep * far))
                p = min(choices, key=lambda q: gh @ q + q @ h @ q / 2)
            step = d * p
            expected = -(gh @ p + p @ h @ p / 2)
            trial = np.clip(x + step, np.nextafter(low, high), np.nextafter(high, low))
            tried = np.asarray(sums(trial), float)
            gained = cost - tried[0, 0] / 2 if np.isfinite(tried).all() else -np.inf
            length = np.linalg.norm(p)
            if gained < 0.25 * expected:
                radius = 0.25 * length
            elif gained > 0.75 * expected and length > 0.95 * radius:
                radius *= 2
            if gained > 0:
                moved = True
                break
            if length < 1e-14 * max(np.linalg.norm(x / d), 1e-300) or expected <= change * cost:
                break
        if not moved:
            break
        small = np.linalg.norm(step / scale) < 1e-10 * np.linalg.norm(x / scale)
        x, products = trial, tried
        if gained <= change * cost or small or products[0, 0] / 2 <= change**1.25 * first:
            break
    cost = products[0, 0] / 2
    bound = (x - low <= 1e-6 * room) | (high - x <= 1e-6 * room)
    covariance = np.full((len(x), len(x)), np.nan)
    free = np.flatnonzero(~bound)
    if len(free) and rows > len(free):
        covariance[np.ix_(free, free)] = np.linalg.pinv(products[1:, 1:][np.ix_(free, free)]) * 2 * cost / (rows - len(free))
    return Solution(x, float(cost), bound, covariance, taken)
