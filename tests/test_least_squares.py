"""Bounded least squares against answers that are known or found by search over the faces of the box."""

import itertools

import numpy as np
import pytest

from fathomline.operators.least_squares import minimise


def of(residuals, slopes):
    """The sums that minimise() asks for, of plain functions."""

    def sums(x):
        m = np.column_stack([residuals(x), slopes(x)])
        return m.T @ m

    return sums


def linear(a, y):
    return of(lambda x: a @ x - y, lambda x: a)


@pytest.mark.parametrize("seed", range(20))
def test_linear_fits_in_a_box(seed):
    """The best point of a box has some parameters at bounds and the rest free: each choice of those is solved."""
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 5))
    a, y = rng.normal(size=(40, n)) * 10.0 ** rng.integers(-3, 4, n), rng.normal(size=40)
    size = 1 / np.abs(a).max(0)
    low, high = -rng.uniform(0.01, 0.3, n) * size, rng.uniform(0.01, 0.3, n) * size
    best = np.inf
    for where in itertools.product((None, 0, 1), repeat=n):
        x = np.array([0.0 if w is None else (low, high)[w][i] for i, w in enumerate(where)])
        free = [i for i, w in enumerate(where) if w is None]
        if free:
            x[free] = np.linalg.lstsq(a[:, free], y - a @ x, rcond=None)[0]
        if (x >= low - 1e-12 * size).all() and (x <= high + 1e-12 * size).all():
            best = min(best, float(((a @ x - y) ** 2).sum()) / 2)
    got = minimise(linear(a, y), np.zeros(n), low, high, 40)
    assert got.cost <= best * (1 + 1e-7) and (got.x >= low).all() and (got.x <= high).all()


def test_rosenbrock():
    """The valley's end free, and known ends of it on a bound."""
    sums = of(lambda x: np.array([10 * (x[1] - x[0] ** 2), 1 - x[0]]), lambda x: np.array([[-20 * x[0], 10.0], [-1.0, 0.0]]))
    free = minimise(sums, [-1.2, 1.0], [-np.inf] * 2, [np.inf] * 2, 2, rounds=300)
    assert np.allclose(free.x, [1, 1], atol=1e-6) and not free.bound.any()
    for low, high, want in (([-2, -2], [0.5, 2], [0.5, 0.25]), ([-2, 1.5], [2, 3], [1.2244, 1.5]), ([-2, -2], [2, 0.2], [0.4556, 0.2])):
        got = minimise(sums, [1.0, 1.6] if low[1] > 0 else [-1.0, 0.1], low, high, 2, rounds=300)
        assert np.allclose(got.x, want, atol=2e-3), (got.x, want)
        assert got.bound.sum() == 1


def test_covariance_is_that_of_linear_theory():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(5000, 3)) * [1, 100, 0.01]
    truth = np.array([0.3, 0.002, -20.0])
    y = a @ truth + rng.normal(0, 0.5, 5000)
    got = minimise(linear(a, y), np.zeros(3), [-1, -1, -100], [1, 1, 100], 5000)
    r = a @ got.x - y
    assert np.allclose(got.covariance, np.linalg.inv(a.T @ a) * (r @ r) / (5000 - 3), rtol=1e-6)
    assert (np.abs(got.x - truth) < 5 * np.sqrt(np.diag(got.covariance))).all()
    held = minimise(linear(a, y), np.zeros(3), [-1, -1, -10], [1, 1, 100], 5000)
    assert held.bound.tolist() == [False, False, True] and np.isnan(held.covariance[2]).all() and np.isfinite(held.covariance[:2, :2]).all()
