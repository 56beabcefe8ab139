"""Properties of seawater as column expressions.

Practical salinity: PSS-78. Specific volume and what follows from it: the 75-term polynomial of Roquet et al. (2015)
for TEOS-10. Potential temperature: Bryden's (1973) lapse rate by Fofonoff's fourth-order step (UNESCO 1983), to about
0.001 degrees. Conservative Temperature: TEOS-10's potential enthalpy at the surface. Depth: TEOS-10 with the specific
volume of standard seawater at 0 degrees. Absolute Salinity is the reference-composition one: the regional anomaly is a
data file that is not here, so values of the open ocean are too low by up to about 0.03 g/kg.

All results are null where an input is null.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed values of PSS-78 (UNESCO 1983).
_A = (0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081)
_B = (0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144)
_C = (0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9)
_D = (3.426e-2, 4.464e-4, 4.215e-1, -3.107e-3)
_E = (2.070e-5, -6.370e-10, 3.989e-15)
_K, _STANDARD = 0.0162, 42.9140

# Fixed values of Roquet et al. (2015): coefficients of (salinity root)^i (temperature)^j (pressure)^k, rows (i, j), k from 0.
_VOLUME = {
    (0, 0): (1.0769995862e-3, -6.0799143809e-5, 9.9856169219e-6, -1.1309361437e-6, 1.0531153080e-7, -1.2647261286e-8, 1.9613503930e-9),
    (0, 1): (-1.5649734675e-5, 1.8505765429e-5, -1.1736386731e-6, -3.6527006553e-7, 3.1454099902e-7),
    (0, 2): (2.7762106484e-5, -1.1716606853e-5, 2.1305028740e-6, 2.8695905159e-7),
    (0, 3): (-1.6521159259e-5, 7.9279656173e-6, -4.6132540037e-7),
    (0, 4): (6.9111322702e-6, -3.4102187482e-6, -6.3352916514e-8),
    (0, 5): (-8.0539615540e-7, 5.0736766814e-7),
    (0, 6): (2.0543094268e-7,),
    (1, 0): (-3.1038981976e-4, 2.4262468747e-5, -5.8484432984e-7, 3.6310188515e-7, -1.1147125423e-7),
    (1, 1): (3.5009599764e-5, -9.5677088156e-6, -5.5699154557e-6, -2.7295696237e-7),
    (1, 2): (-3.7435842344e-5, -2.3678308361e-7, 3.9137387080e-7),
    (1, 3): (2.4141479483e-5, -3.4558773655e-6, 7.7618888092e-9),
    (1, 4): (-8.7595873154e-6, 1.2956717783e-6),
    (1, 5): (-3.3052758900e-7,),
    (2, 0): (6.6928067038e-4, -3.4792460974e-5, -4.8122251597e-6, 1.6746303780e-8),
    (2, 1): (-4.3592678561e-5, 1.1100834765e-5, 5.4620748834e-6),
    (2, 2): (3.5907822760e-5, 2.9283346295e-6, -6.5731104067e-7),
    (2, 3): (-1.4353633048e-5, 3.1655306078e-7),
    (2, 4): (4.3703680598e-6,),
    (3, 0): (-8.5047933937e-4, 3.7470777305e-5, 4.9263106998e-6),
    (3, 1): (3.4532461828e-5, -9.8447117844e-6, -1.3544185627e-6),
    (3, 2): (-1.8698584187e-5, -4.8826139200e-7),
    (3, 3): (2.2863324556e-6,),
    (4, 0): (5.8086069943e-4, -1.7322218612e-5, -1.7811974727e-6),
    (4, 1): (-1.1959409788e-5, 2.5909225260e-6),
    (4, 2): (3.8595339244e-6,),
    (5, 0): (-2.1092370507e-4, 3.0927427253e-6),
    (5, 1): (1.3864594581e-6,),
    (6, 0): (3.1932457305e-5,),
}
_SALT, _OFFSET = 0.0248826675584615, 24 * 0.0248826675584615

# Fixed values of TEOS-10: potential enthalpy at 0 dbar, rows of powers of the salinity root, columns of temperature / 40.
_ENTHALPY = {
    0: (61.01362420681071, 168776.46138048015, -2735.2785605119625, 2574.2164453821433, -1536.6644434977543, 545.7340497931629, -50.91091728474331, -18.30489878927802),
    2: (268.5520265845071, -12019.028203559312, 3734.858026725145, -2046.7671145057618, 465.28655623826234, -0.6370820302376359, -10.650848542359153),
    3: (937.2099110620707, 588.1802812170108, 248.39476522971285, -3.871557904936333, -2.6268019854268356),
    4: (-1687.914374187449, 936.3206544460336, -942.7827304544439, 369.4389437509002, -33.83664947895248, -9.987880382780322),
    5: (246.9598888781377,),
    6: (123.59576582457964,),
    7: (-48.5891069025409,),
}
_HEAT = 3991.86795711963
# Fixed values of TEOS-10: enthalpy of standard seawater at 0 degrees by powers of pressure / 1e4 dbar, from the first on.
_SURFACE = (9.726613854843870e-4, -2.252956605630465e-5, 2.376909655387404e-6, -1.664294869986011e-7, -5.988108894465758e-9, -2.1078768810e-9, 2.8019291329e-10)


def _poly(x: Column, terms) -> Column:
    """terms[0] + terms[1] x + ..., nested."""
    out = terms[-1] if isinstance(terms[-1], Column) else F.lit(float(terms[-1]))
    for t in reversed(terms[:-1]):
        out = out * x + t
    return out


def practical_salinity(conductivity: Column, temperature: Column, pressure: Column) -> Column:
    """From conductivity (mS/cm), temperature (degrees of ITS-90) and pressure (dbar)."""
    t = temperature * 1.00024
    r = conductivity / _STANDARD
    rp = 1 + pressure * _poly(pressure, _E) / (1 + _D[0] * t + _D[1] * t * t + (_D[2] + _D[3] * t) * r)
    ratio = r / (rp * _poly(t, _C))
    root = F.sqrt(F.when(ratio >= 0, ratio))
    return _poly(root, _A) + (t - 15) / (1 + _K * (t - 15)) * _poly(root, _B)


def absolute_salinity(practical: Column) -> Column:
    return practical * (35.16504 / 35)


def _lapse(s, t, p):
    # Fixed values of Bryden (1973).
    ds = s - 35
    return (
        (((-2.1687e-16 * t + 1.8676e-14) * t - 4.6206e-13) * p + ((2.7759e-12 * t - 1.1351e-10) * ds + ((-5.4481e-14 * t + 8.733e-12) * t - 6.7795e-10) * t + 1.8741e-8)) * p
        + (-4.2393e-8 * t + 1.8932e-6) * ds
        + ((6.6228e-10 * t - 6.836e-8) * t + 8.5258e-6) * t
        + 3.5803e-5
    )


@F.pandas_udf(DoubleType())
def _without_heat(s: pd.Series, t: pd.Series, p: pd.Series) -> pd.Series:
    # each step uses the temperature of the one before several times, so one expression would grow by powers
    h, r = -p, math.sqrt(2)
    q = x = h * _lapse(s, t, p)
    t, p = t + 0.5 * x, p + 0.5 * h
    x = h * _lapse(s, t, p)
    t = t + (1 - 1 / r) * (x - q)
    q = (2 - r) * x + (-2 + 3 / r) * q
    x = h * _lapse(s, t, p)
    t = t + (1 + 1 / r) * (x - q)
    q = (2 + r) * x + (-2 - 3 / r) * q
    return t + (h * _lapse(s, t, p + 0.5 * h) - 2 * q) / 6


def potential_temperature(practical: Column, temperature: Column, pressure: Column) -> Column:
    """Temperature after moving without heat to 0 dbar."""
    known = practical.isNotNull() & temperature.isNotNull() & pressure.isNotNull()
    return F.when(known, _without_heat(practical, temperature, pressure))


def conservative_from_potential(sa: Column, potential: Column) -> Column:
    x2 = _SALT * F.greatest(sa, F.lit(0.0))
    x, y = F.sqrt(x2), potential * 0.025
    rows = [_poly(y, _ENTHALPY[i]) if i in _ENTHALPY else F.lit(0.0) for i in range(8)]
    return _poly(x, rows) / _HEAT


def conservative_temperature(sa: Column, temperature: Column, pressure: Column) -> Column:
    return conservative_from_potential(sa, potential_temperature(sa * (35 / 35.16504), temperature, pressure))


def _volume(sa: Column, ct: Column, p: Column, by: str = "") -> Column:
    """Specific volume, or its derivative by z (pressure / 1e4), y (temperature / 40) or x (root of scaled salinity)."""
    x, y, z = F.sqrt(_SALT * F.greatest(sa, F.lit(0.0)) + _OFFSET), ct * 0.025, p * 1e-4
    derived = lambda c: tuple(k * v for k, v in enumerate(c))[1:] or (0.0,)
    grid = {}
    for (i, j), c in _VOLUME.items():
        grid.setdefault(i, {})[j] = _poly(z, derived(c)) if by == "z" else _poly(z, c)
    rows = []
    for i in range(7):
        terms = [grid[i][j] for j in sorted(grid[i])]
        if by == "y":
            terms = [j * terms[j] for j in range(1, len(terms))] or [F.lit(0.0)]
        rows.append(_poly(y, terms))
    if by == "x":
        rows = [i * rows[i] for i in range(1, 7)]
    return _poly(x, rows)


def density(sa: Column, ct: Column, pressure: Column) -> Column:
    return 1 / _volume(sa, ct, pressure)


def sound_speed(sa: Column, ct: Column, pressure: Column) -> Column:
    v = _volume(sa, ct, pressure)
    return 1e4 * F.sqrt(-v * v / _volume(sa, ct, pressure, "z"))


def thermal_expansion(sa: Column, ct: Column, pressure: Column) -> Column:
    return 0.025 * _volume(sa, ct, pressure, "y") / _volume(sa, ct, pressure)


def haline_contraction(sa: Column, ct: Column, pressure: Column) -> Column:
    x = F.sqrt(_SALT * F.greatest(sa, F.lit(0.0)) + _OFFSET)
    return -0.5 * _SALT / x * _volume(sa, ct, pressure, "x") / _volume(sa, ct, pressure)


def gravity(latitude: Column, pressure: Column) -> Column:
    s2 = F.pow(F.sin(F.radians(latitude)), 2)
    return 9.780327 * (1 + (5.2792e-3 + 2.32e-5 * s2) * s2) * (1 - 2.26e-7 * height(pressure, latitude))


def height(pressure: Column, latitude: Column) -> Column:
    """Height z in metres, negative below the surface."""
    s2 = F.pow(F.sin(F.radians(latitude)), 2)
    b = 9.780327 * (1 + (5.2792e-3 + 2.32e-5 * s2) * s2)
    z = pressure * 1e-4
    c = z * _poly(z, _SURFACE) * 1e8
    return -2 * c / (b + F.sqrt(b * b + 2 * 2.26e-7 * b * c))


def buoyancy_frequency(sa0: Column, ct0: Column, p0: Column, sa1: Column, ct1: Column, p1: Column, latitude: Column) -> Column:
    """N squared between two samples; null at equal pressures."""
    s, t, p = (sa0 + sa1) / 2, (ct0 + ct1) / 2, (p0 + p1) / 2
    dp = F.when(p1 != p0, p1 - p0)
    g = gravity(latitude, p)
    return g * g / (_volume(s, t, p) * 1e4 * dp) * (haline_contraction(s, t, p) * (sa1 - sa0) - thermal_expansion(s, t, p) * (ct1 - ct0))
