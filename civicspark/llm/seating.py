"""Exact conditional draws for a Pitman-Yor restaurant: how many tables the customers of a dish sit at.

The seatings of ``n`` customers at ``t`` tables weigh ``S(n, t)``, the
generalised Stirling number of the discount (``S(n + 1, t) = S(n, t - 1) +
(n - discount t) S(n, t)``); every table adds its dish's base probability and
a factor ``strength + discount * (tables before it)``. The product of these
factors is a Gamma integral, so with an auxiliary Gamma variable ``x`` of shape
``strength / discount + tables`` per restaurant the dishes are independent:

    P(t) is proportional to weight**t * S(n, t),  weight = discount * x * base

Drawing ``x`` given all tables and then every dish's tables given ``x`` is a
Gibbs sampler of the restaurant's own law; no dish's earlier tables take part
in its own new draw but through ``x``.

``S`` is tabled to ``TABLED`` customers. Beyond, it is the coefficient of
``z**n`` in ``(1 - (1 - z)**discount)**t``: few tables by the binomial series,
many by a contour integral or its saddle point, normalised over eight standard
deviations around the mode (less than a hundredth off in total variation, see
the tests).

Random numbers are hashes of a key, so that a task that runs again, or another
one that meets the same dish, draws the same.
"""

from __future__ import annotations

from functools import lru_cache
from math import gamma, lgamma, log, pi, sin

import numpy as np

from civicspark.llm.common import mix64

#: Customers up to which Stirling numbers are tabled.
TABLED = 512
#: Expected tables up to which the binomial series is used, and the tables and terms it has.
FEW, SERIES_TABLES, SERIES_TERMS = 40, 96, 64
#: Tables up to which the law's terms are multiplied up, not added as logarithms.
PRODUCTS = 64
#: Points at which the law of many tables is computed, cells it is interpolated to, and nodes of a contour.
POINTS, GRID, NODES = 17, 96, 32
#: Customers times distance of the saddle point from the cut, below which the contour is used.
CUT = 12.0
#: Numbers in a matrix worked on at a time.
_CELLS = 1 << 20


def uniform(key: np.ndarray, seed: int, n: int) -> np.ndarray:
    """Uniform numbers from hashes of ``(key, seed, n)``."""
    return (mix64(key ^ np.uint64((seed * 0x9E3779B97F4A7C15 + n * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1)) >> np.uint64(11)) * 2.0**-53


def gammas(key: np.ndarray, shape: np.ndarray, seed: int) -> np.ndarray:
    """Gamma numbers of the shapes (0 for shape 0), by squeezed cubes of normal ones."""
    shape = np.asarray(shape, dtype=np.float64)
    out = np.zeros(len(shape))
    raised = np.where(shape < 1, shape + 1, shape) - 1 / 3
    left, n = np.flatnonzero(shape > 0), 100
    while len(left):
        k, d = key[left], raised[left]
        u, v, w = (np.maximum(uniform(k, seed, n + j), 1e-300) for j in range(3))
        z = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
        cube = (1 + z / np.sqrt(9 * d)) ** 3
        with np.errstate(invalid="ignore", divide="ignore"):
            fits = (cube > 0) & (np.log(w) < 0.5 * z * z + d - d * cube + d * np.log(cube))
        out[left[fits]] = (d * cube)[fits]
        left, n = left[~fits], n + 3
    small = np.flatnonzero((shape > 0) & (shape < 1))
    out[small] *= np.maximum(uniform(key[small], seed, 99), 1e-300) ** (1 / shape[small])
    return out


@lru_cache(maxsize=4)
def log_stirling(discount: float, top: int = TABLED) -> np.ndarray:
    """``[n, t]``: logarithms of the generalised Stirling numbers; -inf where there are none."""
    table = np.full((top + 1, top + 2), -np.inf)
    table[1, 1] = 0.0
    t = np.arange(top + 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in range(1, top):
            stay = np.log(np.maximum(n - discount * t, 0)) + table[n]
            table[n + 1] = np.logaddexp(np.concatenate([[-np.inf], table[n, :-1]]), stay)
    return table


@lru_cache(maxsize=4)
def _series(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the binomial series: the coefficient of each term and number of tables, and what a table adds to the logarithm."""
    t = np.arange(1, SERIES_TABLES + 1)
    rows = []
    for j in range(1, SERIES_TERMS + 1):
        choose = np.array([np.exp(lgamma(k + 1) - lgamma(j + 1) - lgamma(k - j + 1)) if k >= j else 0.0 for k in t])
        s = discount * j
        inverse = -gamma(s + 1) * sin(pi * s) / pi  # 1 / Gamma(-s)
        rows.append((-1) ** j * choose * inverse)
    return np.array(rows), np.array([-k * log(discount) - lgamma(k + 1) for k in t])


def _pick(logs: np.ndarray, u: np.ndarray) -> np.ndarray:
    """For each row of logarithms of weights, the column that its uniform number falls in."""
    logs -= logs.max(1, keepdims=True)
    cum = np.cumsum(np.exp(logs, out=logs), axis=1)
    return np.minimum((cum < (u * cum[:, -1])[:, None]).sum(1), logs.shape[1] - 1)


def _few(weight: np.ndarray, n: np.ndarray, u: np.ndarray, discount: float) -> np.ndarray:
    """Many customers at few tables: the binomial series."""
    coefficient, per_table = _series(discount)
    j = np.arange(1, SERIES_TERMS + 1)
    # Gamma(n - dj) / Gamma(n - d), by products of ratios whose logarithm is expanded: n is large.
    ratio = np.exp(_log_gamma(n[:, None] - discount * j) - _log_gamma(n - discount)[:, None])
    sums = np.maximum(ratio @ coefficient, 1e-300)
    return 1 + _pick(np.log(sums) + per_table + np.log(weight)[:, None] * np.arange(1, SERIES_TABLES + 1), u)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of Gamma by Stirling's series, for arguments of some hundreds."""
    return (x - 0.5) * np.log(x) - x + 1 / (12 * x) - 1 / (360 * x**3)


def _root(n: np.ndarray, a: np.ndarray, discount: float) -> np.ndarray:
    """y in (0, 1) with ``n y**(1 - discount) = a (1 - y)``, by halving."""
    low, high = np.zeros(len(n)), np.ones(len(n))
    for _ in range(60):
        y = 0.5 * (low + high)
        more = n * y ** (1 - discount) < a * (1 - y)
        low, high = np.where(more, y, low), np.where(more, high, y)
    return np.maximum(0.5 * (low + high), 1e-18)


def _mean_size(y: np.ndarray, discount: float) -> np.ndarray:
    return (1 - y) * discount * y ** (discount - 1) / -np.expm1(discount * np.log(y))


@lru_cache(maxsize=1)
def _interpolation() -> tuple[np.ndarray, np.ndarray]:
    """Chebyshev points of [0, 1], and the matrix from values there to values on an even grid."""
    x = 0.5 - 0.5 * np.cos(np.pi * np.arange(POINTS) / (POINTS - 1))
    sign = (-1.0) ** np.arange(POINTS)
    sign[[0, -1]] /= 2
    grid = (np.arange(GRID) + 0.5) / GRID
    apart = grid[:, None] - x
    apart = np.where(apart == 0, 1e-300, apart)
    return x, (sign / apart) / (sign / apart).sum(1, keepdims=True)


def _saddle(n: np.ndarray, t: np.ndarray, y: np.ndarray, discount: float) -> np.ndarray:
    """Logarithm of the coefficient of ``z**n`` in ``(1 - (1 - z)**discount)**t`` at the saddle point."""
    want, at = np.log(n[:, None] / t), np.repeat(np.log(y)[:, None], t.shape[1], axis=1)
    for _ in range(12):  # y = 1 - z with mean size n / t, from the mode's by Newton steps of its logarithm
        here = np.exp(at)
        slope = -(here / (1 - here)) + discount - 1 + discount * np.exp(discount * at) / -np.expm1(discount * at)
        at = np.clip(at - np.clip((np.log(_mean_size(here, discount)) - want) / slope, -2, 2), -40, -1e-12)
    here = np.exp(at)
    size = _mean_size(here, discount)
    var = np.maximum(size * (1 + (1 - here) * (1 - discount) / here - size), 1e-12)
    return t * np.log(-np.expm1(discount * at)) - n[:, None] * np.log1p(-here) - 0.5 * np.log(t * var)


def _contour(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """The same by the midpoint rule on a parabola around the cut, where the saddle point lies too near to it."""
    theta = np.pi * (2 * np.arange(NODES // 2) + 1) / NODES  # the other half are conjugates
    place = NODES * (0.1309 - 0.1194 * theta**2 + 0.25j * theta)
    slope = NODES * (-0.2388 * theta + 0.25j)
    base = np.log(1 - (-np.expm1(-place / n[:, None])) ** discount)
    power = t[:, :, None] * base[:, None] + place + np.log(-1j * slope)
    top = power.real.max(-1, keepdims=True)
    return top[..., 0] + np.log(np.maximum(np.exp(power - top).sum(-1).real, 1e-300))


def _many(weight: np.ndarray, n: np.ndarray, y: np.ndarray, u: np.ndarray, discount: float) -> np.ndarray:
    """Many customers at many tables: the law's logarithm at a few points within eight standard deviations, interpolated."""
    mode = weight / discount * -np.expm1(discount * np.log(y))
    mean = n / mode
    spread = mean * (1 + (1 - y) * (1 - discount) / y - mean)
    sd = np.sqrt(np.maximum(mode * spread / (spread + mean * mean), 0.25))
    low, high = np.maximum(mode - 8 * sd, 1), np.minimum(mode + 8 * sd, n * (1 - 1e-9))
    points, matrix = _interpolation()
    t = low[:, None] + (high - low)[:, None] * points
    logs, near = np.empty(t.shape), n * y < CUT
    if near.any():
        logs[near] = _contour(n[near], t[near], discount)
    if not near.all():
        logs[~near] = _saddle(n[~near], t[~near], y[~near], discount)
    logs += t * np.log(weight / discount)[:, None] - _log_gamma(t + 1)
    logs -= logs.max(1, keepdims=True)
    mass = np.exp(np.minimum(np.maximum(logs, -200) @ matrix.T, 1.0))
    cum = np.cumsum(mass, axis=1)
    goal, rows = u * cum[:, -1], np.arange(len(n))
    k = np.minimum((cum < goal[:, None]).sum(1), GRID - 1)
    part = (goal - (cum[rows, k] - mass[rows, k])) / np.maximum(mass[rows, k], 1e-300)  # where in the cell
    return np.clip(np.rint(low + (high - low) * (k + np.clip(part, 0, 1)) / GRID), 1, n)


@lru_cache(maxsize=4)
def _shares(discount: float) -> np.ndarray:
    """``[t - 1, n]``: Stirling numbers over that of one table, to ``PRODUCTS`` tables."""
    logs = log_stirling(discount)[:, 1 : PRODUCTS + 1]
    with np.errstate(invalid="ignore"):
        return np.ascontiguousarray(np.nan_to_num(np.exp(logs - logs[:, :1]), nan=0.0).T)


def _by_products(weight: np.ndarray, n: np.ndarray, u: np.ndarray, discount: float, width: int) -> np.ndarray:
    """Few tables of tabled numbers of customers: the law's terms are multiplied up, and summed up table by table."""
    shares = _shares(discount)
    sums, power = np.empty((width, len(n))), np.ones(len(n))
    sums[0] = shares[0][n]
    for t in range(1, width):
        power *= weight
        np.multiply(power, shares[t][n], out=sums[t])
        sums[t] += sums[t - 1]
    goal, out = u * sums[-1], np.ones(len(n))
    for total in sums:
        out += total < goal
    return np.minimum(out, n)


def seat(key: np.ndarray, customers: np.ndarray, weight: np.ndarray, discount: float, seed: int) -> np.ndarray:
    """Tables of each dish, drawn with probability proportional to ``weight**t * S(customers, t)``."""
    tables = (customers > 0).astype(np.float64)
    open_ = np.flatnonzero(customers > 1)
    n, u, a = customers[open_], uniform(key[open_], seed, 0), np.maximum(weight[open_], 1e-300)
    # S(n, t + 1) <= S(n, t) / (discount t), so tables but one are no more than Poisson numbers: beyond this bound lies less than 1e-9 of it.
    few = a / discount
    bound = np.minimum(n, np.ceil(few + 8 * np.sqrt(few)) + 3)
    out = np.empty(len(n))
    small = n <= TABLED
    pairs = n == 2  # the commonest: two tables at most
    out[pairs] = _by_products(a[pairs], n[pairs], u[pairs], discount, 2)
    width, left = 4, small & ~pairs
    while left.any():
        chosen = np.flatnonzero(left & (bound <= width))
        left &= bound > width
        step = max(1, _CELLS // width)
        for at in range(0, len(chosen), step):
            part = chosen[at : at + step]
            if width <= PRODUCTS:
                out[part] = _by_products(a[part], n[part], u[part], discount, width)
            else:
                logs = log_stirling(discount)[n[part], 1 : width + 1]
                out[part] = 1 + _pick(np.log(a[part])[:, None] * np.arange(1, width + 1) + logs, u[part])
        width *= 2
    rest = np.flatnonzero(~small)
    if len(rest):
        y = _root(n[rest].astype(np.float64), a[rest], discount)
        fits = a[rest] / discount * -np.expm1(discount * np.log(y)) <= FEW
        for chosen, at_y, draw in ((rest[fits], (), _few), (rest[~fits], (y[~fits],), _many)):
            for at in range(0, len(chosen), 4096):
                part = chosen[at : at + 4096]
                out[part] = draw(a[part], n[part].astype(np.float64), *(v[at : at + 4096] for v in at_y), u[part], discount)
    tables[open_] = out
    return tables
