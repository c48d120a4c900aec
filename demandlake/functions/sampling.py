"""Random draws that depend only on a seed and a row's own keys.

A retried task, another partitioning or another batch size therefore gives the same data.
Uniform and normal draws are JVM expressions. Poisson and binomial counts are found from a
uniform draw by walking outwards from the mode, for a whole Arrow batch at a time.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors get these few functions with the plan and need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SMALLEST = 1e-300
_DONE = 1e-18


def uniform(seed: int, *keys: Column | str) -> Column:
    """A number in (0, 1) determined by the seed and the keys."""
    mixed = F.xxhash64(F.lit(seed), *[F.col(k) if isinstance(k, str) else k for k in keys])
    # the upper 53 bits, moved off zero by half a unit
    return (F.shiftrightunsigned(mixed, 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)


def normal(mean: Column, deviation: Column, seed: int, *keys: Column | str) -> Column:
    """A normal draw made from two uniform ones."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(seed, *keys, F.lit("radius"))))
    angle = F.lit(2 * math.pi) * uniform(seed, *keys, F.lit("angle"))
    return mean + deviation * radius * F.cos(angle)


_SMALL_LOG_FACTORIALS = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1.0, 256.0)))])


def _log_factorial(k: np.ndarray) -> np.ndarray:
    """Summed up to 255, Stirling's series beyond, where its next term is below 1e-15."""
    x = np.maximum(k, 1.0)
    series = x * np.log(x) - x + 0.5 * np.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(k < 256, _SMALL_LOG_FACTORIALS[np.minimum(k, 255).astype(int)], series)


def _counts(draw: Callable[..., np.ndarray], u: pd.Series, *parameters: pd.Series) -> pd.Series:
    """Draws as nullable counts: a null or NaN parameter has no count."""
    values = [p.to_numpy(float, na_value=np.nan) for p in parameters]
    unknown = np.isnan(np.stack(values)).any(axis=0)
    drawn = draw(u.to_numpy(float), *[np.where(unknown, 0.0, v) for v in values])
    return pd.Series(pd.array(drawn, "Int64")).mask(unknown)


def _walk_from_mode(
    u: np.ndarray,
    mode: np.ndarray,
    mode_probability: np.ndarray,
    up: Callable[[np.ndarray, np.ndarray], np.ndarray],
    down: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> np.ndarray:
    """Counts whose probabilities, taken in the order mode, mode+1, mode-1, ..., cover ``u``.

    ``up(rows, k)`` is p(k)/p(k-1) and ``down(rows, k)`` is p(k)/p(k+1). Takes a few
    standard deviations of steps, each for all rows still open.
    """
    result = mode.copy()
    rows = np.flatnonzero(u >= mode_probability)
    rest = u[rows] - mode_probability[rows]
    above, below = mode[rows].copy(), mode[rows].copy()
    p_above, p_below = mode_probability[rows].copy(), mode_probability[rows].copy()
    while rows.size:
        above += 1
        p_above = p_above * up(rows, above)
        hit = rest < p_above
        result[rows[hit]] = above[hit]
        rest = rest - p_above

        below -= 1
        p_below = np.where(below >= 0, p_below * down(rows, below), 0.0)
        hit_below = ~hit & (rest < p_below)
        result[rows[hit_below]] = below[hit_below]
        rest = rest - p_below

        # what rounding leaves over once both tails are spent belongs to the upper one
        spent = (p_above < _DONE) & (p_below < _DONE)
        tail = spent & ~hit & ~hit_below
        result[rows[tail]] = above[tail]

        still = ~(hit | hit_below | spent)
        rows, rest = rows[still], rest[still]
        above, below, p_above, p_below = above[still], below[still], p_above[still], p_below[still]
    return result.astype(np.int64)


def poisson_quantiles(u: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Poisson counts for uniform draws; rates of zero or less give zero."""
    lam = np.maximum(rate, 0.0)
    mode = np.floor(lam)
    log_p = mode * np.log(np.maximum(lam, _SMALLEST)) - lam - _log_factorial(mode)
    p = np.where(lam > 0, np.exp(log_p), 1.0)
    return _walk_from_mode(
        u,
        mode,
        p,
        up=lambda rows, k: lam[rows] / k,
        down=lambda rows, k: (k + 1) / np.maximum(lam[rows], _SMALLEST),
    )


def binomial_quantiles(u: np.ndarray, trials: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Binomial counts for uniform draws; chances are clipped to 0..1."""
    n = np.maximum(trials, 0).astype(float)
    q = np.clip(chance, 0.0, 1.0)
    certain = (q <= 0.0) | (q >= 1.0) | (n <= 0)
    inner = np.where(certain, 0.5, q)
    mode = np.minimum(np.floor((n + 1) * inner), n)
    log_p = (
        _log_factorial(n)
        - _log_factorial(mode)
        - _log_factorial(n - mode)
        + mode * np.log(inner)
        + (n - mode) * np.log1p(-inner)
    )
    p = np.where(certain, 1.0, np.exp(log_p))
    odds = inner / (1.0 - inner)
    drawn = _walk_from_mode(
        u,
        mode,
        p,
        up=lambda rows, k: np.maximum(n[rows] - k + 1, 0.0) / k * odds[rows],
        down=lambda rows, k: (k + 1) / np.maximum(n[rows] - k, 1.0) / odds[rows],
    )
    return np.where(certain, np.where(q >= 1.0, n, 0.0), drawn).astype(np.int64)


@F.pandas_udf(T.LongType())
def _poisson(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for u, rate in batches:
        yield _counts(poisson_quantiles, u, rate)


@F.pandas_udf(T.LongType())
def _binomial(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for u, trials, chance in batches:
        yield _counts(binomial_quantiles, u, trials, chance)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _binomials(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for u, trials, chance in batches:
        sizes = u.map(len).to_numpy()
        flat = [pd.Series(np.concatenate([np.empty(0), *arrays])) for arrays in (u, trials)]
        drawn = _counts(binomial_quantiles, *flat, pd.Series(np.repeat(chance.to_numpy(float, na_value=np.nan), sizes)))
        values = drawn.to_numpy(object, na_value=None) if drawn.hasnans else drawn.to_numpy(np.int64)
        yield pd.Series(np.split(values, np.cumsum(sizes)[:-1]), dtype=object)


def poisson(rate: Column, seed: int, *keys: Column | str) -> Column:
    return _poisson(uniform(seed, *keys), rate)


def binomial(trials: Column, chance: Column, seed: int, *keys: Column | str) -> Column:
    return _binomial(uniform(seed, *keys), trials, chance)


def binomials(uniforms: Column, trials: Column, chance: Column) -> Column:
    """An array of counts, one for each uniform draw and its trials, all at the row's chance.

    Rows without draws have empty arrays: many null ones in a row make Spark's Arrow writer slow.
    """
    return _binomials(uniforms, trials, chance)
