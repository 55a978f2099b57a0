"""Embedding functions as Column builders, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-10


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def doubles(e: Column) -> Column:
    return e.cast("array<double>")


def finite(e: Column) -> Column:
    """NaN, infinite and null values replaced by 0."""
    bad = lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))) | x.isNull()
    return F.transform(doubles(e), lambda x: F.when(bad(x), F.lit(0.0)).otherwise(x))


def norm(e: Column) -> Column:
    return F.sqrt(_sum(F.transform(doubles(e), lambda x: x * x)))


def valid(e: Column) -> Column:
    """Not null or empty, all values finite, and not all zero."""
    bad = F.exists(doubles(e), lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))) | x.isNull())
    return F.coalesce(e.isNotNull() & (F.size(e) > 0) & ~bad & (norm(e) > 0), F.lit(False))


def unit(e: Column) -> Column:
    """Of length 1; a zero vector as it is."""
    clean = finite(e)
    n = norm(clean)
    return F.when(n > 0, F.transform(clean, lambda x: x / n)).otherwise(clean)


def cosine(a: Column, b: Column) -> Column:
    """-1 where a side is null or the result isn't a number."""
    dot = _sum(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))
    return F.coalesce(F.nanvl(dot / (norm(a) * norm(b) + TINY), F.lit(-1.0)), F.lit(-1.0))


def running_mean(old: Column, n: Column, new: Column) -> Column:
    """The mean of n old vectors and one more, of length 1."""
    return unit(F.zip_with(doubles(old), doubles(new), lambda x, y: (x * n + y) / (n + 1)))


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, lambda v: F.abs(v)))


def rms(x: Column) -> Column:
    return F.sqrt(_sum(F.transform(doubles(x), lambda v: v * v)) / F.size(x))


def loudness(level: Column) -> Column:
    """Approximate LUFS of an RMS level; minus infinity at silence."""
    return F.when(level > 0, 20 * F.log10(level) - 0.691).otherwise(F.lit(float("-inf")))


def gain(level: Column, lufs: float = -23.0) -> Column:
    """The factor that brings an RMS level to the target; 1 at silence."""
    return F.when(level > 0, F.lit(10 ** ((lufs + 0.691) / 20)) / level).otherwise(1.0)


def limited(x: Column, decibel: float = -1.0) -> Column:
    """Scaled to the peak limit where it is exceeded, then clipped to [-1, 1]."""
    most, limit = peak(x), 10 ** (decibel / 20)
    scale = F.when(most > limit, F.lit(limit) / most).otherwise(1.0)
    return F.transform(doubles(x), lambda v: F.least(F.greatest(v * scale, F.lit(-1.0)), F.lit(1.0)))
