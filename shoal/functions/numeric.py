"""Ratios, intervals, distances and bandit scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .draws import draw_int

# The score interval's z and the smoothing of its formula.
WILSON_Z = 1.96


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def round_step(c, steps: int = 100) -> Column:
    """Nearest multiple of 1/steps, halves upwards (also below zero)."""
    return F.floor(as_col(c) * F.lit(steps) + F.lit(0.5)) / F.lit(float(steps))


def safe_ratio(a, b) -> Column:
    """a / b, and 0 where b is 0."""
    a, b = as_col(a).cast("double"), as_col(b).cast("double")
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def ratio(a, b) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def wilson(positive, total, z: float = WILSON_Z) -> Column:
    """Lower end of the Wilson score interval; 0 where there were no trials."""
    k, n = as_col(positive).cast("double"), as_col(total).cast("double")
    zz = z * z
    share = F.try_divide(k, n)
    spread = F.lit(z) * F.sqrt(share * (1 - share) / n + zz / (4 * n * n))
    bound = (share + zz / (2 * n) - spread) / (1 + zz / n)
    return F.when(n == 0, F.lit(0.0)).otherwise(bound)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(as_col(a), lambda x: x.cast("double") * x.cast("double"))))


def euclidean(a, b) -> Column:
    squared = F.zip_with(as_col(a), as_col(b),
                         lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(_sum(squared))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 where either vector is all zeros."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def ucb_log(rate, mean_trials, trials) -> Column:
    """rate + log10(mean trials / trials)."""
    return as_col(rate) + F.log10(as_col(mean_trials) / as_col(trials))


def ucb_sqrt(rate, mean_trials, trials) -> Column:
    """rate + sqrt(log10(mean trials) / trials)."""
    return as_col(rate) + F.sqrt(F.log10(as_col(mean_trials)) / as_col(trials))


def hash_bucket(c, n: int) -> Column:
    """Bucket from 0 to n - 1 of a value's text, by its MD5."""
    return F.pmod(draw_int("bucket", as_col(c)), F.lit(n)).cast("int")


def finite(c) -> Column:
    """True for values that are neither null, NaN nor infinite."""
    c = as_col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf))
