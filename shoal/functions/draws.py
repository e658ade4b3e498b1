"""Seeded draws.

A draw depends only on the seed and the key columns, so a lost task, a retry or
another partitioning gives the same sample again.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPAN = float(2 ** 32)


def _cols(keys) -> list[Column]:
    return [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]


def draw_int(seed, *keys) -> Column:
    """Integer in [0, 2^32) from the first eight hex digits of an MD5 digest."""
    text = F.concat_ws("|", F.lit(str(seed)), *_cols(keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def uniform(seed, *keys) -> Column:
    """Uniform double in [0, 1)."""
    return draw_int(seed, *keys).cast("double") / F.lit(_SPAN)


def draw_below(n: int, seed, *keys) -> Column:
    """Uniform integer in [0, n)."""
    return F.floor(uniform(seed, *keys) * F.lit(n)).cast("int")
