"""The scalar functions SQL users need, as SQL-defined temporary functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .numeric import WILSON_Z

_DEFINITIONS = {
    "round_step": "(d DOUBLE, n INT) RETURNS DOUBLE RETURN floor(d * n + 0.5D) / CAST(n AS DOUBLE)",
    "safe_ratio": "(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN CASE WHEN b = 0 THEN 0D ELSE try_divide(a, b) END",
    "wilson": "(k DOUBLE, n DOUBLE) RETURNS DOUBLE RETURN CASE WHEN n = 0 THEN 0D ELSE "
              f"(try_divide(k, n) + {WILSON_Z ** 2}D / (2 * n) - {WILSON_Z}D * sqrt("
              f"try_divide(k, n) * (1 - try_divide(k, n)) / n + {WILSON_Z ** 2}D / (4 * n * n)))"
              f" / (1 + {WILSON_Z ** 2}D / n) END",
    "cosine": "(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE RETURN coalesce(try_divide("
              "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x), "
              "sqrt(aggregate(transform(a, x -> x * x), 0D, (s, x) -> s + x)) * "
              "sqrt(aggregate(transform(b, x -> x * x), 0D, (s, x) -> s + x))), 0D)",
    "ngram_jaccard": "(a STRING, b STRING, n INT) RETURNS DOUBLE RETURN ("
                     "WITH t AS (SELECT replace(lower(a), ' ', '') AS x, replace(lower(b), ' ', '') AS y), "
                     "g AS (SELECT "
                     "CASE WHEN length(x) >= n THEN array_distinct(transform(sequence(1, length(x) - n + 1), "
                     "i -> substr(x, i, n))) ELSE CAST(array() AS ARRAY<STRING>) END AS gx, "
                     "CASE WHEN length(y) >= n THEN array_distinct(transform(sequence(1, length(y) - n + 1), "
                     "i -> substr(y, i, n))) ELSE CAST(array() AS ARRAY<STRING>) END AS gy FROM t) "
                     "SELECT CASE WHEN size(array_union(gx, gy)) = 0 THEN 0D ELSE "
                     "CAST(size(array_intersect(gx, gy)) AS DOUBLE) / size(array_union(gx, gy)) END FROM g)",
}


def register(spark: SparkSession, prefix: str = "shoal_") -> list[str]:
    """Create the temporary functions and return their names."""
    for name, body in _DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{body}")
    return [prefix + name for name in _DEFINITIONS]
