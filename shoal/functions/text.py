"""String functions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .numeric import as_col


def is_hex(c) -> Column:
    return as_col(c).rlike("^[0-9a-fA-F]+$")


def salted_key(*parts) -> Column:
    """``hh:a.b.c``: dotted key behind the first byte of its SHA-1; blank parts are skipped."""
    kept = [F.when(F.trim(as_col(p)) != "", as_col(p).cast("string")) for p in parts]
    key = F.concat_ws(".", *kept)
    return F.concat(F.substring(F.sha1(key), 1, 2), F.lit(":"), key)


def multi_split(c, patterns: list[str]) -> Column:
    """Distinct pieces after splitting at every one of the patterns."""
    return F.array_distinct(F.split(as_col(c), "|".join(f"(?:{p})" for p in patterns)))


def squash(c) -> Column:
    """Lower case without spaces."""
    return F.lower(F.replace(as_col(c), F.lit(" "), F.lit("")))


def levenshtein_share(a, b) -> Column:
    """Edit distance over the length of the first string."""
    return F.try_divide(F.levenshtein(as_col(a), as_col(b)).cast("double"), F.length(as_col(a)).cast("double"))


def ngrams(c, n: int) -> Column:
    text = squash(c)
    last = F.length(text) - n + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(n))))


def ngram_jaccard(a, b, n: int) -> Column:
    """Shared over all character n-grams; 0 where there are none."""
    x, y = ngrams(a, n), ngrams(b, n)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(0.0)).otherwise(
        F.size(F.array_intersect(x, y)).cast("double") / union.cast("double"))


def level_set(c) -> Column:
    """Letters of ``"S,A"`` or ``"SA"`` as a distinct array."""
    return F.array_distinct(F.filter(F.split(as_col(c), ""), lambda x: (x != ",") & (x != "")))


def delimited_union(*cols, sep: str = ",") -> Column:
    """Distinct union of delimited sets; nulls count as empty, empty members go."""
    merged = F.split(F.concat_ws(sep, *[as_col(c) for c in cols]), re.escape(sep))
    return F.array_distinct(F.filter(merged, lambda x: x != ""))


def words(c) -> Column:
    """Lower-cased words; everything but ASCII letters separates."""
    return F.filter(F.split(F.lower(as_col(c)), "[^a-z]+"), lambda w: w != "")


def region_bucket(c) -> Column:
    """Base-36 number of the first two characters: 0 … 1295."""
    return F.conv(F.substring(F.trim(as_col(c)), 1, 2), 36, 10).cast("int")
