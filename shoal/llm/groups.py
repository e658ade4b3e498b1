"""Documents dealt into groups by id, and compact messages between groups and buckets.

A group's documents are hashed together in one task and send one row to each bucket
of hashes: sorted arrays instead of a row per word. A bucket answers with an array in
the same order. A hash reaches its bucket at most once per group, however often it
occurs, so no common word or passage gathers in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.session import wide_partitions

#: Bytes of text of a group and of the texts behind one bucket, where the data is large enough.
GROUP_BYTES = 16_000_000
BUCKET_BYTES = 32_000_000


@dataclass(frozen=True)
class Sizes:
    groups: int
    buckets: int
    partitions: int


def sizes(docs: DataFrame, text_col: str = "text") -> Sizes:
    """Numbers of groups and buckets that grow with the bytes of text; all rows are counted."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    width = wide_partitions(docs.sparkSession)
    groups = max(2 * width, -(-total // GROUP_BYTES))
    return Sizes(groups, max(width, -(-total // BUCKET_BYTES)), max(width, groups // 8))


def group_of(doc_id: Column, size: Sizes, text: Column | None = None) -> Column:
    """The group of an id; rows without an id, which are compared with nothing, are dealt by their text where it's given."""
    spread = F.xxhash64(doc_id) if text is None else F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id))
    return F.pmod(spread, F.lit(size.groups)).cast("int")


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if not len(ordered):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))


def run_ids(starts: np.ndarray, n: int) -> np.ndarray:
    mark = np.zeros(n, dtype=np.int64)
    mark[starts[1:]] = 1
    return np.cumsum(mark)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte, first all lowest bytes and so on: the empty upper bytes compress away."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()
