"""Packing of token pieces into sequences of bounded length by minimum bin slack.

How many pieces there are of each length is all the plan needs: at most ``cap``
numbers, whatever the corpus. For one sequence the largest length left is taken
and a bitset subset-sum over the lengths left finds the fullest feasible fill. The
combination found is removed as often as its counts allow, so the number of
searches is bounded by the number of lengths as well. Pieces then take their
places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.session import stored, wide_partitions

from .tokens import batches_of, encoder

CAP = 4096
_RANKS = 1 << 45  # more pieces of one length than any corpus has


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 1, cap: int = CAP, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, on request, ``ids`` of each piece of each whole text.

    A document's ids are those of its text (none if null or empty), then ``end_id``; only documents of more than
    ``cap`` ids are cut.
    """
    tail = np.array([end_id], dtype="<u4")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(vocabulary)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for part in batches_of(texts):
                rows = []
                for doc_id, ids in zip(batch["doc_id"].iloc[part], tool.encode(texts[part]), strict=True):
                    ids = np.concatenate([ids, tail])
                    for piece, at in enumerate(range(0, len(ids), cap)):
                        own = ids[at:at + cap].tobytes()
                        rows.append((doc_id, piece, at, len(own) // 4, zlib.crc32(own), own)[:len(names)])
                frame = pd.DataFrame(rows, columns=names)
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long"
                              + (", ids binary" if with_ids else ""))


def fullest(lengths: np.ndarray, counts: dict[int, int], room: int) -> dict[int, int]:
    """Pieces (length: how many) that fill ``room`` best; ``lengths`` descend.

    Bit s of the bitset tells that a sum of s is feasible. Multiplicities are added by doubling. The search ends
    when ``room`` itself is reached.
    """
    reach, every = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int]] = []
    for length in lengths[np.searchsorted(-lengths, -room):].tolist():
        if reach >> room & 1:
            break
        steps.append((length, reach))
        left, some = min(counts[length], room // length), 1
        while left > 0:
            some = min(some, left)
            reach |= (reach << (some * length)) & every
            left -= some
            some *= 2
    at, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> at & 1:
            at -= length
            used[length] = used.get(length, 0) + 1
    return used


def plan(counts: dict[int, int], cap: int = CAP) -> np.ndarray:
    """Places of all pieces: rows of (length, first rank, pieces per sequence, first sequence, offset), sorted."""
    left = {int(k): int(v) for k, v in counts.items() if v > 0}
    lengths = np.array(sorted(left, reverse=True), dtype=np.int64)
    placed = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while len(lengths):
        top = int(lengths[0])
        left[top] -= 1
        used = fullest(lengths if left[top] else lengths[1:], left, cap - top)
        left[top] += 1
        used[top] = used.get(top, 0) + 1
        copies = min(left[length] // n for length, n in used.items())
        offset, gone = 0, False
        for length in sorted(used, reverse=True):
            n = used[length]
            rows.append((length, placed[length], n, sequence, offset))
            offset += n * length
            placed[length] += n * copies
            left[length] -= n * copies
            gone |= not left[length]
        sequence += copies
        if gone:
            lengths = lengths[[left[x] > 0 for x in lengths.tolist()]]
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(found: DataFrame, cap: int = CAP) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: no sequence longer than ``cap``, no gap in it.

    Needs ``doc_id, piece, length`` (1 to cap); other columns pass through, whatever they are called, but for earlier ones
    called ``sequence_id`` and ``offset``, which are replaced. Repeated rows are pieces of their own; ties go by doc_id
    (nulls first), piece and, where there, start and ids_crc32, so that reruns agree also on documents that came
    twice. An empty table gives no rows. Ranks among pieces of one length are counted in slices dealt by all of these, so that
    a length or an absent id that a third of all pieces have is shared out.
    """
    spark = found.sparkSession
    slices = max(256, wide_partitions(spark))
    order = ["doc_id", "piece", *(c for c in ("start", "ids_crc32") if c in found.columns)]
    others = [c for c in found.columns if c not in (*order, "length", "sequence_id", "offset")]
    names = [*order, "length", *(f"_other{i}" for i in range(len(others)))]
    plain = found.select(*order, "length", *[F.col(f"`{c}`").alias(f"_other{i}") for i, c in enumerate(others)])
    kept = stored(plain.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int")), "pieces")
    counted = kept.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    per_length = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    if any(not 1 <= length <= cap for length in per_length):
        raise ValueError(f"pieces must have 1 to {cap} ids")
    places = plan(per_length, cap)
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_slice").orderBy(*order)
    ranked = (kept.withColumn("_in", F.row_number().over(inside)).join(offsets, ["length", "_slice"])
              .withColumn("_rank", F.col("_before") + F.col("_in") - 1).drop("_before", "_in", "_slice"))
    shared = spark.sparkContext.broadcast(places)  # bounded: a few rows for each of at most cap lengths

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        starts = table[:, 0] * _RANKS + table[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            own = table[np.searchsorted(starts, length * _RANKS + rank, side="right") - 1]
            nth, place = np.divmod(rank - own[:, 1], np.maximum(own[:, 2], 1))
            out = batch[names].copy()
            out["sequence_id"] = own[:, 3] + nth
            out["offset"] = own[:, 4] + place * length
            yield out

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)
    placed = ranked.mapInPandas(run, schema + ", sequence_id long, offset long")
    back = dict(zip(others, names[len(order) + 1:], strict=True))
    return placed.select(*[F.col(back.get(c, c)).alias(c) for c in found.columns if c not in ("sequence_id", "offset")],
                         "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of the packed pieces that carry ``ids``; a group holds at most ``cap`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_parts"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("_parts", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
