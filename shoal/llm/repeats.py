"""Removal of passages that an earlier document holds, by fixed-block anchors.

A window is ``window`` consecutive words of one document; it goes if the same words
also start in a document with a smaller id. Every window holds exactly one aligned
block of ``(window + 1) / 2`` words, so:

1. Index and probe. Each group of documents sends the hashes of its aligned blocks
   (the index) and of every rolling block (the probes) to buckets of hashes. A block
   is hit if it is indexed and a second document has it.
2. Extend. Windows around a hit are compared whole, by 64 bits within a bucket that an
   independent hash chooses: each group sends its windows with its smallest document,
   the bucket tells whether a smaller document has them.
3. Remove. Windows found earlier elsewhere are merged to maximal repeats, and their
   words go.

Rolling windows that overlap and share text are extended together, so a repeat is
found once however long it is, and no pair of documents is ever formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .groups import Sizes, group_of, planes, run_ids, runs, sizes, unplanes
from .tokens import batches_of
from .words import as_bytes, window_hashes, word_hashes

WINDOW = 13
_MESSAGE = "_b int, _g int, hashes binary, extra binary"
_ANSWER = "_g int, kind int, _b int, bits binary"


class _Group:
    """The documents of one group that have an id, in ascending order of it."""

    def __init__(self, table: pa.Table, size: Sizes, window: int):
        ids = table["_id"].to_pylist()
        texts = table["_text"].to_pylist()
        self.rows = sorted((i for i in range(len(ids)) if ids[i] is not None), key=lambda i: ids[i])
        self.ids = np.array([ids[i] for i in self.rows], dtype=np.int64)
        self.texts = texts
        self.size, self.window, self.block = size, window, (window + 1) // 2
        raw = [as_bytes(texts[i]) for i in self.rows]
        parts, counts = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for part in batches_of(raw):
            hashes, starts = word_hashes(raw[part])
            parts.append(hashes)
            counts.append(np.diff(starts))
        self.words, self.counts = np.concatenate(parts), np.concatenate(counts)
        self.starts = np.cumsum(self.counts) - self.counts
        self.owner = np.repeat(np.arange(len(self.rows)), self.counts)
        place = np.arange(len(self.words))
        self.inside = place - self.starts[self.owner]  # place in the document
        self.left = self.counts[self.owner] - self.inside  # words from here to its end
        self._blocks()

    def _blocks(self) -> None:
        long_enough = self.counts[self.owner] >= self.window
        at = np.flatnonzero((self.left >= self.block) & long_enough)
        hashes = window_hashes(self.words, self.block)[at] if len(at) else np.zeros(0, dtype=np.uint64)
        key = ((hashes % np.uint64(self.size.buckets)) << np.uint64(32)) | (hashes >> np.uint64(32))
        order = np.argsort(key, kind="stable")
        self.block_at, self.key = at[order], key[order]
        self.block_runs = runs(self.key)

    def index_and_probes(self) -> dict[str, list]:
        """Distinct block hashes by bucket; flags: 1 if indexed, 2 if two documents of the group have it."""
        starts = self.block_runs
        out: dict[str, list] = {"_b": [], "hashes": [], "extra": []}
        if not len(starts):
            return out
        aligned = np.logical_or.reduceat(self.inside[self.block_at] % self.block == 0, starts)
        last = np.append(starts[1:], len(self.key)) - 1
        owner = self.ids[self.owner[self.block_at]]
        flags = (aligned + 2 * (owner[starts] != owner[last])).astype(np.uint8)
        found = self.key[starts]
        for bucket, part in self._by_bucket(found >> np.uint64(32)):
            out["_b"].append(bucket)
            out["hashes"].append((found[part] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
            out["extra"].append(flags[part].tobytes())
        return out

    @staticmethod
    def _by_bucket(buckets: np.ndarray):
        starts = runs(buckets)
        for a, b in zip(starts, np.append(starts[1:], len(buckets)), strict=True):
            yield int(buckets[a]), slice(int(a), int(b))

    def _answer(self, buckets: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(len(buckets), dtype=bool)
        for bucket, part in self._by_bucket(buckets):
            if bucket in answers:
                n = part.stop - part.start
                out[part] = np.unpackbits(np.frombuffer(answers[bucket], dtype=np.uint8), count=n)
        return out

    def extend(self, hits: dict[int, bytes]) -> None:
        """Windows that hold a hit block, by bucket and hash, ties in ascending order of document."""
        hit = np.zeros(len(self.words) + 1, dtype=np.int64)
        if len(self.key):
            run_hit = self._answer(self.key[self.block_runs] >> np.uint64(32), hits)
            hit[self.block_at] = run_hit[run_ids(self.block_runs, len(self.key))]
        total = np.concatenate([[0], np.cumsum(hit)])
        at = np.flatnonzero(self.left >= self.window)
        at = at[total[at + self.window - self.block + 1] > total[at]]
        both = [window_hashes(self.words, self.window, seed)[at] if len(at) else np.zeros(0, dtype=np.uint64) for seed in (0, 1)]
        bucket = both[1] % np.uint64(self.size.buckets)
        order = np.lexsort((both[0], bucket))
        self.window_at, self.window_key, self.window_bucket = at[order], both[0][order], bucket[order]
        changed = (self.window_key[1:] != self.window_key[:-1]) | (self.window_bucket[1:] != self.window_bucket[:-1])
        self.window_runs = np.flatnonzero(np.append(True, changed)) if len(order) else np.zeros(0, dtype=np.int64)
        self.window_doc = self.ids[self.owner[self.window_at]]

    def windows(self) -> dict[str, list]:
        starts, out = self.window_runs, {"_b": [], "hashes": [], "extra": []}
        if len(starts):
            key, doc = self.window_key[starts], self.window_doc[starts]
            for bucket, part in self._by_bucket(self.window_bucket[starts]):
                out["_b"].append(bucket)
                out["hashes"].append(key[part].astype("<u8").tobytes())
                out["extra"].append(planes(doc[part]))
        return out

    def remove(self, earlier: dict[int, bytes]) -> np.ndarray:
        """Whether each word of the group goes."""
        change = np.zeros(len(self.words) + 1, dtype=np.int64)
        if len(self.window_runs):
            elsewhere = self._answer(self.window_bucket[self.window_runs], earlier)
            run = run_ids(self.window_runs, len(self.window_at))
            gone = elsewhere[run] | (self.window_doc != self.window_doc[self.window_runs][run])
            np.add.at(change, self.window_at[gone], 1)
            np.add.at(change, self.window_at[gone] + self.window, -1)
        return np.cumsum(change[:-1]) > 0


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows and columns, with the repeated stretches out of ``text``; ``n_chars``, where present, follows it.

    A document that an earlier one holds whole stays with an empty text.
    """
    others = tuple(c for c in docs.columns if c != "text")
    found = remove_repeats(docs, window, keep=others, as_is=True)
    columns = {c: F.col(f"_keep{i}") for i, c in enumerate(others)} | {"text": F.col("kept_text")}
    if "n_chars" in columns:
        columns["n_chars"] = (F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(columns["n_chars"])
                              .cast(docs.schema["n_chars"].dataType))
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def _messages(rows: dict[str, list], group: int) -> pa.Table:
    n = len(rows["_b"])
    return pa.table({"_b": pa.array(rows["_b"], pa.int32()), "_g": pa.array([group] * n, pa.int32()),
                     "hashes": pa.array(rows["hashes"], pa.binary()), "extra": pa.array(rows["extra"], pa.binary())})


def _answers(table: pa.Table, kind: int, flags: np.ndarray, lengths: list[int]) -> pa.Table:
    ends = np.cumsum(lengths)
    bits = [np.packbits(flags[b - n:b]).tobytes() for b, n in zip(ends, lengths, strict=True)]
    return pa.table({"_g": table["_g"], "kind": pa.array([kind] * len(bits), pa.int32()), "_b": table["_b"],
                     "bits": pa.array(bits, pa.binary())})


def _match_blocks(table: pa.Table) -> pa.Table:
    """A block is hit if some document indexes it and another one has it."""
    parts = [np.frombuffer(x, dtype="<u4") for x in table["hashes"].to_pylist()]
    hashes, flags = np.concatenate(parts), np.frombuffer(b"".join(table["extra"].to_pylist()), dtype=np.uint8)
    order = np.argsort(hashes, kind="stable")
    starts = runs(hashes[order])
    flags = flags[order]
    many = np.diff(np.append(starts, len(order))) > 1
    hit = np.logical_or.reduceat(flags & 1 > 0, starts) & (many | np.logical_or.reduceat(flags & 2 > 0, starts))
    out = np.zeros(len(order), dtype=bool)
    out[order] = hit[run_ids(starts, len(order))]
    return _answers(table, 1, out, [len(p) for p in parts])


def _match_windows(table: pa.Table) -> pa.Table:
    """A group's window goes from all its documents if a smaller document elsewhere has it."""
    parts = [np.frombuffer(x, dtype="<u8") for x in table["hashes"].to_pylist()]
    hashes, docs = np.concatenate(parts), np.concatenate([unplanes(x) for x in table["extra"].to_pylist()])
    order = np.argsort(hashes, kind="stable")
    starts = runs(hashes[order])
    least = np.minimum.reduceat(docs[order], starts)[run_ids(starts, len(order))]
    out = np.zeros(len(order), dtype=bool)
    out[order] = docs[order] > least
    return _answers(table, 2, out, [len(p) for p in parts])


def _said(table: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(table["kind"].to_pylist(), table["_b"].to_pylist(), table["bits"].to_pylist(), strict=True)
    return {b: bits for k, b, bits in rows if k == kind}


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   keep: tuple[str, ...] = (), as_is: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept_text`` of every row, and ``_keep0, _keep1, …`` for those in ``keep``.

    ``removed`` lists the removed stretches as word positions, first and one behind the last; ``kept_text`` has the
    words that stay, one blank between them; with ``as_is`` a text that loses none stays as it is, a null text null.
    ``window`` is odd. A null text has no words. A row without an id is
    compared with nothing and stays whole. Rows that share an id are one document to the comparison, each with its
    own words. Windows are judged on the input. An empty table gives no rows.
    """
    if window % 2 == 0:
        raise ValueError("the window must be odd, so that it holds one aligned block")
    size = sizes(docs, text_col)
    passed = [docs.schema[c] for c in keep]
    dealt = (docs.select(group_of(F.col(id_col), size, F.col(text_col)).alias("_g"), F.col(id_col).cast("long").alias("_id"),
                         F.col(text_col).alias("_text"), *[F.col(f.name).alias(f"_keep{i}") for i, f in enumerate(passed)])
             .repartition(size.partitions, "_g"))  # one exchange, read by all three steps

    def probe(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _messages(_Group(table, size, window).index_and_probes(), key[0].as_py())

    def extend(key: tuple[pa.Scalar, ...], table: pa.Table, said: pa.Table) -> pa.Table:
        group = _Group(table, size, window)
        group.extend(_said(said, 1))
        return _messages(group.windows(), key[0].as_py())

    def remove(key: tuple[pa.Scalar, ...], table: pa.Table, said: pa.Table) -> pa.Table:
        group = _Group(table, size, window)
        group.extend(_said(said, 1))
        gone = group.remove(_said(said, 2))
        n = table.num_rows
        texts, kept, words, lost, spans = group.texts, [""] * n, [0] * n, [0] * n, [[] for _ in range(n)]
        known = dict(zip(group.rows, range(len(group.rows)), strict=True))
        for i in range(n):
            own = as_bytes(texts[i]).split()
            words[i] = len(own)
            k = known.get(i)
            if k is not None and words[i]:
                mask = gone[group.starts[k]:group.starts[k] + group.counts[k]]
                if mask.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                    spans[i] = edge.tolist()
                    lost[i] = int(mask.sum())
                    own = [w for w, g in zip(own, mask.tolist(), strict=True) if not g]
            kept[i] = texts[i] if as_is and not lost[i] else b" ".join(own).decode()
        return pa.table({"doc_id": table["_id"], "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(lost, pa.int64()),
                         "removed": pa.array(spans, pa.list_(pa.int64())), "kept_text": pa.array(kept, pa.string()),
                         **{f"_keep{i}": table[f"_keep{i}"] for i in range(len(passed))}})

    schema = StructType([StructField("doc_id", LongType()), StructField("n_words", LongType()), StructField("n_removed", LongType())])
    schema = schema.add("removed", ArrayType(LongType())).add("kept_text", StringType())
    for i, f in enumerate(passed):
        schema = schema.add(f"_keep{i}", f.dataType)
    hits = dealt.groupBy("_g").applyInArrow(probe, _MESSAGE).groupBy("_b").applyInArrow(_match_blocks, _ANSWER)
    windows = dealt.groupBy("_g").cogroup(hits.groupBy("_g")).applyInArrow(extend, _MESSAGE)
    earlier = windows.groupBy("_b").applyInArrow(_match_windows, _ANSWER)
    return dealt.groupBy("_g").cogroup(hits.unionByName(earlier).groupBy("_g")).applyInArrow(remove, schema)
