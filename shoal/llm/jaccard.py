"""Groups of documents whose sets of word shingles overlap, by filters in several token orders.

Two sets can only reach the similarity if they share a shingle among the first few of
each, in any order of all shingles. So each set takes its first shingles under two
orders: both put shingles that very many documents hold last and are otherwise
independent. The steps:

1. Equal sets are one node. Counts over all documents give the orders.
2. Each group of documents asks buckets of shingles which of its first shingles other
   nodes hold, in either order, and for the first order by which nodes (a sum of their
   hashes). A set without a partner in both orders drops out.
3. Shingles held by the same nodes, as those of one passage are, make one list. A list's
   nodes are compared, if they also share a shingle of the second order, by parity
   bitmaps: the bits in which two bitmaps differ are a lower bound of the sets'
   difference. A list gives the links that hold its nodes together, never all pairs.
4. Only sets held together this way can be similar. They are brought together once and
   intersected exactly; links that hold a group together give the components.

A shingle or a group with too many nodes for one task is cut into blocks, and each two
blocks meet in a task of their own. Nothing is capped or left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.session import stored

from .components import components
from .groups import Sizes, group_of, run_ids, runs, sizes
from .tokens import batches_of
from .words import as_bytes, mix, window_hashes, word_hashes

SHINGLE = 4
SIMILARITY = 85  # per cent
#: Cells of the counting table; nodes of a shingle and shingles of a group that one task takes.
CELLS = 1 << 20
LIST_NODES = 8192
CELL_SHINGLES = 3_000_000
#: Sets of a group up to which all are listed at once; beyond it, sets that are compared with all others first.
LISTED_SETS = 64
REPRESENTATIVES = 16

_SEEDS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A3564E27F88713))
_MARKS = 256  # bits of the mark of a set's shared shingles in the second order


def shingle_sets(texts: list, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of k words of each whole text, A-Z in lower case; fewer words are one run."""
    out = []
    for part in batches_of(raw := [as_bytes(t) for t in texts]):
        words, starts = word_hashes(raw[part], lower=True)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            own = words[a:b]
            out.append(np.unique(window_hashes(own, min(k, len(own)))) if len(own) else np.zeros(0, dtype=np.uint64))
    return out


def node_of(shingles: np.ndarray) -> int:
    """One long for equal sets."""
    return int(mix(np.array([mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))], dtype=np.uint64)).view(np.int64)[0])


def prefix_size(n: int, per_cent: int = SIMILARITY) -> int:
    return n + (-per_cent * n // 100) + 1


def bitmap_bits(n: int) -> int:
    return min(1 << 16, max(64, 1 << int(2 * n - 1).bit_length()))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each bit, as words of 64 bits."""
    bits = bitmap_bits(len(shingles))
    place = (mix(shingles ^ _SEEDS[0]) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1).view("<u8")


def heavy_cells(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """``(cell, level)`` of the cells of shingles that stand far above the mean of the corpus.

    Every task counts the shingles of all its documents and reports cells above four times its mean (at least 16).
    The result has at most ``CELLS`` rows.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for part in batches_of(texts := list(batch["text"]), size=lambda t: len(t) if isinstance(t, str) else 0):
                found = [s & np.uint64(CELLS - 1) for s in shingle_sets(texts[part], k)]
                cells += np.bincount(np.concatenate(found).astype(np.int64), minlength=CELLS)
        high = np.flatnonzero(cells > max(16, 4 * cells.mean()))
        yield pd.DataFrame({"cell": high, "n": cells[high], "total": np.zeros(len(high), dtype=np.int64)})
        yield pd.DataFrame({"cell": [-1], "n": [0], "total": [int(cells.sum())]})

    rows = (docs.select(F.col(text_col).alias("text")).mapInPandas(count, "cell long, n long, total long").groupBy("cell")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toPandas())
    total = int(rows["total"].sum())
    rows = rows[rows["cell"] >= 0].sort_values("cell")
    level = np.maximum(np.log2(np.maximum(rows["n"].to_numpy(dtype=float), 1) / max(total / CELLS, 4)), 0).astype(np.int64)
    return np.stack([rows["cell"].to_numpy(dtype=np.int64), level], axis=1)[level > 0]


def first_shingles(shingles: np.ndarray, order: int, levels: np.ndarray, per_cent: int = SIMILARITY) -> np.ndarray:
    """The prefix of a set under one order: by level, then by an own hash."""
    size = prefix_size(len(shingles), per_cent)
    level = levels[(shingles & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64)
    key = (level << np.uint64(58)) | (mix(shingles ^ _SEEDS[order]) >> np.uint64(6))
    return shingles if size >= len(shingles) else shingles[np.argpartition(key, size - 1)[:size]]


def _summaries(docs: DataFrame, heavy: np.ndarray, id_col: str, text_col: str, k: int, per_cent: int) -> DataFrame:
    """``doc_id, n, node`` of every row, with the two prefixes and the bitmap of its set."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels = np.zeros(CELLS, dtype=np.uint8)
        levels[shared.value[:, 0]] = shared.value[:, 1]
        for batch in batches:
            texts = list(batch["text"])
            for part in batches_of(texts, size=lambda t: len(t) if isinstance(t, str) else 0):
                rows = []
                for doc_id, own in zip(batch["doc_id"].iloc[part], shingle_sets(texts[part], k), strict=True):
                    if not len(own):
                        rows.append((doc_id, 0, None, None, None, None))
                        continue
                    firsts = [first_shingles(own, order, levels, per_cent).astype("<u8").tobytes() for order in (0, 1)]
                    rows.append((doc_id, len(own), node_of(own), *firsts, bitmap(own).tobytes()))
                frame = pd.DataFrame(rows, columns=["doc_id", "n", "node", "first0", "first1", "bits"])
                yield frame.astype({"doc_id": "Int64", "node": "Int64"})

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInPandas(run, "doc_id long, n long, node long, first0 binary, first1 binary, bits binary")


class _Sets:
    """Prefixes of the nodes of one group."""

    def __init__(self, table: pa.Table, size: Sizes):
        self.node = np.array(table["node"].to_pylist(), dtype=np.int64)
        _, once = np.unique(self.node, return_index=True)
        self.node, self.size = self.node[once], size
        self.n = np.array(table["n"].to_pylist(), dtype=np.int64)[once]
        bits = table["bits"].to_pylist()
        self.bits = [bits[i] for i in once]
        self.first, self.owner, self.order, self.key, self.starts = [], [], [], [], []
        for name in ("first0", "first1"):
            data = table[name].to_pylist()
            parts = [np.frombuffer(data[i], dtype="<u8") for i in once]
            first = np.concatenate([np.zeros(0, dtype=np.uint64), *parts])
            owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            key = ((first % np.uint64(size.buckets)) << np.uint64(32)) | (first >> np.uint64(32))
            order = np.argsort(key, kind="stable")
            self.first.append(first[order])
            self.owner.append(owner[order])
            self.key.append(key[order])
            self.starts.append(runs(key[order]))

    def _parts(self, which: int) -> Iterator[tuple[int, slice]]:
        bucket = self.key[which][self.starts[which]] >> np.uint64(32)
        edge = runs(bucket)
        for a, b in zip(edge, np.append(edge[1:], len(bucket)), strict=True):
            yield int(bucket[a]) * 2 + which, slice(int(a), int(b))

    def ask(self) -> dict[str, list]:
        """By bucket and order: the distinct first shingles, how many nodes of the group hold each, and their sum."""
        out: dict[str, list] = {"_b": [], "hashes": [], "counts": [], "sums": []}
        own = mix(self.node.view(np.uint64)) & np.uint64(0xFFFFFFFF)
        for which in (0, 1):
            starts = self.starts[which]
            if not len(starts):
                continue
            held = np.diff(np.append(starts, len(self.key[which])))
            low = (self.key[which][starts] & np.uint64(0xFFFFFFFF)).astype("<u4")
            sums = np.add.reduceat(own[self.owner[which]], starts).astype("<u4") if which == 0 else np.zeros(len(starts), "<u4")
            for bucket, part in self._parts(which):
                out["_b"].append(bucket)
                out["hashes"].append(low[part].tobytes())
                out["counts"].append(held[part].astype("<u4").tobytes())
                out["sums"].append(sums[part].tobytes())
        return out

    def learn(self, answers: dict[int, tuple[bytes, bytes]]) -> None:
        """Per first shingle the blocks its nodes are cut into (0 where no other node holds it) and their sum."""
        self.blocks, self.sums = [], []
        for which in (0, 1):
            of_run, sums = np.zeros((2, len(self.starts[which])), dtype=np.int64)
            for bucket, part in self._parts(which) if len(of_run) else ():
                if bucket in answers:
                    of_run[part], sums[part] = (np.frombuffer(x, dtype="<u4") for x in answers[bucket])
            run = run_ids(self.starts[which], len(self.key[which]))
            self.blocks.append(of_run[run])
            self.sums.append(sums[run])

    def entries(self) -> dict[str, list]:
        """By bucket: the lists (by key) that the nodes with a partner in both orders stand in, and those nodes."""
        out: dict[str, list] = {c: [] for c in ("_b", "keys", "at", "node", "n", "marks", "bits")}
        second = self.blocks[1] > 0
        marks = np.zeros((len(self.node), _MARKS), dtype=np.uint8)
        marks[self.owner[1][second], (mix(self.first[1][second]) % np.uint64(_MARKS)).astype(np.int64)] = 1
        live = (self.blocks[0] > 0) & marks.any(axis=1)[self.owner[0]]
        listed = np.unique(np.stack([self.sums[0][live], self.blocks[0][live], self.owner[0][live]]), axis=1)
        single = listed[1] == 1
        keys, at = [mix(listed[0][single].astype(np.uint64))], [listed[2][single]]
        for s, n, o in zip(*listed[:, ~single].tolist(), strict=True):
            own = int(mix(self.node[o:o + 1].view(np.uint64))[0] % np.uint64(n))
            cells = [(min(own, other) * n + max(own, other) + 1) for other in range(n)]
            keys.append(mix(np.uint64(s) ^ mix(np.array(cells, dtype=np.uint64))))
            at.append(np.full(n, o))
        key, owner = np.concatenate(keys), np.concatenate(at)
        bucket = (key % np.uint64(self.size.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        key, owner, bucket = key[order], owner[order], bucket[order]
        packed = np.packbits(marks, axis=1)
        edge = runs(bucket)
        for a, b in zip(edge, [*edge[1:], len(bucket)], strict=False):
            who, place = np.unique(owner[a:b], return_inverse=True)
            out["_b"].append(int(bucket[a]))
            out["keys"].append(key[a:b].astype("<u8").tobytes())
            out["at"].append(place.astype("<u4").tobytes())
            out["node"].append(self.node[who].astype("<i8").tobytes())
            out["n"].append(self.n[who].astype("<i8").tobytes())
            out["marks"].append(packed[who].tobytes())
            out["bits"].append(b"".join(self.bits[i] for i in who))
        return out


def _shared(table: pa.Table) -> pa.Table:
    """For each asked shingle 0 if one node alone holds it, else the blocks of its nodes and their sum."""
    parts = [np.frombuffer(x, dtype="<u4") for x in table["hashes"].to_pylist()]
    hashes = np.concatenate(parts)
    counts, sums = (np.frombuffer(b"".join(table[c].to_pylist()), dtype="<u4").astype(np.int64) for c in ("counts", "sums"))
    order = np.argsort(hashes, kind="stable")
    starts = runs(hashes[order])
    total = np.add.reduceat(counts[order], starts)
    sums = np.where(total > 1, np.add.reduceat(sums[order], starts) & 0xFFFFFFFF, 0)
    blocks = np.where(total > 1, -(-total // LIST_NODES), 0)
    run, ends = run_ids(starts, len(order)), np.cumsum([len(p) for p in parts])
    said = {}
    for name, values in (("blocks", blocks), ("sums", sums)):
        out = np.zeros(len(order), dtype="<u4")
        out[order] = values[run]
        said[name] = pa.array([out[b - len(p):b].tobytes() for b, p in zip(ends, parts, strict=True)], pa.binary())
    return pa.table({"_g": table["_g"], "_b": table["_b"], **said})


def close_pairs(n: np.ndarray, bits: np.ndarray, marks: np.ndarray, per_cent: int = SIMILARITY) -> list[tuple[int, int]]:
    """Links that hold together all rows joined by pairs which may be similar; rows ascend in n.

    A later row is compared with the rows before it that aren't yet held together with it, in chunks: a row of a
    large group is done as soon as one link puts it there.
    """
    label, links = np.arange(len(n)), []
    step = 512
    for a in range(0, len(n), step):
        b = min(a + step, len(n))
        for c in range(0, b, step):
            d = min(c + step, b)
            if label[a:b].min() == label[a:b].max() == label[c:d].min() == label[c:d].max():
                continue
            rows = np.arange(a, b)
            if c < a:  # rows that agree with the whole chunk have nothing to find there
                only = label[c] if (label[c:d] == label[c]).all() else -1
                rows = rows[label[rows] != only]
            if not len(rows) or 100 * int(n[d - 1]) < per_cent * int(n[rows[0]]):
                continue
            differ = np.zeros((len(rows), d - c), dtype=np.int64)
            meet = np.zeros((len(rows), d - c), dtype=bool)
            for w in range(bits.shape[1]):
                differ += np.bitwise_count(bits[rows, w][:, None] ^ bits[None, c:d, w])
            for w in range(marks.shape[1]):
                meet |= (marks[rows, w][:, None] & marks[None, c:d, w]) != 0
            both = n[rows][:, None] + n[None, c:d]
            fit = meet & ((100 + per_cent) * differ <= (100 - per_cent) * both) & (rows[:, None] > np.arange(c, d)[None, :])
            fit &= label[rows][:, None] != label[None, c:d]
            for i, j in zip(*np.nonzero(fit), strict=True):
                x, y = label[rows[i]], label[c + j]
                if x != y:
                    links.append((int(rows[i]), int(c + j)))
                    label[label == max(x, y)] = min(x, y)
    return links


def _candidates(table: pa.Table, per_cent: int) -> pa.Table:
    """Links between nodes that may be similar, enough to hold each list's nodes together."""
    keys, at, nodes, sizes_, marks, bits = [], [], [], [], [], []
    total = 0
    columns = [table[c].to_pylist() for c in ("keys", "at", "node", "n", "marks", "bits")]
    for k, i, node, n, mark, bit in zip(*columns, strict=True):
        own = np.frombuffer(n, dtype="<i8")
        keys.append(np.frombuffer(k, dtype="<u8"))
        at.append(np.frombuffer(i, dtype="<u4").astype(np.int64) + total)
        nodes.append(np.frombuffer(node, dtype="<i8"))
        sizes_.append(own)
        marks.append(np.frombuffer(mark, dtype="<u8").reshape(len(own), -1))
        widths = [bitmap_bits(int(x)) // 64 for x in own]
        data = np.frombuffer(bit, dtype="<u8")
        bits += np.split(data, np.cumsum(widths)[:-1])
        total += len(own)
    key, place = np.concatenate(keys), np.concatenate(at)
    node, n, mark = np.concatenate(nodes), np.concatenate(sizes_), np.concatenate(marks)
    order = np.argsort(key, kind="stable")
    edge = runs(key[order])
    found: set[tuple[int, int]] = set()
    seen: set[bytes] = set()
    for a, b in zip(edge, np.append(edge[1:], len(order)), strict=True):
        if b - a < 2:
            continue
        _, once = np.unique(node[place[order[a:b]]], return_index=True)
        rows = place[order[a:b]][once]
        rows = rows[np.argsort(n[rows], kind="stable")]
        if (print_ := node[rows].tobytes()) in seen:  # shingles of one passage have the same nodes
            continue
        seen.add(print_)
        widths = np.array([len(bits[i]) for i in rows])
        for width in np.unique(widths):
            # Bitmaps of twice the width are folded: sets of similar size differ in width by one step at most.
            own = rows[(widths == width) | (widths == 2 * width)]
            if len(own) < 2:
                continue
            flat = np.stack([bits[i] if len(bits[i]) == width else _folded(bits[i]) for i in own])
            found.update((int(node[own[i]]), int(node[own[j]])) for i, j in close_pairs(n[own], flat, mark[own], per_cent))
    links = sorted(found)
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _folded(words: np.ndarray) -> np.ndarray:
    """The bitmap of half the width: places agree modulo the width."""
    return words[:len(words) // 2] ^ words[len(words) // 2:]


def exact_links(nodes: np.ndarray, sets: list[np.ndarray], per_cent: int = SIMILARITY) -> list[tuple[int, int]]:
    """Links that hold together all sets joined by pairs of the similarity.

    In a large group a few representatives are compared with all sets first, each by one scan; true near copies are held
    together after that. Then only the sets outside the largest part are listed by their shingles, and every
    set looks up its overlaps with them, so a group of copies costs as much as its size and not its square.
    """
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    nodes, sets, n = nodes[order], [sets[i] for i in order], n[order]
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner, begin = np.repeat(np.arange(len(sets)), n), np.concatenate([[0], np.cumsum(n)])
    label, links = np.arange(len(sets)), []

    def link(i: int, others: np.ndarray) -> None:
        for j in others:
            x, y = label[i], label[j]
            if x != y:
                links.append((int(nodes[i]), int(nodes[j])))
                label[label == max(x, y)] = min(x, y)

    def similar(i: int, both: np.ndarray, others: np.ndarray) -> np.ndarray:
        return others[100 * both >= per_cent * (n[i] + n[others] - both)]

    everyone, used = np.arange(len(sets)), np.zeros(len(sets), dtype=bool)
    for _ in range(REPRESENTATIVES if len(sets) > LISTED_SETS else 0):
        outside = np.flatnonzero((label != np.bincount(label).argmax()) & ~used)
        if not len(outside):
            break
        # The middle one by size among those not yet held by the largest part.
        i = int(outside[len(outside) // 2])
        used[i] = True
        held = np.zeros(code.max() + 1, dtype=bool)
        held[code[begin[i]:begin[i + 1]]] = True
        near = similar(i, np.bincount(owner[held[code]], minlength=len(sets)), everyone)
        link(i, near[np.sort(np.unique(label[near], return_index=True)[1])])
    if label.max() == 0:
        return links
    largest = np.bincount(label).argmax() if len(sets) > LISTED_SETS else -1
    listed = label[owner] != largest
    by = np.flatnonzero(listed)[np.argsort(code[listed], kind="stable")]  # postings, owners ascending
    lists = np.searchsorted(code[by], np.arange(code.max() + 2))
    post = owner[by]
    main = label == largest
    for i in range(len(sets)):
        if label.max() == 0:
            break
        own = code[begin[i]:begin[i + 1]]
        sizes_ = lists[own + 1] - lists[own]
        ends = np.cumsum(sizes_)
        place = np.repeat(lists[own] - (ends - sizes_), sizes_) + np.arange(int(ends[-1]) if len(ends) else 0)
        both = np.bincount(post[place], minlength=len(sets))
        met = np.flatnonzero(both if main[i] else both[:i])  # sets outside the largest part meet each other once
        link(i, similar(i, both[met], met))
    return links


def similar_groups(docs: DataFrame, per_cent: int = SIMILARITY, k: int = SHINGLE, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the least doc_id reachable by links, itself included.

    Two rows link when 100 times the intersection of their shingle sets is at least ``per_cent`` times the union. A
    null or blank text has an empty set and links with nothing. Rows without an id link with nothing and have no
    component. Rows that share an id are rows of their own. An empty table gives no rows.
    """
    size = sizes(docs, text_col)
    heavy = heavy_cells(docs, text_col, k)
    rows = stored(_summaries(docs, heavy, id_col, text_col, k, per_cent), "sets")
    linked = rows.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    nodes = stored(linked.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")

    # The set of a node is read from its least row; whichever rows repeat it hold the same.
    own = (linked.select("doc_id", "node", "n", "first0", "first1", "bits").join(nodes, ["doc_id", "node"], "left_semi")
           .withColumn("_g", group_of(F.col("doc_id"), size)).repartition(size.partitions, "_g"))

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        asked = _Sets(table, size).ask()
        count = len(asked["_b"])
        return pa.table({"_b": pa.array(asked["_b"], pa.int32()), "_g": pa.array([key[0].as_py()] * count, pa.int32()),
                         **{c: pa.array(asked[c], pa.binary()) for c in ("hashes", "counts", "sums")}})

    def shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _shared(table)

    def entries(key: tuple[pa.Scalar, ...], table: pa.Table, said: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"_b": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in lists}})
        sets = _Sets(table, size)
        told = zip(said["blocks"].to_pylist(), said["sums"].to_pylist(), strict=True)
        sets.learn(dict(zip(said["_b"].to_pylist(), told, strict=True)))
        found = sets.entries()
        return pa.table({"_b": pa.array(found["_b"], pa.int32()), **{c: pa.array(found[c], pa.binary()) for c in lists}})

    def candidates(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _candidates(table, per_cent)

    lists = ("keys", "at", "node", "n", "marks", "bits")
    answers = (own.groupBy("_g").applyInArrow(ask, "_b int, _g int, hashes binary, counts binary, sums binary")
               .groupBy("_b").applyInArrow(shared, "_g int, _b int, blocks binary, sums binary"))
    entered = own.groupBy("_g").cogroup(answers.groupBy("_g")).applyInArrow(
        entries, "_b int, " + ", ".join(f"{c} binary" for c in lists))
    maybe = stored(components(entered.groupBy("_b").applyInArrow(candidates, "a long, b long")), "candidates")
    found = stored(components(_verified(docs, maybe, nodes, rows, id_col, text_col, k, per_cent)), "components")

    labelled = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = labelled.join(named, "component").select("node", "component_id")
    return (rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
            .join(by_node, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, per_cent: int = 80, k: int = 5) -> DataFrame:
    """The rows of ``docs`` without those of which a similar one with a smaller doc_id is in the same group.

    Rows without an id or words stay. Rows that share an id stay together if one of them has to.
    """
    found = similar_groups(docs, per_cent, k)
    gone = (found.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_gone"))
            .agg(F.max("component_id").alias("c")).filter("c < _gone").select("_gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def _verified(docs: DataFrame, maybe: DataFrame, nodes: DataFrame, rows: DataFrame, id_col: str, text_col: str, k: int,
              per_cent: int) -> DataFrame:
    """Exact links inside each candidate group; groups of many shingles are cut into blocks that meet two by two."""
    width = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(F.max("n").alias("n"))
    member = maybe.join(nodes, "node").join(width, "node")
    whole = member.groupBy("component").agg(F.ceil(F.sum("n") / F.lit(CELL_SHINGLES)).cast("int").alias("blocks"))
    member = (member.join(whole, "component")
              .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
              .withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(F.col("doc_id").alias("_id"), "node", F.xxhash64(
                  "component", F.least("block", "meets"), F.greatest("block", "meets")).alias("cell"), "n"))
    cells = stored(member, "members")
    total = cells.agg(F.sum("n")).first()[0] or 0
    parts = max(1, 4 * docs.sparkSession.sparkContext.defaultParallelism, -(-total // (CELL_SHINGLES // 4)))
    wanted = cells.groupBy("_id", "node").agg(F.collect_list("cell").alias("cells"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            for part in batches_of(texts, size=lambda t: len(t) if isinstance(t, str) else 0):
                rows = []
                for node, to, own in zip(batch["node"].iloc[part], batch["cells"].iloc[part], shingle_sets(texts[part], k), strict=True):
                    if len(own) and node_of(own) == node:  # another row with this id may hold another text
                        rows += [(int(cell % parts), int(cell), int(node), own.astype("<u8").tobytes()) for cell in to]
                yield pd.DataFrame(rows, columns=["_p", "cell", "node", "own"]).astype({"_p": "int32", "cell": "int64", "node": "int64"})

    def verify(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        cell, node = (np.array(table[c].to_pylist(), dtype=np.int64) for c in ("cell", "node"))
        data = table["own"].to_pylist()
        order = np.lexsort((node, cell))
        links = []
        for a, b in zip(edge := runs(cell[order]), np.append(edge[1:], len(order)), strict=True):
            rows = order[a:b][runs(node[order[a:b]])]
            if len(rows) > 1:
                links += exact_links(node[rows], [np.frombuffer(data[i], dtype="<u8") for i in rows], per_cent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(wanted, "_id")
    return (texts.select("text", "node", "cells").mapInPandas(sets, "_p int, cell long, node long, own binary")
            .groupBy("_p").applyInArrow(verify, "a long, b long"))
