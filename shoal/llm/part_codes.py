"""Codes for vectors: each is cut into parts, and a part is replaced by the nearest entry of its codebook.

The codebooks are moved by rounds of assigning all parts and averaging. Vectors are kept in blocks, and each block has
a metric tree for each part, made once from anchors: the point furthest from its anchor becomes a new anchor and
takes the points that are nearer to it (only those more than half the anchors' distance away need a look); about
sqrt(n) anchors are balls in the middle, merged upwards two by two and split downwards the same way. A ball holds the sum and
the number of its points.

A round walks the trees with lists of entries. For the ball's nearest entry and any other one the difference of
squared distances is linear, so its least value over the ball follows from centre and radius; where it is above
0, the other entry leaves the list, and the balls inside inherit the shorter list. When one entry is left the ball is
wholly its own and gives it sum and number at once. Leaves compare exactly, in whole numbers, with the entries left.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.session import scratch_path, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Numbers of one block of vectors (at least 64 vectors), and points of a leaf.
BLOCK_NUMBERS = 1 << 18
LEAF = 48
#: Whole numbers from here on would overflow squared distances.
LARGEST = 1 << 26
_SALTS = 16


class Tree(NamedTuple):
    """Balls over points in the tree's order: ball i has points start[i] to end[i] and children left[i], right[i] (-1: leaf)."""

    order: np.ndarray
    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sums: np.ndarray
    radius: np.ndarray


def anchors(points: np.ndarray, many: int) -> np.ndarray:
    """Owner of each point among at most ``many`` anchors; fewer when all points are anchors or copies of one."""
    owner = np.zeros(len(points), dtype=np.int64)
    away = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    pivots = [points[0]]
    while len(pivots) < many:
        far = int(np.argmax(away))
        if away[far] == 0:
            break
        new = points[far]
        apart = np.sqrt(((np.array(pivots) - new) ** 2).sum(axis=1))
        near = np.flatnonzero(2 * away > apart[owner])
        own = np.sqrt(((points[near] - new) ** 2).sum(axis=1))
        taken = own < away[near]
        owner[near[taken]], away[near[taken]] = len(pivots), own[taken]
        pivots.append(new)
    return owner


def _merged(centres: np.ndarray, radii: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of balls to merge, the pair with the smallest ball around both first; ball n + i is the i-th merged one."""
    names = list(range(len(radii)))
    centres, radii, sizes = centres.copy(), radii.copy(), sizes.astype(np.float64)

    def around(i: int, others: np.ndarray) -> np.ndarray:
        """Radius that the ball of i and each other one needs about their common centre."""
        gap = np.sqrt(((centres[others] - centres[i]) ** 2).sum(axis=1))
        share = sizes[others] / (sizes[others] + sizes[i])
        return np.maximum(gap * share + radii[i], gap * (1 - share) + radii[others])

    n = len(radii)
    cost = np.full((n, n), np.inf)
    for i in range(n - 1):
        cost[i, i + 1:] = around(i, np.arange(i + 1, n))
    pairs, live = [], np.ones(n, dtype=bool)
    for step in range(n - 1):
        i, j = divmod(int(np.argmin(cost)), n)
        pairs.append((names[i], names[j]))
        whole = sizes[i] + sizes[j]
        radius = cost[i, j]
        centres[i] = (centres[i] * sizes[i] + centres[j] * sizes[j]) / whole
        radii[i], sizes[i], names[i], live[j] = radius, whole, n + step, False
        cost[j], cost[:, j], cost[i], cost[:, i] = np.inf, np.inf, np.inf, np.inf
        others = np.flatnonzero(live)
        others = others[others != i]
        values = around(i, others)
        after = others > i
        cost[i, others[after]], cost[others[~after], i] = values[after], values[~after]
    return pairs


def tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of the rows of ``points`` (whole numbers), built from the middle out."""
    exact = points.astype(np.int64)
    points = exact.astype(np.float64)
    children: list[tuple[int, int]] = [(-1, -1)]
    members: dict[int, np.ndarray] = {}
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, own = todo.pop()
        some = points[own]
        owner = anchors(some, int(np.ceil(np.sqrt(len(own))))) if len(own) > leaf else np.zeros(len(own), dtype=np.int64)
        n = int(owner.max(initial=0)) + 1
        if n == 1:
            members[node] = own
            continue
        sizes = np.bincount(owner, minlength=n)
        used = np.flatnonzero(sizes)
        sums = np.zeros((n, points.shape[1]))
        np.add.at(sums, owner, some)
        centres = sums[used] / sizes[used, None]
        place = np.zeros(n, dtype=np.int64)
        place[used] = np.arange(len(used))
        away = np.sqrt(((some - centres[place[owner]]) ** 2).sum(axis=1))
        radii = np.zeros(len(used))
        np.maximum.at(radii, place[owner], away)
        names = list(range(len(children), len(children) + len(used)))
        children += [(-1, -1)] * len(used)
        pairs = _merged(centres, radii, sizes[used])
        for i, (a, b) in enumerate(pairs):
            last = i == len(pairs) - 1
            names.append(node if last else len(children))
            if last:
                children[node] = names[a], names[b]
            else:
                children.append((names[a], names[b]))
        rank = np.argsort(place[owner], kind="stable")
        for name, part in zip(names, np.split(own[rank], np.cumsum(sizes[used])[:-1]), strict=False):
            todo.append((name, part))
    start, end = np.zeros(len(children), dtype=np.int64), np.zeros(len(children), dtype=np.int64)
    order, at, stack = [], 0, [(0, False)]
    while stack:
        node, left_done = stack.pop()
        a, b = children[node]
        if left_done:
            end[node] = at
            continue
        start[node] = at
        stack.append((node, True))
        if a < 0:
            order.append(members[node])
            at += len(members[node])
        else:
            stack += [(b, False), (a, False)]
    order = np.concatenate(order)
    exact, points = exact[order], points[order]
    running = np.concatenate([np.zeros((1, points.shape[1]), dtype=np.int64), np.cumsum(exact, axis=0)])
    sums = running[end] - running[start]
    centres = sums / np.maximum(end - start, 1)[:, None]
    radius = np.array([np.sqrt(((points[a:b] - c) ** 2).sum(axis=1).max(initial=0)) for a, b, c in zip(start, end, centres, strict=True)])
    left, right = np.array(children, dtype=np.int64).T
    return Tree(order.astype(np.int32), exact.astype(np.int32), start, end, left, right, sums, radius)


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places from each start to its end, one range after the other."""
    size = end - start
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def assign(ball: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest entry of each point in the tree's order, ties to the lower index; sums and numbers per entry; exact comparisons.

    Owned balls give their cached sums. An entry equal to an earlier one never wins and is left out from the start.
    """
    _, first = np.unique(entries, axis=0, return_index=True)
    live = np.zeros(len(entries), dtype=bool)
    live[first] = True
    floats = entries.astype(np.float64)
    gap = np.sqrt(((floats[:, None] - floats[None]) ** 2).sum(axis=2))
    code = np.zeros(len(ball.points), dtype=np.int64)
    sums, numbers = np.zeros(entries.shape, dtype=np.int64), np.zeros(len(entries), dtype=np.int64)
    front, lists, looked = np.zeros(1, dtype=np.int64), live[None], 0
    while len(front):
        count = ball.end[front] - ball.start[front]
        centre = ball.sums[front] / np.maximum(count, 1)[:, None]
        distance = ((centre[:, None] - floats[None]) ** 2).sum(axis=2)
        distance[~lists] = np.inf
        best = np.argmin(distance, axis=1)
        reach = 2 * ball.radius[front][:, None] * gap[best]
        least = distance - distance[np.arange(len(front)), best][:, None] - reach
        with np.errstate(invalid="ignore"):
            lists = lists & ~(least > 1e-9 * (1 + distance + reach))
        owned = lists.sum(axis=1) == 1
        nodes, winner = front[owned], best[owned]
        np.add.at(sums, winner, ball.sums[nodes])
        np.add.at(numbers, winner, count[owned])
        code[_ranges(ball.start[nodes], ball.end[nodes])] = np.repeat(winner, count[owned])
        open_leaf = ~owned & (ball.left[front] < 0)
        nodes = front[open_leaf]
        for at in range(0, len(nodes), 256):
            some = nodes[at:at + 256]
            places = _ranges(ball.start[some], ball.end[some])
            own = ball.points[places].astype(np.int64)
            allowed = np.repeat(lists[open_leaf][at:at + 256], ball.end[some] - ball.start[some], axis=0)
            exact = np.full(allowed.shape, np.iinfo(np.int64).max)
            for k in np.flatnonzero(allowed.any(axis=0)):
                listed = np.flatnonzero(allowed[:, k])
                exact[listed, k] = ((own[listed] - entries[k]) ** 2).sum(axis=1)
            winner = np.argmin(exact, axis=1)
            looked += int(allowed.sum())
            code[places] = winner
            np.add.at(sums, winner, own)
            numbers += np.bincount(winner, minlength=len(entries))
        inner = ~owned & ~open_leaf
        nodes, lists = front[inner], lists[inner]
        front = np.concatenate([ball.left[nodes], ball.right[nodes]])
        lists = np.concatenate([lists, lists])
    return code, sums, numbers, looked


def _packed(trees: list[Tree]) -> bytes:
    held = io.BytesIO()
    np.savez(held, **{f"{p}_{name}": getattr(t, name) for p, t in enumerate(trees) for name in Tree._fields})
    return held.getvalue()


def _unpacked(data: bytes) -> list[Tree]:
    held = np.load(io.BytesIO(data))
    parts = 1 + max(int(name.split("_")[0]) for name in held.files)
    return [Tree(*(held[f"{p}_{name}"] for name in Tree._fields)) for p in range(parts)]


def _blocks(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """``ids``, ``labels`` and ``trees`` of each block of vectors, which stay in their partition."""
    size, each = max(64, BLOCK_NUMBERS // max(width, 1)), width // parts

    def block(ids: list, labels: list, vectors: list) -> dict:
        numbers = np.zeros((len(vectors), width), dtype=np.int64)
        for i, own in enumerate(vectors):
            numbers[i, :len(own)] = own
        if len(numbers) and max(-int(numbers.min(initial=0)), int(numbers.max(initial=0))) >= LARGEST:
            raise ValueError(f"components must be below {LARGEST} after scaling")
        trees = [tree(numbers[:, p * each:(p + 1) * each]) for p in range(parts)]
        return {"ids": [None if pd.isna(i) else int(i) for i in ids], "labels": labels, "trees": _packed(trees)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, labels, vectors = [], [], []
        for batch in batches:
            for vec_id, label, own in zip(batch["vec_id"], batch["label"], batch["numbers"], strict=True):
                ids.append(vec_id)
                labels.append(None if pd.isna(label) else label)
                vectors.append(own)
                if len(ids) == size:
                    yield pd.DataFrame([block(ids, labels, vectors)])
                    ids, labels, vectors = [], [], []
        if ids:
            yield pd.DataFrame([block(ids, labels, vectors)])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInPandas(run, f"ids array<bigint>, labels array<{kind}>, trees binary")


def _moved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round. Every task sends one row for each number of the codebooks."""
    parts, entries, each = books.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, numbers = np.zeros(books.shape, dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for data in batch["trees"]:
                for p, ball in enumerate(_unpacked(data)):
                    _, own, count, _ = assign(ball, books[p])
                    sums[p] += own
                    numbers[p] += count
        place = np.arange(books.size)
        yield pd.DataFrame({"place": place, "s": sums.ravel(), "n": np.repeat(numbers.ravel(), each)})[np.repeat(numbers.ravel() > 0, each)]

    total = (blocks.select("trees").mapInPandas(run, "place long, s long, n long").groupBy("place")
             .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toPandas())
    new = books.ravel().copy()
    at = total["place"].to_numpy(dtype=np.int64)
    new[at] = total["s"].to_numpy(dtype=np.int64) // total["n"].to_numpy(dtype=np.int64)
    return new.reshape(books.shape)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of each vector and the codebooks as an array of (part, entry, place).

    Needs ``vec_id``, ``label`` and ``numbers``, an array of whole numbers; rows whose ``numbers`` are null take no part,
    other columns aren't read. The codebooks begin as the parts of the ``entries`` smallest ids (repeated ids in order of
    their numbers, null ids last; all, if there are fewer). Vectors shorter than the longest, or than a multiple of ``parts``, are
    filled up with zeros. Repeated rows are vectors of their own. An empty table gives no rows and no entries.
    """
    spark = vectors.sparkSession
    rows = vectors.filter("numbers IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                                                         F.col("numbers").cast("array<bigint>").alias("numbers"))
    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    longest = rows.agg(F.max(F.size("numbers"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], schema), np.zeros((parts, 0, 0), dtype=np.int64)
    width = -(-max(longest, 1) // parts) * parts
    first = [r["numbers"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()]
    books = np.zeros((len(first), width), dtype=np.int64)
    for i, own in enumerate(first):
        books[i, :len(own)] = own
    books = np.ascontiguousarray(books.reshape(len(first), parts, width // parts).transpose(1, 0, 2))
    path = scratch_path(spark, "trees")
    _blocks(rows, width, parts).write.parquet(path)
    blocks = spark.read.parquet(path)
    for _ in range(rounds):
        books = _moved(blocks, books)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, labels, data in zip(batch["ids"], batch["labels"], batch["trees"], strict=True):
                codes, error = np.zeros((len(ids), parts), dtype=np.uint8 if entries <= 256 else np.int64), np.zeros(len(ids), dtype=np.int64)
                for p, ball in enumerate(_unpacked(data)):
                    code = assign(ball, books[p])[0]
                    codes[ball.order, p] = code
                    error[ball.order] += ((ball.points.astype(np.int64) - books[p][code]) ** 2).sum(axis=1)
                yield pd.DataFrame({"vec_id": pd.array(list(ids), dtype="Int64"), "label": pd.Series(list(labels), dtype=object),
                                    "code": ["".join(f"{x:02x}" for x in own) for own in codes.tolist()], "error": error})

    return blocks.mapInPandas(run, schema), books


def codebooks_sha256(books: np.ndarray) -> str:
    """Hex digest of all numbers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """The rows with ``label_error``, the error summed over equal labels, nulls together; a frequent label is shared out by salt."""
    kept = stored(coded, "codes")
    sums = kept.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    sums = sums.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(_SALTS)).cast("int")
    return (kept.withColumn("_salt", salt).join(sums, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_part")))
            .drop("_label", "_salt", "_part"))
