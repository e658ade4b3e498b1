"""Sums over all pairs of members that share a group, in cells of blocks of members.

Members are numbered and dealt to blocks; a cell is a pair of blocks. A task reads groups whole and writes one message for
each cell: the members that its groups have in either block. A cell multiplies its messages and adds up, so every pair's
sum is made in one place: a row is shuffled once for each block, and no pair is shuffled. Groups too large for a task are
cut into parts, and every two parts meet as a group of their own. Nothing is capped. Where only the best of each member are
wanted, the cells of a block are one task (a strip), so a member's list leaves it once and not once for every other block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import stored, wide_partitions

#: Rows of the groups of a message, rows of one side of a cell, products added up at once, names of a row.
PACK_ROWS = 1 << 18
CELL_ROWS = 1 << 23
PRODUCTS = 1 << 20
NAMES = 1 << 16
# Sides in a large group: rows of one part pair up among themselves, those of two parts with the other side only.
_ANY, _LEFT, _RIGHT = 0, 1, 2
_KNOWN = 4
_SIDES = [(f"{side}_{name}", pa.binary()) for side in ("left", "right") for name in ("places", "values", "sides", "sizes")]
_MESSAGE = pa.schema([("cell", pa.int32()), ("kind", pa.string()), *_SIDES, ("block", pa.int32()), ("first", pa.int32()),
                      ("names", pa.list_(pa.string())), ("scales", pa.binary())])
_DDL = ("cell int, kind string, " + ", ".join(f"{name} binary" for name, _ in _SIDES)
        + ", block int, first int, names array<string>, scales binary")
_PAIRS = "item_1 string, item_2 string, sum double, n long"
_LISTS = "id string, item string, score double"


def numbered(df: DataFrame, column: str, name: str = "place") -> DataFrame:
    """``column, name``: the distinct values that are not null, with consecutive integers."""
    from .cf import dense_ids

    return stored(dense_ids(df.where(F.col(column).isNotNull()), column, name), "numbers")


def block_count(df: DataFrame) -> int:
    """Blocks of members: cells for all cores, and no more rows in a cell than a task holds."""
    return max(2, math.ceil(math.sqrt(4 * df.sparkSession.sparkContext.defaultParallelism)), math.ceil(2 * df.count() / CELL_ROWS))


def _cell(a, b, blocks: int):
    """Number of the cell of blocks a <= b."""
    return a * blocks - a * (a - 1) // 2 + b - a


def _planes(numbers: np.ndarray, kind: str) -> bytes:
    """All first bytes, then all second ones and so on: bytes that few numbers differ in take next to nothing in a shuffle."""
    data = np.ascontiguousarray(numbers.reshape(-1), dtype=kind)
    return data.view(np.uint8).reshape(-1, data.itemsize).T.tobytes()


def _numbers(data: bytes, kind: str) -> np.ndarray:
    """The numbers of :func:`_planes`."""
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _message(**parts) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([parts], schema=_MESSAGE)


def _spread(df: DataFrame, group: str, place: str, large: DataFrame | None) -> DataFrame:
    """Rows with ``_one, _two, _side``: those of a large group stand with every part of it."""
    if large is None:
        return df.select("*", F.lit(0).alias("_one"), F.lit(0).alias("_two"), F.lit(_ANY).alias("_side"))
    usual = _spread(df.join(large.select(group), group, "left_anti").select(*df.columns), group, place, None)
    parts = df.join(large, group).withColumn("_own", F.pmod(F.xxhash64(place), F.col("blocks")).cast("int"))
    parts = parts.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("_own") == F.col("_other"), _ANY).when(F.col("_own") < F.col("_other"), _LEFT).otherwise(_RIGHT)
    # Rows of one part meet in the part's own group only.
    return usual.unionByName(parts.select(*df.columns, F.least("_own", "_other").alias("_one"), F.greatest("_own", "_other").alias("_two"),
                                          side.alias("_side")))


def messages(df: DataFrame, group: str, place: str, values: list[str], blocks: int, large: DataFrame | None = None) -> DataFrame:
    """The rows of ``df`` (``group``, number ``place``, doubles ``values``) as messages to cells; rows without a group take no part."""
    keys = [group, "_one", "_two"]
    width, pack_rows = wide_partitions(df.sparkSession), PACK_ROWS
    known = F.lit(True)
    for c in values:
        known = known & F.col(c).isNotNull()
    rows = _spread(df.where(F.col(group).isNotNull() & F.col(place).isNotNull()), group, place, large).select(
        *keys, place, F.col("_side").cast("int").alias("_side"), known.alias("_known"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"v_{c}") for c in values])
    rows = rows.repartition(width, *keys).sortWithinPartitions(*keys)

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for key in keys:
            column = table[key].combine_chunks()
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    def packed(table: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        groups = np.zeros(table.num_rows, dtype=np.int64)
        groups[first[1:]] = 1
        groups = np.cumsum(groups)
        number = table[place].to_numpy().astype(np.int64)
        side = (table["_side"].to_numpy() + _KNOWN * table["_known"].to_numpy()).astype(np.uint8)
        numbers = np.stack([table[f"v_{c}"].to_numpy() for c in values], axis=1) if values else np.zeros((len(number), 0))
        order = np.argsort(number % blocks, kind="stable")
        bounds = np.searchsorted((number % blocks)[order], np.arange(blocks + 1))
        held = [order[bounds[b]:bounds[b + 1]] for b in range(blocks)]
        counts = [np.bincount(groups[h], minlength=len(first)) for h in held]
        for a in range(blocks):
            for b in range(a, blocks):
                both = (counts[a] > 0) & (counts[b] > 0) if a != b else counts[a] > 1
                if not both.any():
                    continue
                parts = {}
                for name, one in (("left", a), ("right", b))[:1 if a == b else 2]:
                    use = held[one][both[groups[held[one]]]]
                    parts.update({f"{name}_places": _planes(number[use] // blocks, "<i4"), f"{name}_values": _planes(numbers[use].T, "<f8"),
                                  f"{name}_sides": side[use].tobytes(), f"{name}_sizes": _planes(counts[one][both], "<i4")})
                yield _message(cell=_cell(a, b, blocks), kind="groups", **parts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count >= pack_rows:
                table = pa.Table.from_batches(held)
                first = starts(table)
                cut = int(first[-1])  # the last group may go on in the next batch
                if cut:
                    yield from packed(table.slice(0, cut), first[:-1])
                held, count = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
        if count:
            table = pa.Table.from_batches(held)
            yield from packed(table, starts(table))

    return rows.mapInArrow(pack, _DDL)


def _names(numbers: DataFrame, column: str, blocks: int, scale: str | None) -> DataFrame:
    """The members' names and scales as messages to all cells of their block, NAMES at a time."""
    rows = numbers.select(F.col(column).alias("name"), (F.col("place") % blocks).cast("int").alias("block"),
                          F.floor(F.col("place") / blocks).cast("int").alias("at"), (F.col(scale) if scale else F.lit(1.0)).cast("double").alias("scale"))
    rows = rows.withColumn("first", (F.floor(F.col("at") / NAMES) * NAMES).cast("int"))
    slots = F.struct("at", "name", "scale")
    chunks = rows.groupBy("block", "first").agg(F.array_sort(F.collect_list(slots)).alias("s"))
    pairs = [(_cell(min(a, b), max(a, b), blocks), a) for a in range(blocks) for b in range(blocks)]
    cells = numbers.sparkSession.createDataFrame(pairs, "cell int, block int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                names = [None] * (r["s"][-1]["at"] - r["first"] + 1)
                scales = np.zeros(len(names))
                for e in r["s"]:
                    names[e["at"] - r["first"]], scales[e["at"] - r["first"]] = e["name"], e["scale"]
                yield _message(cell=r["cell"], kind="names", block=r["block"], first=r["first"], names=names, scales=scales.astype("<f8").tobytes())

    return chunks.join(cells, "block").mapInArrow(pack, _DDL)


class _Side:
    """One side of a message: places, values, sides, and the group of every row."""

    def __init__(self, message: dict, name: str, width: int):
        self.places = _numbers(message[f"{name}_places"], "<i4")
        self.values = _numbers(message[f"{name}_values"], "<f8").reshape(width, len(self.places)).T
        self.sides = np.frombuffer(message[f"{name}_sides"], dtype=np.uint8)
        self.sizes = _numbers(message[f"{name}_sizes"], "<i4").astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        # The order inside a group is any; rows come in the order of their groups.
        self.groups = np.repeat(np.arange(len(self.sizes)), self.sizes)


def _products(left: _Side, right: _Side, own: bool, share: int, shares: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of both sides that pair up, for left places of one share, about ``step`` at a time (or one row's)."""
    rows = np.flatnonzero(left.places % shares == share) if shares > 1 else np.arange(len(left.places))
    many = right.sizes[left.groups[rows]]
    ends = np.cumsum(many)
    sided = bool((left.sides & 3).any() or (right.sides & 3).any())
    at = 0
    while at < len(rows):
        before = ends[at] - many[at]
        to = max(at + 1, int(np.searchsorted(ends, before + step, side="right")))
        times = many[at:to]
        one = np.repeat(rows[at:to], times)
        two = np.repeat(right.first[left.groups[rows[at:to]]] - (ends[at:to] - times - before), times) + np.arange(int(times.sum()))
        keep = left.places[one] < right.places[two] if own else None
        if sided:
            a, b = left.sides[one] & 3, right.sides[two] & 3
            fits = (a == _ANY) | (a != b)
            keep = fits if keep is None else keep & fits
        yield (one, two) if keep is None else (one[keep], two[keep])
        at = to


def _read(rows: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, list, list, list]]:
    """Cell by cell: messages of groups as pairs of sides, ready pairs, and names; rows come sorted by cell."""
    now, groups, ready, names = None, [], [], []
    for batch in rows:
        for message in batch.to_pylist():
            if message["cell"] != now:
                if now is not None:
                    yield now, groups, ready, names
                now, groups, ready, names = message["cell"], [], [], []
            if message["kind"] == "names":
                names.append((message["block"], message["first"], message["names"], np.frombuffer(message["scales"], dtype="<f8")))
            elif message["kind"] == "pairs":
                ready.append(tuple(_numbers(message[c], d) for c, d in (
                    ("left_places", "<i4"), ("right_places", "<i4"), ("left_values", "<f8"), ("left_sides", "u1"))))
            else:
                left = _Side(message, "left", width)
                groups.append((left, left if message["right_places"] is None else _Side(message, "right", width)))
    if now is not None:
        yield now, groups, ready, names


def _shares(groups: list, step: int, extra: int = 0) -> int:
    return max(1, -(-(sum(int((a.sizes * b.sizes).sum()) for a, b in groups) + extra) // (2 * step)))


def _blocks_of(cell: int, blocks: int) -> tuple[int, int]:
    for a in range(blocks):
        if cell < _cell(a + 1, a + 1, blocks):
            return a, a + cell - _cell(a, a, blocks)
    raise ValueError(cell)


def _by_cell(sent: DataFrame, blocks: int) -> DataFrame:
    return sent.repartitionById(_cell(blocks - 1, blocks - 1, blocks) + 1, F.col("cell")).sortWithinPartitions("cell")


def _by_strip(sent: DataFrame, blocks: int) -> DataFrame:
    """Messages by strip, cell ``a * blocks + b`` in the strip of block a: those of two blocks go to both. Few strips are cut for the sake of idle cores."""
    spark = sent.sparkSession
    cut = max(1, -(-2 * spark.sparkContext.defaultParallelism // blocks))
    cells = [(_cell(min(a, b), max(a, b), blocks), a * blocks + b, a * cut + b % cut) for a in range(blocks) for b in range(blocks)]
    placed = sent.withColumnRenamed("cell", "_of").join(spark.createDataFrame(cells, "_of int, cell int, _task int"), "_of")
    return placed.repartitionById(blocks * cut, F.col("_task")).sortWithinPartitions("cell").select(*sent.columns)


def pair_sums(sent: DataFrame, numbers: DataFrame, column: str, blocks: int, width: int, term: Callable[[np.ndarray, np.ndarray], np.ndarray] | None,
              scale: str | None = None, best: int | None = None) -> DataFrame:
    """``item_1, item_2, sum, n``: per pair of members the sum of their terms over all groups and how many there are.

    ``sent`` holds :func:`messages` whose places are those of ``numbers`` (``column, place``). ``term`` makes a term of two rows'
    values (None: only counts); a sum is null where no term is known, and multiplied by both members' ``scale``. Pairs with a
    member that ``numbers`` lacks are left out. With ``best`` the result is ``id, item, score``: of every cell at least the
    ``best`` highest of every member, both directions, compared to twelve places, ties by item.
    """
    step, chunk = PRODUCTS, NAMES

    def summed(groups: list, ready: list, own: bool, share: int, shares: int, stride: int):
        keys, values, known, held = [], [], [], 0

        def fold() -> None:
            nonlocal held
            if not keys:
                return
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.arange(0)
            add = (lambda parts: np.add.reduceat(np.concatenate(parts)[order], first)) if len(first) else (lambda parts: np.concatenate(parts))
            keys[:], values[:], known[:] = [key[first]], [add(values)], [add(known)]
            held = 0

        for left, right in groups:
            for one, two in _products(left, right, own, share, shares, step):
                sure = ((left.sides[one] & right.sides[two] & _KNOWN) > 0)
                keys.append(left.places[one].astype(np.int64) * stride + right.places[two])
                values.append(np.where(sure, term(left.values[one], right.values[two]), 0.0) if term else np.zeros(len(one)))
                known.append(sure.astype(np.int64))
                held += len(one)
                if held >= 2 * step:
                    fold()
        for left, right, value, sides in ready:
            use = left % shares == share
            keys.append(left[use].astype(np.int64) * stride + right[use])
            values.append(value[use])
            known.append((sides[use] > 0).astype(np.int64))
        fold()
        return (keys[0], values[0], known[0]) if keys else (np.arange(0), np.zeros(0), np.arange(0))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, held = None, None
        for cell, groups, ready, parts in _read(rows, width):
            a, b = divmod(cell, blocks) if best else _blocks_of(cell, blocks)
            if a > b:
                groups, ready = [(right, left) for left, right in groups], [(right, left, *rest) for left, right, *rest in ready]
            if strip != a and held:
                yield from listed(held)
            if strip != a:
                strip, held = a, None
            words, scales, offset = [], [], {}
            for block in dict.fromkeys((a, b)):
                offset[block] = len(words)
                for _, first, names, factor in sorted((p for p in parts if p[0] == block), key=lambda p: p[1]):
                    gap = offset[block] + first - len(words)
                    words += [None] * gap + names
                    scales += [np.zeros(gap), factor]
                # A place that numbers lack has no name.
                most = max([int(x.places.max(initial=-1)) for pair in groups for x, of in zip(pair, (a, b)) if of == block]
                           + [int(r[i].max(initial=-1)) for r in ready for i, of in ((0, a), (1, b)) if of == block] + [-1]) + 1
                gap = offset[block] + most - len(words)
                if gap > 0:
                    words += [None] * gap
                    scales.append(np.zeros(gap))
            names, scales = pa.array(words, pa.string()), np.concatenate(scales) if scales else np.zeros(0)
            named = names.is_valid().to_numpy(zero_copy_only=False)
            rank = np.empty(len(words), dtype=np.int64)
            rank[pc.sort_indices(names).to_numpy()] = np.arange(len(words))
            stride = max(1, len(words))
            shares, later = _shares(groups, step, sum(len(r[0]) for r in ready)), []
            for share in range(shares):
                key, value, count = summed(groups, ready, a == b, share, shares, stride)
                left, right = key // stride + offset[a], key % stride + offset[b]
                use = named[left] & named[right]
                left, right, value, count = left[use], right[use], value[use] * scales[left[use]] * scales[right[use]], count[use]
                if best is None:
                    turn = rank[left] > rank[right]
                    one, two = np.where(turn, right, left), np.where(turn, left, right)
                    for at in range(0, len(one), chunk):
                        part = slice(at, at + chunk)
                        yield pa.RecordBatch.from_arrays([names.take(pa.array(one[part])), names.take(pa.array(two[part])),
                                                          pa.array(value[part], mask=count[part] == 0), pa.array(count[part])], ["item_1", "item_2", "sum", "n"])
                    continue
                lost = count == 0
                # A left member's pairs are all in this share; in a block's own cell it is also found as a right one, share by share.
                later.append(leading(left, right, value, lost, rank))
                if a == b:
                    later.append(leading(right, left, value, lost, rank))
                    if sum(len(x[0]) for x in later) > 4 * step:
                        later = [leading(*(np.concatenate(x) for x in zip(*later)), rank)]
            if later:
                own, other, value, lost = (np.concatenate(x) for x in zip(*later))
                held = merged(held, names.slice(0, offset[b] or None), own, names.take(pa.array(other)), value, lost)
                if len(held[1]) > 2 * best * len(held[0]):  # equal scores
                    yield from listed(held)
                    held = None
        if held:
            yield from listed(held)

    def leading(own: np.ndarray, other: np.ndarray, value: np.ndarray, lost: np.ndarray, rank: np.ndarray):
        # NaN comes first in Spark's falling order, an unknown sum last.
        shown = np.where(lost, -np.inf, np.where(np.isnan(value), np.inf, np.round(value, 12)))
        order = np.lexsort((rank[other], -shown, own))
        kept = order[np.arange(len(own)) - np.searchsorted(own[order], own[order]) < best]
        return own[kept], other[kept], value[kept], lost[kept]

    def merged(held: tuple | None, names: pa.Array, own: np.ndarray, items: pa.Array, value: np.ndarray, lost: np.ndarray) -> tuple:
        """What a strip holds and what its next cell adds: of each member the ``best`` first and what equals the last of them, as names decide later."""
        if held:
            own, value, lost = (np.concatenate(x) for x in zip((held[1], held[3], held[4]), (own, value, lost)))
            items = pa.concat_arrays([held[2], items])
        shown = np.where(lost, -np.inf, np.where(np.isnan(value), np.inf, np.round(value, 12)))
        order = np.lexsort((-shown, own))
        start = np.searchsorted(own[order], own[order])
        last = np.minimum(start + best, np.searchsorted(own[order], own[order], side="right")) - 1
        kept = order[shown[order] >= shown[order][last]]
        return names, own[kept], items.take(pa.array(kept)), value[kept], lost[kept]

    def listed(held: tuple) -> Iterator[pa.RecordBatch]:
        names, own, items, value, lost = held
        for at in range(0, len(own), chunk):
            part = slice(at, at + chunk)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(own[part])), items[part], pa.array(value[part], mask=lost[part])], ["id", "item", "score"])

    everything = sent.unionByName(_names(numbers, column, blocks, scale))
    everything = _by_strip(everything, blocks) if best else _by_cell(everything, blocks)
    return everything.mapInArrow(run, _PAIRS if best is None else _LISTS)


def shared_pairs(sent: DataFrame, blocks: int, width: int, item_blocks: int,
                 term: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Item pairs that two users share, as messages to the cells of the items.

    ``sent`` holds :func:`messages` of users grouped by item, the item's number as first value. ``term`` makes a term of the number
    of items two users share and both users' values at either item. A pair of users is put together in one cell.
    """
    step = PRODUCTS

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, groups, _, _ in _read(rows, width):
            a, b = _blocks_of(cell, blocks)
            stride = max([int(x.places.max(initial=0)) for pair in groups for x in pair] + [0]) + 1
            shares = _shares(groups, step)
            for share in range(shares):
                found = [(left, one, right, two) for left, right in groups for one, two in _products(left, right, a == b, share, shares, step)]
                keys = np.concatenate([f[0].places[f[1]].astype(np.int64) * stride + f[2].places[f[3]] for f in found] or [np.arange(0)])
                u = np.concatenate([f[0].values[f[1]] for f in found] or [np.zeros((0, width))])
                v = np.concatenate([f[2].values[f[3]] for f in found] or [np.zeros((0, width))])
                sure = np.concatenate([(f[0].sides[f[1]] & f[2].sides[f[3]] & _KNOWN) > 0 for f in found] or [np.zeros(0, bool)])
                order = np.lexsort((u[:, 0], keys))
                keys = keys[order]
                new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                sizes = np.diff(np.concatenate([first, [len(keys)]]))
                long = np.repeat(sizes > 1, sizes)
                order, new = order[long], new[long]
                u, v, sure = u[order], v[order], sure[order]
                sizes = sizes[sizes > 1]
                if not len(sizes):
                    continue
                run_of = np.cumsum(new) - 1
                fresh = np.concatenate([[True], u[1:, 0] != u[:-1, 0]]) | new
                shared = np.bincount(run_of, weights=fresh)
                ends = np.cumsum(sizes)[run_of]
                many = ends - np.arange(len(u)) - 1
                upto = np.cumsum(many)
                at = 0
                while at < len(u):  # rows whose item pairs fit a step
                    before = upto[at] - many[at]
                    to = max(at + 1, int(np.searchsorted(upto, before + step, side="right")))
                    one = np.repeat(np.arange(at, to), many[at:to])
                    two = one + 1 + np.arange(len(one)) - np.repeat(upto[at:to] - many[at:to] - before, many[at:to])
                    differ = u[one, 0] != u[two, 0]
                    one, two = one[differ], two[differ]
                    known = sure[one] & sure[two]
                    yield from paired(u[one, 0].astype(np.int64), u[two, 0].astype(np.int64),
                                      np.where(known, term(shared[run_of[one]], u[one], v[one], u[two], v[two]), 0.0), known)
                    at = to

    def paired(x: np.ndarray, y: np.ndarray, value: np.ndarray, known: np.ndarray) -> Iterator[pa.RecordBatch]:
        turn = (x % item_blocks > y % item_blocks) | ((x % item_blocks == y % item_blocks) & (x > y))
        x, y = np.where(turn, y, x), np.where(turn, x, y)
        cells = _cell(x % item_blocks, y % item_blocks, item_blocks)
        order = np.lexsort((y, x, cells))
        x, y, cells, value, known = x[order], y[order], cells[order], value[order], known[order]
        first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])) if len(x) else np.arange(0)
        if not len(first):
            return
        x, y, cells, value, known = x[first], y[first], cells[first], np.add.reduceat(value, first), np.add.reduceat(known.astype(np.int64), first) > 0
        for cell in np.unique(cells):
            part = slice(*np.searchsorted(cells, [cell, cell + 1]))
            yield _message(cell=int(cell), kind="pairs", left_places=_planes(x[part] // item_blocks, "<i4"),
                           right_places=_planes(y[part] // item_blocks, "<i4"), left_values=_planes(value[part], "<f8"),
                           left_sides=known[part].astype(np.uint8).tobytes())

    return _by_cell(sent, blocks).mapInArrow(run, _DDL)
