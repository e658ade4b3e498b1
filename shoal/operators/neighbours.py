"""Nearest neighbours of vectors, exact and by random projection."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .balls import nearest
from .topn import top_n
from .vectors import NEAREST, best_per_row, reaching, similarities

# Vectors of one side that one task compares with a block of the other side.
BLOCK_ROWS = 2048
# Blocks of a side that a task takes where all blocks meet.
BUNCH = 16
# Rows below which a block is not cut further for the sake of idle cores.
SMALL_BLOCK = 256
# Multi-probe: rows a bucket should have, signs a query may flip, and vectors the setting is fitted on.
BUCKET_ROWS = 64
FLIPPED = 10
LSH_SAMPLE = 128

def vectors_of(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))


def grid(left: DataFrame, right: DataFrame, keys: list[str], member: str, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Spread two sides over block pairs, per key or over everything.

    Each side is cut into blocks of about ``block_rows`` rows by a hash of
    ``member``; every left row is sent to each block of the right side and the
    other way round. A pair of rows meets in exactly one cell.
    """

    def blocks(df: DataFrame, name: str):
        return (df.groupBy(*keys) if keys else df.groupBy()).agg(
            F.greatest(F.lit(1), F.ceil(F.count("*") / block_rows)).cast("int").alias(name))

    lb, rb = blocks(left, "_lb"), blocks(right, "_rb")
    if keys:
        sizes = lb.join(rb, keys)
        left, right = left.join(sizes, keys), right.join(sizes, keys)
    else:
        left = left.withColumn("_lb", lb.scalar()).withColumn("_rb", rb.scalar())
        right = right.withColumn("_lb", lb.scalar()).withColumn("_rb", rb.scalar())
    block = lambda n: F.pmod(F.xxhash64(F.col(member)), F.col(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # Fresh column instances on one side, for both may come from one frame.
    right = right.select([F.col(c).alias(c) for c in right.columns])
    left = left.withColumn("_row", block("_lb")).withColumn("_col", others("_rb"))
    right = right.withColumn("_col", block("_rb")).withColumn("_row", others("_lb"))
    return left.drop("_lb", "_rb"), right.drop("_lb", "_rb")


def all_pairs_top_n(rows: DataFrame, member: str, block_rows: int, scores_of: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray],
                    n: int, floor: float | None = None, keep_self: bool = False) -> DataFrame:
    """``id, item, score``: the best entries of a symmetric score, every block pair computed once.

    Rows are dealt to bunches of BUNCH blocks by a hash of ``member``; a row is sent to the cells of its bunch with every other
    bunch, in the upper triangle only. A cell compares its blocks two by two and yields the n best of its rows in both
    directions, so at most 2n rows per row and cell leave it.
    """
    # Enough cells for all cores, unless blocks would become small.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    spread = F.least(F.lit(math.ceil(math.sqrt(2 * cores))), F.ceil(F.count("*") / SMALL_BLOCK))
    blocks = rows.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / (BUNCH * block_rows)), spread).cast("int").alias("n")).scalar()
    placed = (rows.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks"))
    cells = placed.withColumn("_row", F.least("_block", "_other")).withColumn("_col", F.greatest("_block", "_other")).drop("_other")

    def best(frames: list[pd.DataFrame]) -> pd.DataFrame:
        found = pd.concat(frames).sort_values(["id", "score", "item"], ascending=[True, False, True], kind="stable")
        return found.groupby("id", sort=False, dropna=False).head(n)

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(member, kind="stable")
        left, right = cell[cell["_block"] == cell["_row"]], cell[cell["_block"] == cell["_col"]]
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "item": [], "score": []})
        own = cell["_row"].iloc[0] == cell["_col"].iloc[0]
        cut = lambda side: [side.iloc[at:at + block_rows] for at in range(0, len(side), block_rows)]
        lefts, rights, found, later = cut(left), cut(right), [], []
        for i, x in enumerate(lefts):
            mine = []
            for j, y in enumerate(rights):
                if own and j < i:
                    continue
                scores = scores_of(x, y)
                a, b = x[member].to_numpy(), y[member].to_numpy()
                mine.append(best_per_row(scores.copy(), a, b, n, floor, keep_self))
                if not own or i != j:
                    later.append(best_per_row(scores.T.copy(), b, a, n, floor, keep_self))
            found.append(best(mine))
            later = [best(later)] if later else []
        return pd.concat(found + later)

    return cells.groupBy("_row", "_col").applyInPandas(compare, NEAREST)


def _nearest_in_cells(queries: DataFrame, candidates: DataFrame, cell: list[str], metric: str, n: int,
                      floor: float | None, keep_self: bool, block_rows: int) -> DataFrame:
    """Top-n of every query inside each cell, compared block by block; only n rows per query leave a cell."""

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "item": [], "score": []})
        matrix, items = np.stack(right["vector"].to_numpy()), right["id"].to_numpy(dtype=object)
        blocks = [(0, matrix[at:at + block_rows], items[at:at + block_rows]) for at in range(0, len(items), block_rows)]
        found = []
        for at in range(0, len(left), block_rows):
            part = left.iloc[at:at + block_rows]
            found.append(reaching(part["id"].to_numpy(dtype=object), np.stack(part["vector"].to_numpy()), np.full(len(part), -np.inf),
                                  np.ones((len(part), 1), dtype=bool), blocks, lambda a, b: similarities(a, b, metric), n, floor, keep_self))
        return pd.DataFrame({c: np.concatenate([f[c].to_numpy(dtype=object) for f in found]) for c in ("id", "item", "score")}).astype({"score": "float64"})

    return queries.groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInPandas(compare, NEAREST)


def _candidates(vectors: DataFrame, allow: DataFrame | None, deny: DataFrame | None) -> DataFrame:
    for frame, how in ((allow, "left_semi"), (deny, "left_anti")):
        if frame is not None:
            ids = frame.select(F.col(frame.columns[0]).cast("string").alias("id")).distinct()
            vectors = vectors.join(ids, "id", how)
    return vectors


def _finish(near: DataFrame, n: int, metric: str) -> DataFrame:
    ranked = top_n(near, ["id"], [F.desc("score"), F.asc("item")], n)
    return ranked.withColumn("score", -F.col("score")) if metric == "euclidean" else ranked


def knn(vectors: DataFrame, n: int = 100, metric: str = "cosine", min_similarity: float | None = None,
        max_distance: float | None = None, allow: DataFrame | None = None, deny: DataFrame | None = None,
        keep_self: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id, item, score, rank``: the n nearest allowed items of every vector, exactly.

    ``vectors`` holds ``id, vector``. ``score`` is the cosine similarity (higher
    first) or the Euclidean distance (lower first). Vectors are dealt into balls
    (:mod:`.balls`); headers of the balls tell which of them a vector has to be
    compared with before it is sent anywhere. ``allow`` and ``deny`` act on the
    neighbours.
    """
    floor = min_similarity if metric == "cosine" else (None if max_distance is None else -max_distance)
    flagged, allowed = vectors.select("id", "vector").where(F.col("vector").isNotNull()), F.lit(True)
    for frame, name in ((allow, "_allow"), (deny, "_deny")):
        if frame is not None:
            ids = frame.select(F.col(frame.columns[0]).cast("string").alias("id")).distinct().withColumn(name, F.lit(True))
            flagged = flagged.join(ids, "id", "left")
            allowed = allowed & (F.col(name).isNotNull() if name == "_allow" else F.col(name).isNull())
    flagged = flagged.select("id", "vector", allowed.alias("allowed"))
    return _finish(nearest(flagged, n, metric, floor, keep_self, block_rows), n, metric)


def neighbour_text(lists: DataFrame, digits: int = 6) -> DataFrame:
    """``id, value`` with ``item&score`` parts joined by commas, best first."""
    part = F.concat(F.col("item"), F.lit("&"), F.format_string(f"%.{digits}f", F.col("score")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rank"), part.alias("part"))))
    return lists.groupBy("id").agg(F.array_join(F.transform(ordered, lambda e: e["part"]), ",").alias("value"))


def sign_planes(seed, count: int, dim: int) -> np.ndarray:
    """Projections with entries 1 and -1, drawn as functions/draws.py draws from plane and dimension."""
    digests = [hashlib.md5(f"{seed}|{p}|{d}".encode()).hexdigest() for p in range(count) for d in range(dim)]
    return np.array([1.0 - 2.0 * (int(x[:8], 16) % 2) for x in digests]).reshape(count, dim)


def projections(matrix: np.ndarray, planes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (rows × tables) and the projections behind their bits (rows × tables × bits)."""
    values = (matrix @ planes.T).reshape(len(matrix), -1, bits)
    return ((values >= 0) * (1 << np.arange(bits))).sum(axis=2), values


def flips(margins: np.ndarray, probes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Per row of margins the bits to flip, as masks, in order of what the flipped margins add up to, and these sums.

    Only the FLIPPED smallest margins are flipped; ties go by mask.
    """
    few = min(margins.shape[1], FLIPPED)
    place = np.argsort(margins, axis=1, kind="stable")[:, :few]
    subsets = (np.arange(1 << few)[:, None] >> np.arange(few)) & 1
    sums = np.round(np.take_along_axis(margins, place, axis=1) @ subsets.T, 9)
    masks = (1 << place) @ subsets.T
    order = np.lexsort((masks, sums), axis=-1)[:, :probes]
    return np.take_along_axis(masks, order, axis=1), np.take_along_axis(sums, order, axis=1)


class Probing(NamedTuple):
    """Bits of a bucket, tables, buckets looked up in each, and the recall met on the sample (None: not measured)."""

    bits: int
    tables: int
    probes: int
    recall: float | None


def calibrated(vectors: DataFrame, n: int, target: float = 0.9, bits: int | None = None, tables: int = 16, seed=42,
               sample: int = LSH_SAMPLE) -> Probing:
    """The cheapest setting that finds the share ``target`` of the sample's exact neighbours.

    ``sample`` vectors (those of smallest hash) are compared with all rows exactly; the signs of their neighbours tell at
    which look-up each table would meet them. Cost is the expected share of rows compared: tables × probes ÷ 2^bits.
    At most ``bits`` bits (by default so many that a bucket has about BUCKET_ROWS rows) and ``tables`` tables are tried.
    """
    rows = vectors.where(F.col("vector").isNotNull())
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
    if not size.n:
        return Probing(1, 1, 1, None)
    bits = bits or max(1, min(24, math.ceil(math.log2(max(2.0, size.n / BUCKET_ROWS)))))
    planes = sign_planes(seed, tables * bits, size.dim)
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "vector").collect()
    asked, names = np.array([r.vector for r in drawn]), np.array([r.id for r in drawn], dtype=object)

    def exact(batches):
        for batch in batches:
            matrix = np.stack(batch["vector"].to_numpy())
            buckets, ids = projections(matrix, planes, bits)[0], batch["id"].to_numpy(dtype=object)
            order = np.argsort(ids, kind="stable")
            place = dict(zip(ids, range(len(ids))))
            near = best_per_row(similarities(asked, matrix[order], "cosine"), names, ids[order], n, None, False)
            near["buckets"] = [buckets[place[i]].tolist() for i in near["item"]]
            yield near

    found = top_n(rows.select("id", "vector").mapInPandas(exact, NEAREST + ", buckets array<int>"), ["id"],
                  [F.desc("score"), F.asc("item")], n).select("id", "buckets").collect()
    if not found:
        return Probing(bits, tables, 1, None)
    own, values = projections(asked, planes, bits)
    at = {name: k for k, name in enumerate(names)}
    who = np.array([at[r.id] for r in found])
    differ = np.array([r.buckets for r in found]) ^ own[who]
    best = None
    for b in range(1, bits + 1):
        met = np.full(differ.shape, 1 << b, dtype=np.int64)  # the look-up at which each table meets the neighbour
        for table in range(tables):
            margins = np.abs(values[:, table, :b])
            masks, _ = flips(margins)
            for k in range(len(asked)):
                mine = np.flatnonzero(who == k)
                order = np.argsort(masks[k])
                place = np.minimum(np.searchsorted(masks[k][order], differ[mine, table] & ((1 << b) - 1)), len(order) - 1)
                hit = masks[k][order][place] == (differ[mine, table] & ((1 << b) - 1))
                met[mine[hit], table] = order[place[hit]]
        first = np.minimum.accumulate(met, axis=1)
        for used in range(1, tables + 1):
            wanted = np.sort(first[:, used - 1])[math.ceil(target * len(who)) - 1]
            if wanted >= 1 << min(b, FLIPPED):
                continue
            probes = int(wanted) + 1
            setting = Probing(b, used, probes, float((first[:, used - 1] < probes).mean()))
            cost = used * probes / 2 ** b
            if best is None or cost < best[0]:
                best = cost, setting
    return best[1] if best else Probing(1, 1, 2, 1.0)


def _probed(vectors: DataFrame, candidates: DataFrame, setting: Probing, planes: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """Both sides of the look-up: ``id, vector, _table, _bucket``, a query in every bucket it looks into."""

    def buckets(probes: int):
        def run(batches):
            for batch in batches:
                own, values = projections(np.stack(batch["vector"].to_numpy()), planes, setting.bits)
                masks = np.stack([flips(np.abs(values[:, t]), probes)[0] for t in range(setting.tables)], axis=1)
                batch["_buckets"] = list((own[:, :, None] ^ masks).reshape(len(batch), -1).astype("int32"))
                yield batch
        return run

    sides = []
    for frame, probes in ((vectors, min(setting.probes, 1 << min(setting.bits, FLIPPED))), (candidates, 1)):
        hashed = frame.select("id", "vector").mapInPandas(buckets(probes), "id string, vector array<double>, _buckets array<int>")
        sides.append(hashed.select("id", "vector", F.posexplode("_buckets").alias("_at", "_bucket"))
                     .select("id", "vector", F.floor(F.col("_at") / probes).cast("int").alias("_table"), "_bucket"))
    return sides[0], sides[1]


def knn_lsh(vectors: DataFrame, n: int = 100, bits: int | None = None, tables: int | None = None, probes: int | None = None,
            target: float = 0.9, min_similarity: float | None = None, allow: DataFrame | None = None, deny: DataFrame | None = None,
            seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Approximate cosine neighbours by signs of random projections, several buckets looked up in each table.

    Vectors that agree on all signs of a table share a bucket. A query looks into its own bucket and then into those that
    differ in the signs it is least sure of, in order of the projections' sizes. Unless ``bits``, ``tables`` and ``probes`` are all
    named, :func:`calibrated` chooses the cheapest setting that reaches ``target`` on a sample. Buckets are
    compared exactly, block by block, so a bucket holding a third of the vectors is spread over many tasks.
    """
    vectors = vectors.where(F.col("vector").isNotNull())
    setting = (Probing(bits, tables, probes, None) if bits and tables and probes
               else calibrated(vectors, n, target, bits, tables or 16, seed))
    left, right, _ = _meeting(vectors, setting, allow, deny, seed)
    # Larger cells on larger tables: a vector goes to as many cells of a bucket as before, until a task is full.
    bunch = min(BUNCH, max(1, vectors.count() // (4 * block_rows)))
    left, right = grid(left, right, ["_table", "_bucket"], "id", bunch * block_rows)
    near = _nearest_in_cells(left, right, ["_table", "_bucket", "_row", "_col"], "cosine", n, min_similarity, False, block_rows)
    return _finish(near.groupBy("id", "item").agg(F.max("score").alias("score")), n, "cosine")


def _meeting(vectors: DataFrame, setting: Probing, allow: DataFrame | None, deny: DataFrame | None, seed) -> tuple[DataFrame, DataFrame, np.ndarray]:
    first = vectors.select(F.size("vector").alias("d")).first()
    planes = sign_planes(seed, setting.tables * setting.bits, first.d if first else 0)
    return (*_probed(vectors, _candidates(vectors, allow, deny), setting, planes), planes)


def compared_pairs(vectors: DataFrame, setting: Probing, seed: int = 42) -> DataFrame:
    """One row: ``met``, how often a query meets another row in a bucket (a pair counts once for each table that brings it together)."""
    left, right, _ = _meeting(vectors.where(F.col("vector").isNotNull()), setting, None, None, seed)
    asked = left.groupBy("_table", "_bucket").agg(F.count("*").alias("a"))
    held = right.groupBy("_table", "_bucket").agg(F.count("*").alias("b"))
    own = vectors.where(F.col("vector").isNotNull()).agg(F.count("*").alias("n")).scalar() * setting.tables
    return asked.join(held, ["_table", "_bucket"]).agg((F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)) - own).alias("met"))


def recall_against(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of exact neighbours that were found."""
    hits = exact.select("id", "item").join(found.select("id", "item").withColumn("_hit", F.lit(1)), ["id", "item"], "left")
    return hits.agg((F.count("_hit") / F.count("*")).alias("recall"), F.count("*").alias("wanted"))


def export_vectors(df: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """Vectors of the given length as ``id, value`` with space-joined numbers."""
    text = F.array_join(F.transform(F.col(vector_col), lambda x: x.cast("string")), " ")
    return df.where(F.size(vector_col) == size).select(F.col(id_col).cast("string").alias("id"), text.alias("value"))
