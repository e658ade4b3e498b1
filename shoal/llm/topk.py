"""Exact top-k by inner product: buckets of similar length, pruned before the products.

Vectors are sorted by length and cut into buckets. A bound on each query's k-th best
product comes from the longest bucket. In every other bucket that bound, divided by
the lengths, is a cosine a vector must reach. Above 1 the bucket is skipped. Near 1
the query's largest coordinates confine the coordinates of any vector that can reach
it (coordinate pruning); otherwise vectors too short to reach it fall off the end of
the bucket (length pruning). What is left is verified by exact products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.session import stored, wide_partitions

#: Vectors of a bucket, queries of a group, coordinates looked at, and the cosine from which coordinates prune.
BUCKET = 8192
QUERIES = 2048
FOCUS = 6
COORDINATES_FROM = 0.8
#: Headers of buckets that a group of queries meets at once, and groups of queries that a bucket meets in one task.
HEADERS = 256
MESSAGES = 16
_EXACT = float(2**52)  # whole numbers below add up exactly in doubles
_BLOCK = "kind string, block long, dim int, n int, longest double, ids binary, numbers binary, _rank double"


def scaled(embedding: Column, factor: float = 1024.0) -> Column:
    """Each component times ``factor``, rounded down; null if the vector or a component is null or not finite."""
    good = embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x)
                                            & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(good, F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(factor))))


def _blocks(vectors: DataFrame, kind: str, size: int) -> DataFrame:
    """Vectors of one dimension in order of length, ``size`` to a block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        made, held, dim = 0, [], -1
        base = TaskContext.get().partitionId() << 32

        def block() -> pd.DataFrame:
            ids = np.array([i for i, _ in held], dtype="<i8")
            numbers = np.array([v for _, v in held], dtype="<i8").reshape(len(held), dim)
            longest = float(np.sqrt((numbers.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
            return pd.DataFrame({"kind": [kind], "block": [base + made], "dim": [dim], "n": [len(held)], "longest": [longest],
                                 "ids": [ids.tobytes()], "numbers": [numbers.tobytes()], "_rank": [-longest]})

        for batch in batches:
            for vec_id, dims, numbers in zip(batch["vec_id"], batch["dim"], batch["numbers"], strict=True):
                if held and (dims != dim or len(held) == size):
                    yield block()
                    made, held = made + 1, []
                dim = int(dims)
                held.append((vec_id, numbers))
        if held:
            yield block()

    order = [F.col("dim"), F.col("norm").desc(), F.col("vec_id")]
    ordered = vectors.repartitionByRange(wide_partitions(vectors.sparkSession), *order).sortWithinPartitions(*order)
    return ordered.select("vec_id", "dim", "numbers").mapInPandas(run, _BLOCK)


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, dtype="<i8")
    return ids, np.frombuffer(row.numbers, dtype="<i8").reshape(len(ids), row.dim)


def _lengths(numbers: np.ndarray) -> np.ndarray:
    return np.sqrt((numbers.astype(np.float64) ** 2).sum(axis=1))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond the range of a long they stay at its ends."""
    if queries.size and vectors.size and _lengths(queries).max() * _lengths(vectors).max() >= _EXACT:
        exact = queries.astype(object) @ vectors.T.astype(object)
        return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)
    return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)


def best(query_id: int, scores: np.ndarray, ids: np.ndarray, k: int, least: float) -> list[tuple[int, int, int]]:
    """The k best rows (query, vector, score) of at least ``least``, without the query's own; ties to smaller ids."""
    keep = np.flatnonzero((ids != query_id) & (scores >= least))
    if len(keep) > k:
        edge = np.partition(scores[keep], len(keep) - k)[len(keep) - k]
        keep = keep[scores[keep] >= edge]
    keep = keep[np.lexsort((ids[keep], -scores[keep]))][:k]
    return [(query_id, int(ids[i]), int(scores[i])) for i in keep]


def search_bucket(query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                  k: int) -> list[tuple[int, int, int]]:
    """What one bucket has for a group of queries; ``least`` is the bound of each query (minus infinity if none)."""
    lengths, own = _lengths(vectors), _lengths(queries)  # the bucket's lengths descend
    longest = lengths.max(initial=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(least > 0, least / (own * longest), 0.0)
    cosine = np.nan_to_num(cosine, nan=0.0, posinf=2.0)
    found = []
    near = cosine >= COORDINATES_FROM
    for i in np.flatnonzero(near & (cosine <= 1 + 1e-9)):
        q, t = queries[i] / own[i], min(cosine[i], 1.0)
        fit = np.arange(len(ids))
        for f in np.argsort(-np.abs(q))[:FOCUS]:
            width = np.sqrt(max(0.0, (1 - t * t) * (1 - q[f] * q[f])))
            # Beyond t the axis itself lies within reach, so that the coordinate goes up to its end.
            low = -1.0 if q[f] < -t else q[f] * t - width
            high = 1.0 if q[f] > t else q[f] * t + width
            x = vectors[fit, f] / np.maximum(lengths[fit], 1e-300)
            fit = fit[(x >= low - 1e-7) & (x <= high + 1e-7)]
        found += best(int(query_ids[i]), products(queries[i:i + 1], vectors[fit])[0], ids[fit], k, least[i])
    rest = np.flatnonzero(~near)
    with np.errstate(divide="ignore", invalid="ignore"):
        needed = np.where((least[rest] > 0) & (own[rest] > 0), least[rest] / own[rest] * (1 - 1e-9), -1.0)
    far = np.searchsorted(-lengths, -needed, side="right")  # vectors long enough for each query
    for at in range(0, len(rest), 128):
        part, reach = rest[at:at + 128], far[at:at + 128]
        scores = products(queries[part], vectors[:reach.max(initial=0)])
        for row, i, n in zip(scores, part, reach, strict=True):
            found += best(int(query_ids[i]), row[:n], ids[:n], k, least[i])
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best other vectors by inner product, ties to smaller ids.

    ``vectors`` has ``vec_id`` and ``numbers`` (array of long). Rows with a null in either take no part. Rows that
    share an id count once, with the least vector. Vectors are compared within their number of components. Fewer
    than k others give fewer rows; an empty table gives none.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "numbers").filter("vec_id IS NOT NULL AND numbers IS NOT NULL")
    # Ids alone tell which rows are repeated; only the vectors of those are shuffled to be compared.
    again = stored(rows.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").select("vec_id"), "repeated")
    if not again.isEmpty():
        least = rows.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("numbers").alias("numbers"))
        rows = rows.join(again, "vec_id", "left_anti").unionByName(least)
    rows = (rows.withColumn("dim", F.size("numbers"))
            .withColumn("norm", F.aggregate("numbers", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
    buckets = stored(_blocks(rows, "vectors", BUCKET), "buckets")
    groups = stored(_blocks(rows.filter(is_query), "queries", QUERIES), "queries")
    seeds = stored(_bounds(buckets, groups, k), "bounds")
    sent = stored(_sent(buckets, groups, seeds), "sent")
    found = _searched(buckets, sent, k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _bounds(buckets: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """``g, dim, least, need``: a bound on each query's k-th best product from its dimension's longest bucket, and how long a
    vector must be for the group's least demanding query."""
    longest = buckets.groupBy("dim").agg(F.min_by("block", F.struct("_rank", "block")).alias("block"))
    first = (buckets.join(F.broadcast(longest.select("block")), "block", "left_semi")  # one bucket per dimension
             .select("dim", F.col("ids").alias("v_ids"), F.col("numbers").alias("v_numbers")))

    def seed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                query_ids, queries = _unpack(row)
                ids = np.frombuffer(row.v_ids, dtype="<i8")
                numbers = np.frombuffer(row.v_numbers, dtype="<i8").reshape(len(ids), row.dim)
                seen: dict[int, list[int]] = {}
                for q, _, score in search_bucket(query_ids, queries, np.full(len(query_ids), -np.inf), ids, numbers, k):
                    seen.setdefault(q, []).append(score)
                low = np.array([float(min(seen[q])) if len(seen.get(q, [])) == k else -np.inf for q in query_ids.tolist()])
                yield pd.DataFrame({"g": [row.block], "dim": [row.dim], "least": [low.tobytes()],
                                    "need": [float(lengths_needed(low, _lengths(queries)).min(initial=np.inf))]})

    pairs = groups.select("block", "dim", "ids", "numbers").join(first, "dim")
    return pairs.mapInPandas(seed, "g long, dim int, least binary, need double")


def lengths_needed(least: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The shortest vector whose product with each query can reach its bound; 0 where any may."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((least > 0) & (own > 0), least / own * (1 - 1e-9), np.where(least > 0, np.inf, 0.0))


def _sent(buckets: DataFrame, groups: DataFrame, seeds: DataFrame) -> DataFrame:
    """``b, dim, ids, numbers, least``: the queries that each bucket must see, decided by the buckets' headers.

    A bucket whose longest vector can't reach the bound of any of a group's queries gets nothing from it; the others get
    the queries whose bound they can reach. A group meets its buckets' headers in rows of at most HEADERS.
    """
    heads = buckets.select(F.col("block").alias("b"), F.col("dim").alias("_dim"), "longest")
    able = seeds.select("g", "dim", "need").join(heads, (F.col("dim") == F.col("_dim")) & (F.col("longest") >= F.col("need")))
    many = F.ceil(buckets.agg(F.count("*").alias("n")).scalar() / HEADERS)
    listed = (able.withColumn("_chunk", F.pmod(F.xxhash64("b"), F.greatest(many, F.lit(1)))).groupBy("g", "_chunk")
              .agg(F.collect_list(F.struct("b", "longest")).alias("heads")).drop("_chunk"))
    meeting = (groups.select(F.col("block").alias("g"), "dim", "ids", "numbers").join(seeds.select("g", "least"), "g").join(listed, "g"))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                query_ids, queries = _unpack(row)
                least = np.frombuffer(row.least)
                need = lengths_needed(least, _lengths(queries))
                for head in row.heads:
                    own = need <= head["longest"]
                    if own.any():
                        yield pd.DataFrame({"b": [head["b"]], "dim": [row.dim], "ids": [query_ids[own].tobytes()],
                                            "numbers": [queries[own].tobytes()], "least": [least[own].tobytes()]})

    return meeting.mapInPandas(send, "b long, dim int, ids binary, numbers binary, least binary")


def _searched(buckets: DataFrame, sent: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: a bucket goes once to each task of MESSAGES groups of queries that were sent to it."""
    parts = F.greatest(F.ceil(F.max("n") / MESSAGES), F.lit(1))
    per_bucket = sent.groupBy("b").agg(F.count("*").alias("n"))
    left = sent.withColumn("part", F.pmod(F.xxhash64("ids"), per_bucket.agg(parts.alias("x")).scalar()).cast("int"))
    right = buckets.select(F.col("block").alias("b"), "dim", "ids", "numbers").join(left.select("b", "part").distinct(), "b")
    right = right.select([F.col(c).alias(c) for c in right.columns])  # fresh columns: both sides come from one frame

    def search(queries: pd.DataFrame, bucket: pd.DataFrame) -> pd.DataFrame:
        out = []
        for own in bucket.itertuples():
            ids, numbers = _unpack(own)
            for group in queries.itertuples():
                query_ids, vectors = _unpack(group)
                out += search_bucket(query_ids, vectors, np.frombuffer(group.least), ids, numbers, k)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return left.groupBy("b", "part").cogroup(right.groupBy("b", "part")).applyInPandas(search, "query_id long, vec_id long, score long")
