"""K-means with model selection.

All numbers of clusters are fitted at once: a pass over the points finds each point's nearest centre for every k and
adds it to that centre's sum, so a round costs one scan however many k are tried, and one more scan gives all
silhouettes. Sums are folded inside the tasks; what is shuffled is one row per centre, dimension and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import draw_int
from ..session import stored


def silhouette(points: DataFrame, centres: DataFrame, vector: str = "vector", cluster: str = "cluster") -> DataFrame:
    """Every point with ``own, nearest_other`` distances and its simplified silhouette.

    ``centres`` holds ``cluster, centre``. It travels as one value, as many numbers as all centres have; a
    point whose cluster has no centre has no own distance.
    """
    listed = centres.select(F.col(centres.columns[0]).alias("c"), F.col(centres.columns[1]).alias("m"))
    table = listed.agg(F.array_sort(F.collect_list(F.struct("c", "m"))).alias("_centres"))
    spread = points.withColumn("_centres", table.scalar())

    def distance(m: Column) -> Column:
        return F.sqrt(F.aggregate(F.zip_with(F.col(vector), m, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x))

    away = F.transform("_centres", lambda e: F.struct(e["c"].alias("c"), distance(e["m"]).alias("d")))
    spread = spread.withColumn("_all", away).drop("_centres")
    pick = lambda same: F.array_min(F.transform(F.filter("_all", lambda e: (e["c"] == F.col(cluster)) == F.lit(same)), lambda e: e["d"]))
    return (spread.withColumn("own", pick(True)).withColumn("nearest_other", pick(False)).drop("_all")
            .withColumn("silhouette", _shape(F.col("own"), F.col("nearest_other"))))


def _shape(own: Column, other: Column) -> Column:
    return F.coalesce(F.try_divide(other - own, F.greatest(own, other)), F.lit(0.0))


def _away(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances, without the cancellation of the product form."""
    squares = np.zeros((len(points), len(centres)))
    for k, centre in enumerate(centres):
        squares[:, k] = ((points - centre) ** 2).sum(axis=1)
    return np.sqrt(squares)


def _moved(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """One round for all models in one scan; a centre without points stays."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {k: np.zeros_like(m) for k, m in models.items()}
        counts = {k: np.zeros(len(m), dtype=np.int64) for k, m in models.items()}
        for batch in batches:
            matrix = np.stack(batch["_v"].to_numpy())
            for k, centres in models.items():
                own = _away(matrix, centres).argmin(axis=1)
                np.add.at(sums[k], own, matrix)
                counts[k] += np.bincount(own, minlength=len(centres))
        for k, own in sums.items():
            c, i = np.indices(own.shape)
            yield pd.DataFrame({"k": k, "c": c.ravel(), "i": i.ravel(), "s": own.ravel(), "n": np.repeat(counts[k], own.shape[1])})

    total = (points.select("_v").mapInPandas(run, "k int, c int, i int, s double, n long").groupBy("k", "c", "i")
             .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toPandas())
    new = {k: m.copy() for k, m in models.items()}
    for k, rows in total[total["n"] > 0].groupby("k"):
        new[int(k)][rows["c"], rows["i"]] = rows["s"] / rows["n"]
    return new


def _assigned(points: DataFrame, models: dict[int, np.ndarray]) -> DataFrame:
    """The points with ``_models``: for each k the nearest centre, its distance and that of the next one."""
    order = sorted(models)

    @F.pandas_udf("array<struct<k: int, cluster: int, own: double, other: double>>")
    def nearest(column: pd.Series) -> pd.Series:
        matrix, parts = np.stack(column.to_numpy()), []
        for k in order:
            away = _away(matrix, models[k])
            own = away.argmin(axis=1)
            here = away[np.arange(len(away)), own]
            away[np.arange(len(away)), own] = np.inf
            parts.append((own, here, away.min(axis=1)))
        return pd.Series([[{"k": k, "cluster": int(c[i]), "own": float(a[i]), "other": float(b[i])} for k, (c, a, b) in zip(order, parts)]
                          for i in range(len(matrix))])

    return points.withColumn("_models", nearest("_v"))


def kmeans_best_k(df: DataFrame, min_k: int, max_k: int, vector: str = "vector", max_iter: int = 20, seed=42,
                  init: str = "k-means||", id_col: str = "id"):
    """Fit k in [min_k, max_k), keep the best mean silhouette (the smallest k among equal ones).

    ``init`` ``k-means||`` starts from Spark's own seeding, ``draw`` from the points whose seeded draw on ``id_col`` is
    smallest, the same points for every k, so that SQL can follow. Rounds end when no centre moves or after ``max_iter``.
    Returns ``(assignments, best_k, {k: silhouette}, {k: centres})``; the assignments hold all input columns,
    ``cluster`` and the ``distance`` from its centre. Rows without a vector take no part.
    """
    if min_k < 2 or max_k <= min_k:
        raise ValueError("need 2 <= min_k < max_k")
    points = stored(df.where(F.col(vector).isNotNull()).withColumn("_v", F.col(vector).cast("array<double>")), "points")
    if init == "draw":
        drawn = points.orderBy(draw_int(seed, id_col), id_col).limit(max_k - 1).select("_v").collect()
        start = np.array([r[0] for r in drawn], dtype=np.float64)
        models = {k: start[:k].copy() for k in range(min_k, max_k)}
    else:
        models = {k: _seeded(points, k, init, seed) for k in range(min_k, max_k)}
    for _ in range(max_iter):
        new = _moved(points, models)
        still = all(np.array_equal(new[k], models[k]) for k in models)
        models = new
        if still:
            break
    found = stored(_assigned(points, models), "assigned")
    means = found.select(F.explode("_models").alias("m")).groupBy("m.k").agg(
        F.avg(_shape(F.col("m.own"), F.col("m.other"))).alias("s")).collect()
    scores = {r.k: r.s for r in means}
    best = min(scores, key=lambda k: (-round(scores[k], 9), k))
    chosen = F.filter("_models", lambda m: m["k"] == F.lit(best))[0]
    assigned = found.select(*df.columns, chosen["cluster"].alias("cluster"), chosen["own"].alias("distance"))
    return assigned, best, scores, models


def _seeded(points: DataFrame, k: int, init: str, seed) -> np.ndarray:
    """Spark's seeding: the centres of a model after one round."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = points.select(array_to_vector("_v").alias("features"))
    model = KMeans(k=k, initMode=init, maxIter=1, seed=seed if isinstance(seed, int) else 42).fit(features)
    return np.array([c.tolist() for c in model.clusterCenters()])
