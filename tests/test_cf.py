"""Collaborative filtering against direct formulas on small and crowded inputs."""

import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.operators import cells, cf
from shoal.operators.pairs import co_counts
from shoal.operators.topn import i2i_maps, i2i_stats, i2i_top_n, rank_any_under, recall_counts, top_n

ROWS = [("u1", "a", 1.0), ("u1", "b", 2.0), ("u1", "c", 3.0), ("u2", "a", 2.0), ("u2", "b", 1.0),
        ("u3", "b", 2.0), ("u3", "c", 1.0), ("u3", "a", 4.0)]


def ratings(spark, rows=ROWS):
    return spark.createDataFrame(rows, "user string, item string, score double")


def found(df):
    return {(r.item_1, r.item_2): r.sim for r in df.collect()}


def swing_by_hand(rows, version, alpha=1.0, classic=False):
    items, norm = defaultdict(dict), defaultdict(float)
    for user, item, score in rows:
        items[user][item] = score
        norm[item] += score * score
    sims = defaultdict(float)
    users = sorted(items)
    for u, v in itertools.combinations_with_replacement(users, 2):
        if classic and u == v:
            continue
        common = sorted(set(items[u]) & set(items[v]))
        pairs = list(itertools.combinations(common, 2))
        for i, j in pairs:
            w = 1 / (alpha + (len(common) if classic else len(pairs)))
            if version in ("V2", "V3"):
                w /= math.sqrt(len(items[u]) * len(items[v]))
            scale = math.sqrt(math.sqrt(norm[i]) * math.sqrt(norm[j]))
            if version == "V1p1":
                w *= (items[u][i] * items[v][i] + items[u][j] * items[v][j]) / scale
            if version == "V3":
                w *= (items[u][i] * items[u][j] + items[v][i] * items[v][j]) / scale
            sims[i, j] += w
    return sims


@pytest.mark.parametrize("version", ["V1", "V1p1", "V2", "V3"])
@pytest.mark.parametrize("block_rows", [2048, 1])
def test_swing(spark, version, block_rows):
    assert found(cf.swing(ratings(spark), version, block_rows=block_rows)) == pytest.approx(swing_by_hand(ROWS, version))


def test_swing_classic_counts_items_and_other_users_only(spark):
    assert found(cf.swing(ratings(spark), classic=True)) == pytest.approx(swing_by_hand(ROWS, "V1", classic=True))


def test_swing_bounds_are_judged_on_all_rows(spark):
    rows = [*ROWS, ("u4", "z", 1.0)]
    kept = [r for r in rows if r[0] in ("u1", "u3") and r[1] != "z"]
    got = found(cf.swing(ratings(spark, rows), user_items=(3, None), item_users=(2, None)))
    assert got == pytest.approx(swing_by_hand(kept, "V1"))


@pytest.mark.parametrize("version", ["V1", "V2"])
@pytest.mark.parametrize("block_rows", [2048, 2])
def test_item_cf(spark, version, block_rows):
    items, norm = defaultdict(dict), defaultdict(float)
    for user, item, score in ROWS:
        items[user][item] = score
        norm[item] += score * score
    expected = defaultdict(float)
    for user, scores in items.items():
        for i, j in itertools.combinations(sorted(scores), 2):
            w = math.sqrt(len(scores)) if version == "V2" else 1
            expected[i, j] += scores[i] * scores[j] / w / math.sqrt(norm[i] * norm[j])
    got = found(cf.item_cf(ratings(spark), version, block_rows=block_rows))
    assert got == pytest.approx(expected)
    assert all(0 <= s <= 1 + 1e-9 for s in got.values())


def test_ids_with_separators_stay_whole(spark):
    rows = [("u_1", "a_b", 1.0), ("u_1", "c&d", 1.0)]
    assert set(found(cf.swing(ratings(spark, rows)))) == {("a_b", "c&d")}


def test_a_crowded_group_gives_every_pair_once(spark):
    rows = spark.createDataFrame([("hot", f"i{n:03d}") for n in range(150)] + [("x", "i000"), ("x", "i001")], "user_id string, item_id string")
    counts = co_counts(rows, "user_id", "item_id", block_rows=16)
    got = {(r.item_1, r.item_2): r.n for r in counts.collect()}
    assert len(got) == 150 * 149 // 2
    assert got["i000", "i001"] == 2 and sum(got.values()) == 150 * 149 // 2 + 1


def test_top_n_ties_go_by_item_and_salting_changes_nothing(spark):
    pairs = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 1.0), ("a", "d", 2.0), ("b", "c", 0.1)], "item_1 string, item_2 string, sim double")
    lists = i2i_top_n(pairs, 2, min_score=0.5)
    assert [(r.item, r["rank"]) for r in lists.where("id = 'a'").orderBy("rank").collect()] == [("d", 1), ("b", 2)]
    from pyspark.sql import functions as F

    rows = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    plain = top_n(rows, ["k"], [F.asc("id")], 7)
    salted = top_n(rows, ["k"], [F.asc("id")], 7, salts=8)
    assert sorted(plain.collect()) == sorted(salted.collect())


def test_allow_and_deny_act_on_the_neighbour(spark):
    pairs = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0)], "item_1 string, item_2 string, sim double")
    allow = spark.createDataFrame([("b",), ("c",)], "item string")
    deny = spark.createDataFrame([("c",)], "item string")
    assert [(r.id, r.item) for r in i2i_top_n(pairs, 5, allow=allow, deny=deny).collect()] == [("a", "b")]


def test_stats_and_map_view(spark):
    pairs = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0)], "item_1 string, item_2 string, sim double")
    lists = i2i_top_n(pairs, 5)
    stats = i2i_stats(lists).first()
    assert (stats.items, stats.max_neighbours, stats.min_neighbours, stats.max_score) == (3, 2, 1, 2.0)
    assert {r.id: r.neighbours for r in i2i_maps(lists).collect()}["a"] == {"c": 2.0, "b": 1.0}
    assert recall_counts(lists, 1).where("side = 'most'").first().item == "a"


def test_merging_mirrors_once(spark):
    one = spark.createDataFrame([("a", "b", 1.0)], "item_1 string, item_2 string, sim double")
    two = spark.createDataFrame([("b", "a", 2.0)], "item_1 string, item_2 string, sim double")
    merged = cf.merge_similarities(one, two)
    assert found(merged) == {("a", "b"): 3.0}
    assert i2i_top_n(merged, 10).where("id = 'a'").count() == 1


def test_rank_any_under_shares_ranks(spark):
    scores = [(1, 5.0, 1.0), (2, 5.0, 2.0), (3, 4.0, 3.0), (4, None, 4.0), (5, 1.0, 0.0)]
    rows = spark.createDataFrame(scores, "id int, a double, b double")
    # Ranks of a: 1, 1, 3, 5, 4.
    assert sorted(r.id for r in rank_any_under(rows, ["a"], 3, "id").collect()) == [1, 2]
    assert sorted(r.id for r in rank_any_under(rows, ["a"], 9, "id").collect()) == [1, 2, 3, 4, 5]


def test_dense_ids_are_consecutive(spark):
    rows = spark.createDataFrame([(f"k{n % 37}",) for n in range(200)], "k string")
    assert sorted(r.idx for r in cf.dense_ids(rows, "k", buckets=8).collect()) == list(range(37))


def test_als_gives_k_finite_items_per_user(spark):
    rows = [(f"u{u}", f"i{i}", float((u * i) % 5 + 1)) for u in range(12) for i in range(9) if (u + i) % 3]
    best = cf.als_top_k(ratings(spark, rows), 4, rank=3, max_iter=2).collect()
    per_user = defaultdict(set)
    for r in best:
        per_user[r.user_id].add(r.item_id)
        assert math.isfinite(r.rating)
    assert len(per_user) == 12 and all(len(v) == 4 for v in per_user.values())


def test_similarity_queries_give_all_pairs(spark, tmp_path):
    """Sixty items of one user are 1,770 pairs; lists of fifty would lose some."""
    from shoal.plans import ORACLES, QUERIES

    orders = [(n, 1) for n in range(60)] + [(100, 2), (101, 2)]
    lines = [(n, n, float(n % 7 + 1)) for n in range(60)] + [(100, 3, 1.0), (101, 9, 2.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("itemcf_v1", "itemcf_v2", "swing_v1", "swing_v1p1", "swing_v2", "swing_v3"):
        got = QUERIES[name](spark, str(tmp_path))
        assert got.columns == ["item_1", "item_2", "sim"] and got.count() == 60 * 59 // 2
        assert "QUALIFY" not in ORACLES[name]


@pytest.mark.parametrize("version", ["V1", "V1p1", "V2", "V3"])
def test_sums_in_cells_are_those_of_all_pairs(spark, monkeypatch, version):
    """Many small messages, steps and shares, a crowded user and a crowded item; the pairs themselves are not shuffled."""
    import random

    for name, size in {"PACK_ROWS": 20, "PRODUCTS": 30, "NAMES": 4, "CELL_ROWS": 64}.items():
        monkeypatch.setattr(cells, name, size)
    draw = random.Random(3)
    rows = [(f"u{u:02d}", f"i{i:02d}", float(draw.randint(1, 5))) for u in range(25) for i in range(18) if u == 3 or i == 4 or draw.random() < 0.3]
    got = cf.swing(ratings(spark, rows), version, block_rows=5)
    assert found(got) == pytest.approx(swing_by_hand(rows, version))
    if version in ("V1", "V2"):
        pairs = cf.item_cf(ratings(spark, rows), version, block_rows=5)
        assert "item_id_1" not in pairs._jdf.queryExecution().executedPlan().toString()
        norm, sizes, want = defaultdict(float), defaultdict(int), defaultdict(float)
        for user, item, score in rows:
            norm[item] += score * score
            sizes[user] += 1
        for (user, i, a), (other, j, b) in itertools.product(rows, rows):
            if user == other and i < j:
                want[i, j] += a * b / math.sqrt(norm[i] * norm[j]) / (math.sqrt(sizes[user]) if version == "V2" else 1)
        assert found(pairs) == pytest.approx(want)
        lists = lambda p, **how: {(r.id, r["rank"]): r.item for r in i2i_top_n(p.selectExpr("item_1", "item_2", "round(sim, 12) AS sim"), 3, **how).collect()}
        assert lists(cf.item_cf(ratings(spark, rows), version, 5, best=3), directed=True) == lists(pairs)


def test_an_unknown_score_leaves_the_pair(spark):
    rows = [("u", "a", 1.0), ("u", "b", None), ("v", "b", 2.0), ("v", "c", 1.0), ("w", None, 1.0), (None, "a", 1.0)]
    got = found(cf.item_cf(ratings(spark, rows)))
    assert got["a", "b"] is None and got["b", "c"] == pytest.approx(1.0) and len(got) == 2
    best = i2i_top_n(cf.item_cf(ratings(spark, rows), best=5), 5, directed=True)
    assert sorted((r.id, r.item, r["rank"]) for r in best.collect()) == [("a", "b", 1), ("b", "a", 2), ("b", "c", 1), ("c", "b", 1)]


@pytest.mark.parametrize("kind", ["<i4", "<f8", "u1"])
def test_numbers_in_planes_come_back_and_pack_small(kind):
    rng = np.random.default_rng(3)
    numbers = rng.integers(0, 200, 5000).astype(kind)
    assert cells._numbers(cells._planes(numbers, kind), kind).tolist() == numbers.tolist()
    assert cells._numbers(cells._planes(numbers[:0], kind), kind).tolist() == []
    table = rng.standard_normal((40, 3))
    assert np.array_equal(cells._numbers(cells._planes(table.T, "<f8"), "<f8").reshape(3, 40).T, table)
    if kind == "<f8":
        assert len(zlib.compress(cells._planes(numbers, kind), 1)) < 0.8 * len(zlib.compress(numbers.tobytes(), 1))


def test_messages_lie_in_planes(spark):
    """What goes to the cells packs to less than its numbers in a row, and reads as the same rows."""
    rows = [(f"u{u}", int(i), float(q)) for u in range(60) for i, q in zip(range(u % 7, 400, 7), np.random.default_rng(u).integers(1, 50, 60))]
    frame = spark.createDataFrame(rows, "user_id string, place int, score double")
    sent = [r.asDict() for r in cells.messages(frame, "user_id", "place", ["score"], 2).collect()]
    sides = [(cells._Side(m, name, 1), m[f"{name}_values"]) for m in sent for name in ("left", "right") if m[f"{name}_places"]]
    assert {x.values[k, 0] for x, _ in sides for k in range(len(x.places))} <= {q for _, _, q in rows}
    plain = sum(len(zlib.compress(np.ascontiguousarray(x.values).tobytes(), 1)) for x, _ in sides)
    assert sum(len(zlib.compress(data, 1)) for _, data in sides) < 0.9 * plain


def test_a_list_leaves_its_strip_once(spark, monkeypatch):
    """The n best of an item are merged over all cells of its block: what leaves does not grow with the blocks."""
    monkeypatch.setattr(cells, "CELL_ROWS", 16)
    rng = np.random.default_rng(8)
    rows = [(f"u{u}", f"i{i:02d}", float(rng.random())) for u in range(30) for i in rng.choice(40, 12, replace=False)]
    frame = ratings(spark, rows)
    assert cells.block_count(frame) >= 2 * spark.sparkContext.defaultParallelism
    found = cf.item_cf(frame, best=3)
    assert found.groupBy("item_1").count().where("count <> 3").count() == 0
    whole = i2i_top_n(cf.item_cf(frame).withColumn("sim", F.round("sim", 12)), 3)
    mine = i2i_top_n(found.withColumn("sim", F.round("sim", 12)), 3, directed=True)
    assert sorted((r.id, r.item, r["rank"]) for r in mine.collect()) == sorted((r.id, r.item, r["rank"]) for r in whole.collect())


def test_equal_scores_of_many_cells_end_in_whole_lists(spark, monkeypatch):
    monkeypatch.setattr(cells, "CELL_ROWS", 16)
    rows = [(f"u{u}", f"i{i:02d}", 1.0) for u in range(3) for i in range(40)]
    mine = i2i_top_n(cf.item_cf(ratings(spark, rows), best=2).withColumn("sim", F.round("sim", 12)), 2, directed=True)
    assert sorted((r.id, r.item) for r in mine.collect()) == [(f"i{i:02d}", f"i{j:02d}") for i in range(40) for j in [k for k in range(40) if k != i][:2]]


def test_blocks_of_a_factorisation_grow_with_the_ratings(spark, monkeypatch):
    from pyspark.ml.recommendation import ALS

    asked, plain = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda als, df: asked.append((als.getNumUserBlocks(), als.getNumItemBlocks())) or plain(als, df))
    rows = [(f"u{n % 9}", f"i{n // 9}", 1.0 + n % 5) for n in range(90)]
    for size in (4, 1 << 22):
        monkeypatch.setattr(cf, "ALS_ROWS", size)
        users, items = cf.als_factors(ratings(spark, rows), rank=2, max_iter=1)
        assert users.count() == 9 and items.count() == 10
    assert asked == [(23, 23), (10, 10)]


def test_lists_are_made_once_for_both_ends(spark, monkeypatch):
    """The most and the least recalled items come from one stored count; the lists behind it are not made for each."""
    from shoal.operators import topn

    kept, plain = [], topn.stored
    monkeypatch.setattr(topn, "stored", lambda df, name: kept.append(plain(df, name)) or kept[-1])
    rows = [(f"i{a}", f"i{b}", 1.0, 1) for a in range(6) for b in range(a)]
    lists = spark.createDataFrame(rows, "id string, item string, score double, rank int")
    got = {(r.side, r.item, r.times) for r in recall_counts(lists, 1).collect()}
    assert got == {("most", "i0", 5), ("least", "i4", 1)}
    assert [sorted(map(tuple, df.collect())) for df in kept] == [[(f"i{k}", 5 - k) for k in range(5)]]
