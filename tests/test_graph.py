"""Walks, draws, windows and clusters."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.operators import cluster, graph, sampling

EDGES = [("u1", "i1", 1.0), ("u1", "i2", 3.0), ("u2", "i2", 1.0), ("u2", "i3", 1.0), ("u3", "i3", 2.0)]


def edges(spark, rows=EDGES):
    return spark.createDataFrame(rows, "a string, b string, w double")


def walked(walks):
    out = defaultdict(list)
    for r in walks.orderBy("walk", "pos").collect():
        out[r.walk].append(r.node)
    return out


@pytest.mark.parametrize("make", [
    lambda e: graph.deep_walk(e, 3, keep="all"),
    lambda e: graph.node2vec_walks(e, 3, keep="all", directed=False, p=0.5, q=2.0)])
def test_walks_follow_edges_and_have_their_length(spark, make):
    near = defaultdict(set)
    for a, b, _ in EDGES:
        near[a].add(b)
        near[b].add(a)
    paths = walked(make(edges(spark)))
    assert set(paths) == set(near)
    for start, path in paths.items():
        assert path[0] == start and len(path) == 5
        assert all(b in near[a] for a, b in zip(path, path[1:]))


def test_walks_stop_at_dead_ends_and_filter_nodes(spark):
    paths = walked(graph.deep_walk(edges(spark), 3, keep="all", directed=True))
    assert set(paths) == {"u1", "u2", "u3"} and all(len(p) == 2 for p in paths.values())
    ends = walked(graph.deep_walk(edges(spark), 3, keep="end"))
    assert all(n.startswith("i") for p in ends.values() for n in p)


def test_bfs_steps_draw_twice_from_one_node(spark):
    near = defaultdict(set)
    for a, b, _ in EDGES:
        near[a].add(b)
        near[b].add(a)
    rows = graph.deep_walk(edges(spark), 2, keep="all", mode="dfs&bfs", bfs_ratio=0.0).collect()
    by_walk = defaultdict(dict)
    for r in rows:
        by_walk[r.walk][r.pos] = r.node
    for path in by_walk.values():
        assert sorted(path) == list(range(7))
        for step in range(3):
            at = path[2 * step]
            assert path[2 * step + 1] in near[at] and path[2 * step + 2] in near[at]


def test_draws_are_proportional_to_weight(spark):
    hub = [("h", f"t{n}", 1.0) for n in range(40)] + [("h", "big", 60.0), ("other", "t0", 1.0)]
    frame = spark.createDataFrame(hub, "src string, dst string, weight double")
    counts = Counter(r.dst for r in sampling.weighted_draws(frame, 2000, "x").where("src = 'h'").collect())
    assert sum(counts.values()) == 2000
    assert abs(counts["big"] / 2000 - 0.6) < 0.04
    assert len(counts) > 35


def test_draw_table_covers_the_unit_range_once(spark):
    frame = spark.createDataFrame([("h", f"t{n}", float(n % 3 + 1)) for n in range(30)], "src string, dst string, weight double")
    spans = sorted({(r.low, r.high) for r in sampling.draw_table(frame).collect()})
    assert spans[0][0] == 0 and spans[-1][1] == pytest.approx(1)
    assert all(a[1] == pytest.approx(b[0]) for a, b in zip(spans, spans[1:]))
    assert sampling.draw_table(frame).count() <= 60


def test_second_order_kinds(spark):
    rows = [("a", "b", 1.0), ("b", "a", 2.0), ("b", "c", 3.0), ("a", "c", 1.0), ("b", "d", 5.0)]
    frame = spark.createDataFrame(rows, "src string, dst string, weight double")
    got = {r.next: (r.kind, r.weight) for r in graph.second_order(frame, p=2.0, q=0.5).where("prev = 'a' and cur = 'b'").collect()}
    assert got == {"a": ("back", 1.0), "c": ("shared", 3.0), "d": ("far", 10.0)}


def test_undirected_adds_the_reverse_edge(spark):
    both = graph.merged_edges(graph.edges_of(edges(spark)), directed=False)
    assert {(r.src, r.dst) for r in both.collect()} == {(a, b) for a, b, _ in EDGES} | {(b, a) for a, b, _ in EDGES}


def test_neighbour_cap_keeps_total_draws(spark):
    rows = [("h", f"t{n}", 1.0) for n in range(50)] + [("s", "t1", 1.0)]
    frame = spark.createDataFrame(rows, "src string, dst string, weight double")
    capped = graph.capped_neighbours(frame, 10, "c").groupBy("src").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()
    got = {r.src: (r.w, r.n) for r in capped}
    assert got["h"][0] == 10 and got["h"][1] <= 10 and got["s"] == (1.0, 1)


def test_node_index_and_skip_grams(spark):
    index = graph.node_index(graph.edges_of(edges(spark)))
    assert sorted(r["index"] for r in index.collect()) == list(range(6))
    walks = spark.createDataFrame([("w", n, x) for n, x in enumerate("abcd")], "walk string, pos int, node string")
    got = Counter((r.centre, r.context) for r in graph.skip_gram_pairs(walks, 1).collect())
    assert got == Counter([("a", "b"), ("b", "a"), ("b", "c"), ("c", "b"), ("c", "d"), ("d", "c")])


def test_word2vec_vocabulary(spark):
    rows = spark.createDataFrame([(["a", "b", "c"],)] * 5 + [(["a", "rare"],)], "path array<string>")
    got = {r.item: len(r.vector) for r in graph.word2vec_items(rows, size=4, min_count=3).collect()}
    assert got == {"a": 4, "b": 4, "c": 4}


def test_places_follow_time_and_lose_no_pair(spark):
    rows = [("u", n, n * 1000) for n in range(250)] + [("v", 3, 500), ("v", 2, 500), ("v", 1, 400)]
    frame = spark.createDataFrame(rows, "user_id string, item_id int, time_ms long")
    places = graph.item_positions(frame, "user_id", "item_id", "time_ms")
    got = {(r.walk, r.pos): r.node for r in places.collect()}
    assert [got["u", n] for n in range(250)] == [str(n) for n in range(250)]
    assert [got["v", n] for n in range(3)] == ["1", "2", "3"]
    pairs = graph.skip_gram_pairs(places, 2)
    assert pairs.count() == 2 * (249 + 248) + 2 * (2 + 1)
    assert sorted(len(r.path) for r in graph.sentences(places, 100).collect()) == [3, 50, 100, 100]


@pytest.mark.parametrize("length,window", [(3, 3), (10, 4), (100, 1), (7, 2)])
def test_sentences_and_bridges_hold_every_pair_once(spark, length, window):
    sizes = {"u": 57, "v": 10, "w": 1}
    places = spark.createDataFrame([(w, n, f"{w}{n}") for w, size in sizes.items() for n in range(size)], "walk string, pos int, node string")
    seen = Counter()
    for r in graph.sentences(places, length).unionByName(graph.bridges(places, length, window)).collect():
        seen.update((a, b) for i, a in enumerate(r.path) for b in r.path[i + 1:i + 1 + window])
    want = {(f"{w}{i}", f"{w}{j}") for w, size in sizes.items() for i in range(size) for j in range(i + 1, min(i + window + 1, size))}
    assert set(seen) == want and set(seen.values()) == {1}


def test_item_vectors_of_a_long_sequence(spark):
    rows = [("u", f"i{n % 4}", n) for n in range(2500)] + [("v", "rare", 1), ("v", "i0", 2), ("v", "i1", 3)]
    frame = spark.createDataFrame(rows, "user_id string, item_id string, at long")
    got = {r.item: (r.n, len(r.vector)) for r in graph.item_vectors(frame, "user_id", "item_id", "at", 3, size=4, window=2, length=50, partitions=1).collect()}
    assert got == {"i0": (626, 4), "i1": (626, 4), "i2": (625, 4), "i3": (625, 4)}


def test_fractional_weights_leave_no_gap_and_no_overlap(spark):
    rng = random.Random(3)
    rows = [("h", f"t{n}", rng.random() * 10 ** rng.randrange(-3, 4)) for n in range(3000)] + [("s", "a", 0.1), ("s", "b", 0.2), ("s", "c", 0.7)]
    frame = spark.createDataFrame(rows, "src string, dst string, weight double")
    for node in ("h", "s"):
        spans = sorted((r.low, r.high) for r in sampling.unit_intervals(frame).where(F.col("src") == node).collect())
        assert spans[0][0] == 0.0 and spans[-1][1] == 1.0
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
    assert sampling.weighted_draws(frame, 20, "f").count() == 2 * 20


def test_silhouette_takes_the_nearest_other_centre(spark):
    points = spark.createDataFrame([([0.0, 1.0], 0)], "vector array<double>, cluster int")
    centres = spark.createDataFrame([(0, [0.0, 0.0]), (1, [100.0, 0.0]), (2, [0.0, 4.0])], "cluster int, centre array<double>")
    row = cluster.silhouette(points, centres).first()
    assert (row.own, row.nearest_other) == (1.0, 3.0) and row.silhouette == pytest.approx(2 / 3)


def test_kmeans_picks_the_right_k(spark):
    rows = [(f"{g}-{n}", [g * 10.0 + n * 0.1, g * -5.0]) for g in range(3) for n in range(8)]
    frame = spark.createDataFrame(rows, "id string, vector array<double>")
    assigned, best, scores, _ = cluster.kmeans_best_k(frame, 2, 5)
    assert best == 3 and set(scores) == {2, 3, 4} and assigned.count() == 24
    with pytest.raises(ValueError):
        cluster.kmeans_best_k(frame, 1, 3)


@pytest.mark.parametrize("directed", [True, False])
def test_sums_by_kind_equal_the_rows(spark, directed):
    rng = random.Random(11)
    rows = [(f"n{rng.randrange(14)}", f"n{rng.randrange(14)}", float(rng.randrange(1, 5))) for _ in range(70)] + [("n1", "n1", 2.0)]
    rows += [("hub", f"n{n}", 1.0) for n in range(14)]
    frame = edges(spark, rows)
    own = graph.edge_probabilities(frame, directed, p=4.0, q=0.25).groupBy("prev", "cur", "kind").agg(
        F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()
    summed = graph.edge_probabilities(frame, directed, p=4.0, q=0.25, summed=True).collect()
    assert {(r.prev, r.cur, r.kind): (r.n, r.weight) for r in summed} == {(r.prev, r.cur, r.kind): (r.n, r.weight) for r in own}
    assert len(summed) == len(own) and {"back", "shared", "far"} <= {r.kind for r in summed}


def test_no_row_for_each_two_edges_of_a_hub(spark):
    rows = [("hub", f"n{n}", 1.0) for n in range(30_000)] + [("n1", "n2", 1.0)]
    summed = graph.edge_probabilities(edges(spark, rows), directed=False, summed=True)
    got = {(r.prev, r.cur, r.kind): r.n for r in summed.where("prev in ('n1', 'n5') and cur = 'hub'").collect()}
    assert got == {("n1", "hub", "back"): 1, ("n1", "hub", "shared"): 1, ("n1", "hub", "far"): 29_998,
                   ("n5", "hub", "back"): 1, ("n5", "hub", "far"): 29_999}
    assert summed.count() == 60_002 * 2 - 30_000 + 2 + 2


def test_a_corner_gets_lists_and_no_row_for_each_two_of_its_edges(spark):
    # Every low node leads to the same 60 others, of which only 0 and 1 are joined: 1770 pairs of edges at each, one closed.
    lists = [(1000 + n, list(range(60))) for n in range(20)] + [(0, [1])]
    found = graph.closing(spark.createDataFrame(lists, "corner int, others array<int>")).collect()
    assert sorted((r.corner, r.other, r.thirds) for r in found) == [(1000 + n, 0, [1]) for n in range(20)]


def test_sums_over_missing_ends_and_weights(spark):
    rows = [("a", "b", None), ("b", "a", 2.0), ("a", "c", 1.0), ("b", "c", 3.0), ("c", "c", None), ("a", None, 5.0), (None, "b", 1.0), ("a", "c", 4.0)]
    got = {(r.prev, r.cur, r.kind): (r.n, r.weight) for r in graph.edge_probabilities(edges(spark, rows), directed=True, summed=True).collect()}
    # An edge without a weight is a step, but leads nobody back and shares nothing.
    assert got == {("a", "b", "back"): (1, 2.0), ("a", "b", "far"): (1, 3.0), ("b", "a", "shared"): (1, 5.0), ("b", "a", "far"): (2, 5.0), ("a", "c", "far"): (1, None),
                   ("b", "c", "far"): (1, None), ("c", "c", "back"): (1, None)}


def test_second_order_walks_have_the_right_shares(spark):
    # From every s the walk goes to m; of m's other edges, one leads back, one to a neighbour of s, two elsewhere.
    rows = []
    for n in range(600):
        rows += [(f"s{n}", f"m{n}", 1000.0), (f"m{n}", f"s{n}", 1.0), (f"m{n}", f"near{n}", 1.0), (f"s{n}", f"near{n}", 1e-9),
                 (f"m{n}", f"x{n}", 1.0), (f"m{n}", f"y{n}", 2.0)]
    paths = walked(graph.node2vec_walks(edges(spark, rows), 1, keep="all", directed=True, p=2.0, q=0.5))
    ends = Counter(p[2][0] for w, p in paths.items() if w[0] == "s")
    # back 1/2, near 1, x 2, y 4 of 7.5
    assert sum(ends.values()) == 600
    for name, share in {"s": 0.5 / 7.5, "n": 1 / 7.5, "x": 2 / 7.5, "y": 4 / 7.5}.items():
        assert abs(ends[name] / 600 - share) < 0.06


def test_walks_over_a_hub_read_no_list_of_its_edges(spark):
    rows = [("hub", f"n{n}", 1.0) for n in range(100_000)]
    frame = edges(spark, rows)
    walks = graph.node2vec_walks(frame, 1, keep="all", directed=False, p=1e9, q=1.0)
    assert walks.where("pos = 2").count() == 100_001
    # Going back from the hub is as good as forbidden, so the walks spread over its other neighbours.
    assert walks.where("pos = 2 and node <> 'hub'").join(
        walks.where("pos = 0").select("walk", F.col("node").alias("start")), "walk").where("node = start").count() < 5


def test_a_walk_may_need_many_draws(spark, monkeypatch):
    monkeypatch.setattr(graph, "FIRST_DRAWS", 1)
    monkeypatch.setattr(graph, "MORE_DRAWS", 2)
    rows = [("a", "b", 1.0), ("b", "c", 1.0)]
    paths = walked(graph.node2vec_walks(edges(spark, rows), 6, keep="all", directed=False, p=20.0, q=0.05))
    assert all(len(p) == 8 for p in paths.values())


@pytest.mark.parametrize("init", ["draw", "k-means||"])
def test_all_k_in_one_scan_equal_plain_rounds(spark, init):
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.standard_normal((40, 3)) + c for c in ([0, 0, 0], [9, 0, 0], [0, 9, 9])] + [np.zeros((1, 3))] * 5)
    frame = spark.createDataFrame([(f"p{n}", p.tolist(), "x", n) for n, p in enumerate(points)] + [("none", None, "x", 0)],
                                  "id string, vector array<double>, other string, cluster_n int").repartition(4)
    assigned, best, scores, centres = cluster.kmeans_best_k(frame, 2, 6, max_iter=30, init=init)
    away = {k: np.sqrt(((points[:, None] - c[None]) ** 2).sum(axis=2)) for k, c in centres.items()}
    for k, d in away.items():
        near = d.argmin(axis=1)
        for c in range(k):  # a fixed point of the rounds
            if (near == c).any():
                assert np.allclose(points[near == c].mean(axis=0), centres[k][c])
        two = np.sort(d, axis=1)
        assert scores[k] == pytest.approx(np.mean(np.divide(two[:, 1] - two[:, 0], two[:, 1], out=np.zeros(len(d)), where=two[:, 1] > 0)))
    assert best == max(scores, key=lambda k: (round(scores[k], 9), -k))
    rows = {r.id: (r.cluster, r.distance) for r in assigned.collect()}
    assert set(rows) == {f"p{n}" for n in range(len(points))}
    assert all(rows[f"p{n}"] == (int(d.argmin()), pytest.approx(d.min())) for n, d in enumerate(away[best]))


def _large(spark):
    """A hub of 200 spokes, a ring, parallel edges and fractional weights."""
    rows = [("hub", f"s{i:03d}", 1 + i % 7 / 10) for i in range(200)] + [(f"s{i:03d}", f"s{(i + 1) % 200:03d}", 2.0) for i in range(200)]
    return spark.createDataFrame(rows + rows[:50] + [("hub", None, 1.0), (None, "s001", 1.0)], "a string, b string, w double")


@pytest.mark.parametrize("make", [
    lambda e: graph.deep_walk(e, 2, keep="all", seed=1), lambda e: graph.deep_walk(e, 1, keep="all", directed=True, mode="dfs&bfs", seed=1),
    lambda e: graph.node2vec_walks(e, 1, keep="all", directed=False, p=2.0, q=0.5, seed=1),
    lambda e: sampling.weighted_draws(graph.merged_edges(graph.edges_of(e), False), 5, 1)])
def test_walks_and_draws_do_not_depend_on_where_edges_lie(spark, monkeypatch, make):
    rows = lambda: sorted(map(tuple, make(_large(spark)).collect()), key=str)
    plain = rows()
    assert plain
    monkeypatch.setattr(graph, "LIGHT", 3)  # guide tables for what has more edges
    monkeypatch.setattr(sampling, "CROWDED", 100)  # the hub in slices
    assert rows() == plain


@pytest.mark.parametrize("make", [lambda e: graph.deep_walk(e, 1, keep="all"), lambda e: graph.node2vec_walks(e, 1, keep="all", directed=False)])
def test_edges_are_shuffled_once_and_stay_with_their_node(spark, monkeypatch, make):
    plans, write = [], graph.stored

    def stored(frame, name):
        if name in ("step", "tried"):
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, name)

    monkeypatch.setattr(graph, "stored", stored)
    make(edges(spark)).count()
    assert plans and all("Bucketed: true" in p for p in plans)
