"""Neighbours, names and texts against brute force, with blocks small enough to split."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.operators import balls, neighbours, products, sets, textsim, vectors as vectors_module
from shoal.plans import QUERIES


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    data = [(f"v{n:02d}", [float(x) for x in rng.standard_normal(5)]) for n in range(60)] + [("zero", [0.0] * 5)]
    return spark.createDataFrame(data, "id string, vector array<double>").cache()


def brute(rows, metric, n, allowed=None):
    out = {}
    for a, x in rows:
        scored = []
        for b, y in rows:
            if a == b or (allowed and b not in allowed):
                continue
            x_, y_ = np.array(x), np.array(y)
            if metric == "cosine":
                size = np.linalg.norm(x_) * np.linalg.norm(y_)
                scored.append((-round(float(x_ @ y_ / size) if size else 0.0, 12), b))
            else:
                scored.append((round(float(np.linalg.norm(x_ - y_)), 12), b))
        out[a] = [b for _, b in sorted(scored)[:n]]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("id", "rank").collect():
        out.setdefault(r.id, []).append(r.item)
    return out


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("block_rows", [2048, 16])
def test_knn_is_exact(vectors, metric, block_rows):
    rows = [(r.id, r.vector) for r in vectors.collect()]
    assert lists(neighbours.knn(vectors, 4, metric, block_rows=block_rows)) == brute(rows, metric, 4)


def test_knn_allow_self_and_bounds(spark, vectors):
    rows = [(r.id, r.vector) for r in vectors.collect()]
    allow = spark.createDataFrame([("v01",), ("v02",), ("v03",)], "id string")
    deny = spark.createDataFrame([("v02",)], "id string")
    assert lists(neighbours.knn(vectors, 4, allow=allow, deny=deny)) == {
        k: v for k, v in brute(rows, "cosine", 4, {"v01", "v03"}).items()}
    nearest = neighbours.knn(vectors, 1, "euclidean", keep_self=True)
    assert all(r.id == r.item and r.score == 0 for r in nearest.collect())
    assert neighbours.knn(vectors, 60, min_similarity=0.5).agg(F.min("score")).first()[0] >= 0.5
    assert neighbours.knn(vectors, 60, "euclidean", max_distance=1.0).agg(F.max("score")).first()[0] <= 1.0


def recall(found, vectors, n):
    return neighbours.recall_against(found, neighbours.knn(vectors, n)).first().recall


def test_lsh_reaches_its_target_without_structure(vectors):
    assert recall(neighbours.knn_lsh(vectors, 10, block_rows=8), vectors, 10) >= 0.9


def test_lsh_by_default_finds_near_vectors_with_few_comparisons(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((100, 32))
    points = centres[rng.integers(0, 100, 3000)] + rng.standard_normal((3000, 32)) * 0.25
    frame = spark.createDataFrame([(f"c{i}", p.tolist()) for i, p in enumerate(points)], "id string, vector array<double>").cache()
    assert recall(neighbours.knn_lsh(frame, 10), frame, 10) >= 0.9
    setting = neighbours.calibrated(frame, 10)
    assert neighbours.compared_pairs(frame, setting).first().met < 0.1 * 3000 * 2999


def test_probes_go_by_what_they_flip():
    margins = np.array([[3.0, 1.0, 2.5]])
    masks, sums = neighbours.flips(margins)
    assert masks[0].tolist() == [0, 2, 4, 1, 6, 3, 5, 7]
    assert sums[0].tolist() == [0, 1, 2.5, 3, 3.5, 4, 5.5, 6.5]


def test_lsh_of_one_bucket_and_of_nothing(spark):
    frame = spark.createDataFrame([(f"z{i}", [0.0, 0.0]) for i in range(9)] + [("null", None)], "id string, vector array<double>")
    got = lists(neighbours.knn_lsh(frame, 3, bits=2, tables=2, probes=4, block_rows=2))
    assert got["z0"] == ["z1", "z2", "z3"] and set(got) == {f"z{i}" for i in range(9)}
    assert neighbours.knn_lsh(frame.limit(0), 3).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, previous = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(previous[j] + 1, row[-1] + 1, previous[j - 1] + (x != y)))
    return row[-1]


def test_edit_pairs_find_everything(spark):
    random.seed(5)
    names = sorted({"".join(random.choice("abc") for _ in range(random.randint(3, 9))) for _ in range(120)})
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    for most in (1, 2):
        got = {(r.name_1, r.name_2): r.distance for r in textsim.edit_pairs(frame, "name", most).collect()}
        assert got == {(a, b): distance(a, b) for a in names for b in names if a != b and distance(a, b) <= most}
    assert textsim.edit_pairs(frame, "name", 2, block_rows=3).count() == len(got)
    got = {(r.name_1, r.name_2) for r in textsim.edit_pairs(frame, "name", 0.25, share=True).collect()}
    assert got == {(a, b) for a in names for b in names if a != b and distance(a, b) / len(a) <= 0.25}


def test_copies_of_a_name_stay_one_row(spark):
    items = spark.createDataFrame([(n, "same name") for n in range(50)] + [(50, "same nome"), (51, "other")], "item_id int, title string")
    rows = {(r.name_1, r.name_2): (r.items_1, r.items_2) for r in textsim.similar_names(items, F.col("title"), 1, 4).collect()}
    assert rows == {("same name", "same name"): (50, 50), ("same name", "same nome"): (50, 1), ("same nome", "same name"): (1, 50)}


def test_group_members_and_barred_owners(spark):
    items = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, 0)], "item_id int, developer_id int")
    assert {r.item_id: r.others for r in textsim.group_members(items, "item_id", "developer_id").collect()} == {1: 1, 2: 1, 3: 0, 4: 0}
    barred = spark.createDataFrame([(1,), (4,)], "item_id int")
    assert sorted(r.item_id for r in textsim.items_of_barred_groups(items, "item_id", "developer_id", barred).collect()) == [1, 2]


@pytest.mark.parametrize("block_rows", [512, 3])
def test_tfidf_against_brute_force(spark, block_rows):
    docs = {"a": "x y y z", "b": "x y q", "c": "z z w", "d": "x x x", "e": "q w x", "f": "lonely x"}
    docs = {k: v.split() for k, v in docs.items()}
    n = len(docs)
    df = {t: sum(t in d for d in docs.values()) for d in docs.values() for t in d}
    vec = {k: {t: d.count(t) * math.log((n + 1) / (df[t] + 1)) for t in set(d)} for k, d in docs.items()}

    def cos(a, b):
        dot = sum(w * vec[b].get(t, 0) for t, w in vec[a].items())
        size = math.sqrt(sum(w * w for w in vec[a].values()) * sum(w * w for w in vec[b].values()))
        return dot / size if size else 0

    expected = {}
    for a in docs:
        best = sorted((-round(cos(a, b), 12), b) for b in docs if b != a and cos(a, b) > 1e-12)[:3]
        if best:
            expected[a] = [b for _, b in best]
    frame = spark.createDataFrame(list(docs.items()), "id string, words array<string>")
    assert lists(textsim.tfidf_top_n(frame, 3, block_rows=block_rows)) == expected


def test_hashed_tfidf_keeps_positive_scores(spark):
    frame = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x", "z"]), ("c", ["w"])], "id string, words array<string>")
    assert all(r.score > 0 for r in textsim.tfidf_top_n(frame, 3, features=64).collect())


def test_symmetric_and_diff(spark):
    near = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c"), ("c", "a")], "id string, item string")
    assert {(r.id, r.item) for r in sets.symmetric(near).collect()} == {("a", "b"), ("b", "a"), ("a", "c"), ("c", "a")}
    new = spark.createDataFrame([(1, "x"), (2, "y2"), (3, "z"), (4, None)], "k int, icon string")
    old = spark.createDataFrame([(1, "x"), (2, "y")], "k int, icon string")
    assert {r.icon for r in sets.snapshot_diff(new, old, "k", "icon").collect()} == {"y2", "z"}


def test_rare_terms_in_steps_equal_one_product(monkeypatch):
    rng = np.random.default_rng(3)
    left, right = rng.random((7, 60)) * (rng.random((7, 60)) < 0.2), rng.random((9, 60)) * (rng.random((9, 60)) < 0.2)
    sides = [(*np.nonzero(m), m[np.nonzero(m)]) for m in (left, right)]
    for step in (1, 5, 1 << 22):
        monkeypatch.setattr(textsim, "_PRODUCT_STEP", step)
        monkeypatch.setattr(textsim, "_COMMON_SHARE", 1.0)
        assert np.allclose(textsim._sparse_product(*sides, 7, 9), left @ right.T)


@pytest.fixture(scope="module")
def clustered(spark):
    """Twelve clusters, copies, zero vectors and a hub of equal vectors."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 6)) * 6
    rows = [(f"c{n:03d}", (centres[n % 12] + rng.standard_normal(6) * 0.1).tolist()) for n in range(360)]
    rows += [(f"hub{n:02d}", centres[0].tolist()) for n in range(40)] + [(f"zero{n}", [0.0] * 6) for n in range(3)]
    return spark.createDataFrame(rows, "id string, vector array<double>").cache()


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("n", [3, 30, 500])
def test_balls_are_exact(spark, clustered, metric, n):
    rows = [(r.id, r.vector) for r in clustered.collect()]
    assert lists(neighbours.knn(clustered, n, metric, block_rows=20)) == brute(rows, metric, n)


def test_balls_are_exact_with_few_candidates(spark, clustered):
    rows = [(r.id, r.vector) for r in clustered.collect()]
    allow = spark.createDataFrame([(i,) for i, _ in rows if i.endswith("7")], "id string")
    deny = spark.createDataFrame([("c007",)], "id string")
    names = {i for i, _ in rows if i.endswith("7")} - {"c007"}
    for metric in ("cosine", "euclidean"):
        assert lists(neighbours.knn(clustered, 5, metric, allow=allow, deny=deny, block_rows=16)) == brute(rows, metric, 5, names)
    bounded = {k: [b for b in v] for k, v in lists(neighbours.knn(clustered, 400, min_similarity=0.9, block_rows=16)).items()}
    want = lists(neighbours.knn(clustered, 400, min_similarity=0.9))
    assert bounded == want and 0 < sum(map(len, want.values())) < 403 * 60
    assert neighbours.knn(clustered.limit(0), 3).count() == 0


def test_a_vector_goes_once_to_a_bunch_of_blocks(spark, vectors, monkeypatch):
    """Vectors without structure have to see all blocks; they are not sent to each of them."""
    seen = {}
    monkeypatch.setattr(balls, "stored", lambda df, name: seen.setdefault(name, df.cache()))
    rows = [(r.id, r.vector) for r in vectors.collect()]
    assert lists(neighbours.knn(vectors, 4, block_rows=4)) == brute(rows, "cosine", 4)
    blocks = seen["blocks"].where("kind = 'block'").count()
    assert blocks > 16
    assert seen["messages"].agg(F.sum(F.size("ids"))).first()[0] <= len(rows) * -(-blocks // balls.MESSAGES)


def test_the_best_of_several_blocks_are_those_of_one():
    rng = np.random.default_rng(2)
    left, right = rng.integers(0, 3, (9, 4)).astype(float), rng.integers(0, 3, (40, 4)).astype(float)
    names = np.array([f"n{i:02d}" for i in range(40)], dtype=object)
    ids = names[:9]
    got = vectors_module.reaching(ids, left, np.full(9, -np.inf), np.ones((9, 4), dtype=bool),
                                  [(b, right[b::4], names[b::4]) for b in range(4)], lambda a, b: a @ b.T, 5, 2.0, False)
    want = vectors_module.best_per_row(left @ right.T, ids, names, 5, 2.0, False)
    assert got.sort_values(["id", "score", "item"]).to_numpy().tolist() == want.sort_values(["id", "score", "item"]).to_numpy().tolist()


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e6, 1e160])
def test_few_differences_are_taken_and_none_that_counts_is_missing(scale):
    rng = np.random.default_rng(8)
    left, right = rng.standard_normal((90, 40)) * scale, rng.standard_normal((300, 40)) * scale
    right[:30], right[40:50] = left[:30], right[:10]
    with np.errstate(over="ignore"):
        exact = vectors_module.similarities(left, right, "euclidean")
        tenth = np.round(-np.sort(-exact, axis=1)[:, 9], 12)
        # Every third row has no bound so far and asks for its ten highest.
        got = vectors_module.near_distances(left, right, np.where(np.arange(90) % 3 == 0, -np.inf, tenth), 10)
    counts = np.round(exact, 12) >= tenth[:, None]
    assert (got[counts] == exact[counts]).all()
    assert ((got == exact) | np.isneginf(got)).all()
    assert np.isfinite(got).sum() <= 2 * 90 * 10


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_vectors_meet_the_pivots_a_few_at_a_time(vectors, metric, monkeypatch):
    """What a task holds against all pivots does not grow with the batch or the block."""
    rows, most = [(r.id, r.vector) for r in vectors.collect()], []
    monkeypatch.setattr(balls, "STEP", 3)
    assert lists(neighbours.knn(vectors, 4, metric, block_rows=16)) == brute(rows, metric, 4)
    plain = balls.distances
    monkeypatch.setattr(balls, "distances", lambda a, b: most.append(len(a)) or plain(a, b))
    matrix = np.array([v for _, v in rows])
    cell, away = balls.placed_at(matrix, balls.placed(matrix[:7], metric), metric)
    full = plain(balls.placed(matrix, metric), balls.placed(matrix[:7], metric))
    assert max(most) == 3
    assert cell.tolist() == full.argmin(axis=1).tolist()
    assert np.allclose(away, full.min(axis=1))


def test_headers_spare_most_cells():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    points = balls.placed(centres[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 16)) * 0.02, "cosine")
    pivots = points[:80]
    away = balls.distances(points, pivots)
    cell = away.argmin(axis=1)
    ends = [away[cell == c, c] for c in range(80)]
    head = balls.Headers(pivots, np.array([e.min(initial=9) for e in ends]), np.array([e.max(initial=0) for e in ends]),
                         np.bincount(cell, minlength=80), np.ones(80, dtype=np.int64))
    exact = points[:, :-1] @ points[:, :-1].T
    tenth = -np.sort(-exact, axis=1)[:, 10]
    wanted = np.concatenate([balls.limits(points[cell == c], c, head, tenth[cell == c], 10, "cosine") for c in np.unique(cell)])
    order = np.argsort(cell, kind="stable")
    assert wanted.mean() < 0.1
    needed = np.zeros(wanted.shape, dtype=bool)
    for k, i in enumerate(order):
        needed[k, cell[exact[i] >= tenth[i]]] = True
    assert (wanted | ~needed).all()


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_products_are_exact(spark, monkeypatch, block_rows):
    monkeypatch.setattr(products, "USER_ROWS", 11)
    rng = np.random.default_rng(4)
    users = [(f"u{i:02d}", rng.standard_normal(4)) for i in range(40)] + [("zero", np.zeros(4))]
    items = [(f"i{i:03d}", rng.standard_normal(4) * rng.pareto(2)) for i in range(150)] + [(f"same{i}", np.ones(4)) for i in range(5)]
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in rows], "id string, vector array<double>") for rows in (users, items)]
    got = lists(products.top_by_product(*frames, 6, block_rows=block_rows))
    assert got == {u: [i for _, i in sorted((-round(float(a @ b), 12), i) for i, b in items)[:6]] for u, a in users}
    assert products.top_by_product(frames[0], frames[1].limit(0), 3).count() == 0


def test_blocks_meet_in_bunches(spark, monkeypatch):
    """A row goes to the cells of its bunch, not of its block, and the best of all blocks are found."""
    monkeypatch.setattr(neighbours, "SMALL_BLOCK", 1 << 20)
    rng = np.random.default_rng(6)
    points = rng.integers(0, 4, (150, 3)).astype(float)
    rows = spark.createDataFrame([(f"t{i:03d}", x.tolist()) for i, x in enumerate(points)], "id string, vector array<double>")
    made = neighbours.all_pairs_top_n(rows, "id", 3, lambda a, b: np.stack(a["vector"].to_numpy()) @ np.stack(b["vector"].to_numpy()).T, 4)
    got = lists(neighbours.top_n(made, ["id"], [F.desc("score"), F.asc("item")], 4))
    names = [f"t{i:03d}" for i in range(150)]
    assert got == {a: [b for _, b in sorted((-(x @ y), b) for b, y in zip(names, points) if a != b)[:4]] for a, x in zip(names, points)}
    bunches = -(-150 // (neighbours.BUNCH * 3))
    assert made.where("id <> ''").count() <= 150 * 4 * (bunches + 1)


@pytest.mark.parametrize("n", [1, 4, 40])
def test_best_per_row_sorts_only_what_can_win(monkeypatch, n):
    rng = np.random.default_rng(1)
    scores = np.round(rng.random((12, 30)), 1) + rng.random((12, 30)) * 1e-14
    scores[2, 3], scores[4], scores[5, :7] = np.nan, -np.inf, np.inf
    names = np.array([f"n{i:02d}" for i in range(29)] + [None], dtype=object)
    rows = []
    for i in range(12):
        shown = sorted((-x, j) for j, x in enumerate(np.round(scores[i], 12)) if not np.isnan(x) and x >= 0.3 and j != i)[:n]
        rows += [[names[i], names[j], -x] for x, j in shown if np.isfinite(x)]
    sizes = []
    plain = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, **how: sizes.append(len(keys[0])) or plain(keys, **how))
    got = vectors_module.best_per_row(scores, names[:12], names, n, 0.3, False)
    assert got.to_numpy().tolist() == rows
    assert sizes and sizes[0] < scores.size


def test_lsh_cells_grow_with_the_table(vectors, monkeypatch):
    """Blocks of a cell change nothing in the result, and a vector is not sent to each of them."""
    want = lists(neighbours.knn_lsh(vectors, 4, 2, 2, 2))
    seen, plain = [], neighbours.grid
    monkeypatch.setattr(neighbours, "grid", lambda left, right, keys, member, rows: seen.append(rows) or plain(left, right, keys, member, rows))
    assert lists(neighbours.knn_lsh(vectors, 4, 2, 2, 2, block_rows=2)) == want
    assert seen == [2 * (61 // 8)]


def text_lists(docs, n, rows):
    """Brute force over words by id; ``rows`` is the number of rows, as ids may repeat."""
    df = {t: sum(t in d for d in docs.values()) for d in docs.values() for t in d}
    vec = {k: {t: d.count(t) * math.log((rows + 1) / (df[t] + 1)) for t in set(d)} for k, d in docs.items()}
    size = {k: math.sqrt(sum(w * w for w in v.values())) for k, v in vec.items()}
    out = {}
    for a in docs:
        found = [(-round(sum(w * vec[b].get(t, 0) for t, w in vec[a].items()) / (size[a] * size[b]), 12), b)
                 for b in docs if b != a and size[a] and size[b]]
        if best := [b for score, b in sorted(found) if score < 0][:n]:
            out[a] = best
    return out


@pytest.mark.parametrize("bunch", [1, 4])
def test_texts_lie_once_in_packed_bunches(spark, monkeypatch, bunch):
    """Bunches meet two by two; a text is in one of them and nowhere else."""
    seen, plain = {}, textsim.stored
    monkeypatch.setattr(textsim, "stored", lambda df, name: seen.setdefault(name, plain(df, name)))
    monkeypatch.setattr(textsim, "TEXT_BUNCH", bunch)
    monkeypatch.setattr(textsim, "_TERM_STEP", 3)
    rng = np.random.default_rng(9)
    docs = {f"d{i:02d}": [f"w{int(w)}" for w in rng.zipf(1.5, rng.integers(1, 9)) if w < 40] + ["all"] for i in range(70)}
    docs |= {f"same{i}": ["twin", "pair", "all"] for i in range(7)} | {"bare": ["all"]}
    rows = list(docs.items()) + [("d03", ["w1", "w1", "more"]), ("none", None), ("empty", [])]
    got = lists(textsim.tfidf_top_n(spark.createDataFrame(rows, "id string, words array<string>"), 4, block_rows=3))
    assert got == text_lists(docs | {"d03": docs["d03"] + ["w1", "w1", "more"]}, 4, len(rows))
    kept = seen["weighed-bunches"]
    assert kept.count() >= 70 // (3 * bunch) and kept.agg(F.sum(F.size("ids"))).first()[0] == len(docs)


def test_equal_scores_take_no_place_and_bounds_rise():
    rng = np.random.default_rng(4)
    scores = np.round(rng.random((5, 40)), 1) * (rng.random((5, 40)) < 0.6)
    best, other = textsim._Best(5, 4), textsim._Best(5, 4)
    for at in range(0, 40, 8):
        best.see(scores[:, at:at + 8], at, 0)
        other.see(scores[:, at:at + 8].T, at, 1)
    want = [(r, c) for r in range(5) for c in sorted(np.flatnonzero(scores[r]), key=lambda c: (-scores[r, c], c))[:4]]
    for found in (best, other):
        assert list(zip(found.row, found.item)) == want
        assert found.bound.tolist() == [scores[r, want[4 * r + 3][1]] for r in range(5)]


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_a_part_gives_up_its_best_once(vectors, metric, monkeypatch):
    """Blocks pass by parts; what leaves them does not grow with the blocks."""
    rows, left, plain = [(r.id, r.vector) for r in vectors.collect()], [], balls._passing
    monkeypatch.setattr(balls, "PART_ROWS", 8)
    monkeypatch.setattr(balls, "_passing", lambda *args: left.append(plain(*args)) or left[-1])
    assert lists(neighbours.knn(vectors, 4, metric, block_rows=4)) == brute(rows, metric, 4)
    assert left[0].groupBy("id").count().agg(F.max("count")).first()[0] == 4


def test_rows_hold_a_few_times_n_of_equal_items():
    rng = np.random.default_rng(5)
    names = np.array([f"n{i:03d}" for i in rng.permutation(400)], dtype=object)
    rows = vectors_module.Reaching(np.array(["a", "n007"], dtype=object), np.ones((2, 1)), np.full(2, -np.inf), 6, None, False)
    held = []
    for at in range(0, 400, 20):
        rows.see(np.arange(2), np.ones((20, 1)), names[at:at + 20], lambda a, b: a @ b.T)
        held.append(len(rows.own))
    assert max(held) <= 2 * 6 * 2
    got = rows.found()
    assert got[got["id"] == "a"]["item"].tolist() == [f"n{i:03d}" for i in range(6)]
    assert got[got["id"] == "n007"]["item"].tolist() == [f"n{i:03d}" for i in range(6)]


def test_the_cosine_list_is_as_long_as_the_published_one(spark, tmp_path):
    """A list holds 100 neighbours, not the first few of them."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(120)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.id: [p.split("&")[0] for p in r.value.split(",")] for r in QUERIES["knn_cosine_list"](spark, str(tmp_path)).collect()}
    assert got == brute([(str(i), np.float32(v).astype(float)) for i, v in rows], "cosine", 100)


def test_a_user_is_sent_once_and_lists_leave_once(spark, monkeypatch):
    """Many blocks of items of one length, so that no bound spares any: users are not sent to each of them."""
    monkeypatch.setattr(products, "USER_ROWS", 8)
    seen, left, plain, passing = {}, [], products.stored, products._passing
    monkeypatch.setattr(products, "stored", lambda df, name: seen.setdefault(name, plain(df, name)))
    monkeypatch.setattr(products, "_passing", lambda *args: left.append(passing(*args)) or left[-1])
    rng = np.random.default_rng(2)
    unit = lambda n: [v / np.linalg.norm(v) for v in rng.standard_normal((n, 3))]
    users, items = [(f"u{i:02d}", v) for i, v in enumerate(unit(40))], [(f"i{i:03d}", v) for i, v in enumerate(unit(200))]
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in rows], "id string, vector array<double>") for rows in (users, items)]
    got = lists(products.top_by_product(*frames, 5, block_rows=10))
    assert got == {u: [i for _, i in sorted((-round(float(a @ b), 12), i) for i, b in items)[:5]] for u, a in users}
    assert seen["item-blocks"].count() >= 20
    assert seen["users"].where("kind = 'sent'").agg(F.sum(F.size("ids"))).first()[0] <= 40
    assert left[0].groupBy("id").count().agg(F.max("count")).first()[0] <= 5
