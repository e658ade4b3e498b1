"""Top-k, quality, language, archives and the pipeline."""

import base64
import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.llm import language, quality, topk, warc
from shoal.session import scratch_path


def brute_top(rows, k):
    good = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            v = [int(np.floor(1024 * float(x))) for x in e]
            good[i] = min(good.get(i, v), v)
    out = []
    for q, v in good.items():
        if q % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good.items() if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(8) * rng.choice([0.1, 1, 20])).tolist()) for i in range(900)]
    rows += [(1000 + i, [1.0] * 8) for i in range(40)] + [(1100, [1.0] * 8), (1200, [0.0] * 8), (1300, None), (1400, [float("nan")] * 8),
             (1500, [None] * 8), (1600, [float("inf")] * 8), (None, [1.0] * 8), (1700, [1.0, 2.0]), (1701, [3.0, 4.0]), (1800, []), (5, rows[5][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = frame.select("vec_id", topk.scaled(F.col("embedding")).alias("numbers"), F.lit("x").alias("block"), F.lit(1).alias("dim"))
    got = topk.top_k(vectors, F.col("vec_id") % 100 == 0, 10)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 10)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 100 == 0, 10).count() == 0


def test_pruning_loses_nothing():
    rng = np.random.default_rng(2)
    for spread in (0.01, 0.2, 2.0):
        centre = rng.standard_normal((1, 16)) * 1000
        vectors = np.floor(centre + rng.standard_normal((500, 16)) * 1000 * spread).astype(np.int64)
        vectors = vectors[np.argsort(-topk._lengths(vectors), kind="stable")]
        ids = rng.permutation(500)
        scores = topk.products(vectors[:20], vectors)
        least = np.sort(scores, axis=1)[:, -15].astype(float)
        got = collections.defaultdict(list)
        for q, i, s in topk.search_bucket(ids[:20], vectors[:20], least, ids, vectors, 10):
            got[q].append((-s, i))
        for row, q in zip(scores, ids[:20], strict=True):
            want = sorted((-int(s), int(i)) for s, i in zip(row, ids, strict=True) if i != q)[:10]
            assert sorted(got[int(q)]) == want
    huge = np.array([[2**40, 3], [2**40, 5]], dtype=np.int64)
    assert topk.products(huge[:1], huge).tolist() == [[2**63 - 1, 2**63 - 1]]


def test_pruning_keeps_parallel_and_sparse_vectors():
    rng = np.random.default_rng(4)
    cases = [rng.integers(-1000, 1000, (300, dim)) for dim in (1, 2)]
    for dim in (3, 16):  # one dominant coordinate of either sign, of different lengths
        axes = np.eye(dim)[rng.integers(dim, size=300)] * rng.choice([-1, 1], (300, 1)) * rng.integers(500, 1500, (300, 1))
        cases += [axes, axes + rng.standard_normal((300, dim)) * 100]
    cases.append(np.array([[950, 312], [1900, 624], [2375, 780], [1000, 800]]))
    for vectors in cases:
        vectors = np.unique(np.floor(vectors).astype(np.int64), axis=0)
        vectors = vectors[np.argsort(-topk._lengths(vectors), kind="stable")]
        ids, n = np.arange(len(vectors)), len(vectors)
        scores = topk.products(vectors, vectors)
        for place in (1, 3, 12):  # bounds from tight to loose
            least = np.sort(scores, axis=1)[:, -min(place, n)].astype(float)
            got = collections.defaultdict(list)
            for q, i, s in topk.search_bucket(ids, vectors, least, ids, vectors, 10):
                got[q].append((-s, i))
            for q, row in enumerate(scores):
                want = sorted((-int(s), i) for i, s in enumerate(row) if i != q and s >= least[q])[:10]
                assert sorted(got[q]) == want


def test_top_k_of_one_hot_like_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(rng.standard_normal() * 5)]) for i in range(300)]
    rows += [(1000 + i, (np.eye(4)[rng.integers(4)] * rng.uniform(-9, 9) + rng.standard_normal(4) * 0.1).tolist()) for i in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("vec_id", topk.scaled(F.col("embedding")).alias("numbers"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(topk, "BUCKET", 64)
        assert sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 100 == 0, 10).collect())) == brute_top(rows, 10)


@pytest.fixture(scope="module")
def judged(spark, make_docs):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(600):
        good = rng.random() < 0.7
        own = ["".join(rng.choice("abcdeio") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 90))]
        rows.append((i, " ".join(own) + "." if good else " ".join(w.upper() + "!!" for w in own), "en", "a"))
        marks.append((i, int(good)))
    rows += [(700, None, "en", "a"), (701, "", None, None), (None, rows[0][1], "en", "a")]
    labels = spark.createDataFrame(marks + [(0, None), (None, 1)], "doc_id long, label int")
    return make_docs(rows), labels, dict(marks)


def test_quality_on_held_out_documents(judged, no_docs):
    docs, labels, marks = judged
    learn = language.crc_mod(F.col("doc_id"), 5) != 0
    found = quality.scored(docs, labels, learn).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    held = {r[0] for r in docs.filter(~learn).select("doc_id").collect()}
    right = [(r.score >= quality.THRESHOLD) == bool(marks[r.doc_id]) for r in found if r.doc_id in held and r.doc_id in marks]
    assert np.mean(right) > 0.97
    kept = quality.accepted(docs, labels, learn)
    assert kept.dtypes == docs.dtypes and 380 < kept.count() < 470
    assert quality.scored(no_docs, labels, learn).count() == 0
    assert {r.score for r in quality.scored(docs, labels.limit(0), learn).collect()} == {1.0}


def test_scores_do_not_depend_on_the_size_of_the_sample(spark, make_docs, monkeypatch):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["one", "two", "three", "four", "five", "six"]) for _ in range(40)), "en", "a") for i in range(1200)]
    rows.append((2000, "", "en", "a"))
    marks = [(i, int(rng.random() < 0.75)) for i in range(1000)]  # labels say nothing about these texts: every neighbourhood is mixed
    docs, labels = make_docs(rows), spark.createDataFrame(marks, "doc_id long, label int")
    share = np.mean([label for _, label in marks])
    for per_label in (2000, 400, 100):
        monkeypatch.setattr(quality, "PER_LABEL", per_label)
        found = {r.doc_id: r.score for r in quality.scored(docs, labels, F.lit(True)).collect()}
        assert abs(found[2000] - share) < 1e-6
        assert abs(np.mean([found[i] for i in range(1000, 1200)]) - share) < 0.08


def test_language_on_held_out_documents(make_docs, no_docs):
    rng = random.Random(4)
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "eng", "ich", "ung"], "cc": ["ção", "lhe", "nho", "ais"]}
    rows = []
    for i in range(300):
        lang = rng.choice(list(syllables))
        rows.append((i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(rng.randrange(3, 50))), lang, "a"))
    rows += [(400, None, "aa", "a"), (401, "", "aa", "a"), (402, "12 ?!", "bb", None), (403, rows[0][1], None, "a"), (None, rows[1][1], "aa", "a")]
    held = F.coalesce(language.crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = make_docs(rows)
    found = {r.doc_id: r for r in language.identify(docs, ~held).collect()}
    out = {r[0] for r in docs.filter(held).select("doc_id").collect()}
    right = [found[i].lang_pred == lang for i, _, lang, _ in rows[:300] if i in out]
    assert len(right) > 40 and np.mean(right) > 0.97
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (400, 401, 402))
    assert found[403].lang_pred == rows[0][2] and all(0 <= r.score <= 1 for r in found.values())
    assert language.identify(no_docs, ~held).count() == 0
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string")), ~held).collect()} == {"und"}


def test_archives_round_trip(spark):
    pages = [(3, "http://a/", "<p>one</p>"), (1, "http://b/", "<p>one</p>"), (2, None, None), (5, "http://c/\r\nX: y", ""),
             (4, "http://d/", "x\r\n\r\nWARC/1.1\r\n\r\n" * 30), (6, "http://é/", "ü" * 70_000), (None, "http://e/", "<p>one</p>"), (None, "u", "alone"),
             (7, "http://f/", "twice"), (7, "http://f/", "twice")]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, digest string, bytes int")
    folder = scratch_path(spark, "warc")
    warc.write_archives(frame, folder)
    got = warc.read_archives(spark, folder, with_payload=True).collect()
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = collections.Counter()
    for i, _, html in pages:
        data = (html or "").encode()
        origin = first.get(html or "")
        again = origin is not None and origin != i
        want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
             origin if again else None, None if again else data] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                                None if r.payload is None else bytes(r.payload)) for r in got) == want
    assert {r.page_id: r.url for r in got}[5] == "http://c/%0D%0AX: y"
    assert warc.archived(frame, min_bytes=10**6).filter("record_type = 'revisit'").count() == 0
    assert warc.archived(frame.limit(0)).count() == 0


def test_numbers_and_signs_are_no_letters(make_docs):
    signs = ["½ ² ①", "Ⅷ", "٣", "_", "12", "ª", "ʰ", "中"]
    rows = [(i, "the cat and the dog", "en", "a") for i in range(12)] + [(20 + i, "der hund und die katze", "de", "a") for i in range(12)]
    rows += [(100 + i, t, None, "a") for i, t in enumerate(signs)]
    found = {r.doc_id: r for r in language.identify(make_docs(rows), F.lit(True)).collect()}
    told = [found[100 + i].lang_pred != "und" for i in range(len(signs))]
    assert told == [False, False, False, False, False, True, True, True]
    assert all(found[100 + i].score == 0 for i in range(5))


def test_language_scores_equal_the_kernel_regression(make_docs, monkeypatch):
    """Kernel between text and landmarks, Nyström map and ridge solved as one weighted least-squares problem, nothing folded."""
    monkeypatch.setattr(language, "LANDMARKS", 20)
    rng = random.Random(9)
    vocabulary = {"en": "the and of to in that is was for it with".split(), "de": "der die und das ist nicht ein zu von mit".split(),
                  "fr": "le la et les des est que une dans pour".split()}
    rows = [(i, " ".join(rng.choice(vocabulary[lang]) for _ in range(rng.randrange(3, 20))), lang, "a")
            for i, lang in enumerate(rng.choice(["en", "en", "de", "fr"]) for _ in range(90))]
    found = {r.doc_id: r for r in language.identify(make_docs(rows), F.col("doc_id") < 70).collect()}

    def grams(text):
        row = np.zeros(language.PLACES, dtype=np.uint8)
        language.presence(text, row)
        return frozenset(np.flatnonzero(row).tolist())

    sets = {i: grams(t) for i, t, _, _ in rows}
    lang_of = {i: lang for i, _, lang, _ in rows}
    kernel = lambda a, b: len(sets[a] & sets[b]) / np.sqrt(len(sets[a]) * len(sets[b]))
    learnt = sorted(i for i in lang_of if i < 70)
    turns, seen = [], {}
    for i in learnt:
        seen[lang_of[i]] = seen.get(lang_of[i], 0) + 1
        turns.append((seen[lang_of[i]], lang_of[i], i))
    marks = [i for *_, i in sorted(turns)][:20]
    values, vectors = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    good = values > 1e-6 * values[-1]
    mapped = {i: np.array([kernel(i, m) for m in marks]) @ (vectors[:, good] / np.sqrt(values[good])) for i in lang_of}
    names = sorted(set(lang_of.values()))
    weight = np.array([1 / sum(lang_of[j] == lang_of[i] for j in learnt) for i in learnt])
    x = np.stack([np.append(mapped[i], 1.0) for i in learnt])
    ridge = np.diag([language.RIDGE * weight.sum() / len(learnt)] * (x.shape[1] - 1) + [0.0])
    solved = np.stack([np.linalg.solve(x.T @ (x * weight[:, None]) + ridge, x.T @ (weight * np.array([lang_of[i] == n for i in learnt])))
                       for n in names], axis=1)
    for i in lang_of:
        scores = np.append(mapped[i], 1.0) @ solved
        assert found[i].lang_pred == names[int(scores.argmax())]
        assert abs(found[i].score - np.clip(scores.max(), 0, 1)) < 1e-4


def test_quality_scores_equal_plain_votes(judged, monkeypatch):
    """Terms weighed by all texts, mapped, compared one by one, the nearest voting: nothing blocked, packed or broadcast."""
    monkeypatch.setattr(quality, "PER_LABEL", 60)
    docs, labels, marks = judged
    learn = language.crc_mod(F.col("doc_id"), 5) != 0
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    terms = {i: quality.term_counts([t.encode()])[0].astype(np.float64) for i, (_, t) in enumerate(rows)}
    idf = np.log((1 + len(rows)) / (1 + sum((t > 0).astype(int) for t in terms.values()))) + 1
    assert np.allclose(quality.inverse_frequencies(docs), idf)
    learnt = [(r.doc_id, marks[r.doc_id]) for r in docs.filter(learn).select("doc_id").distinct().collect() if r.doc_id in marks]
    by_label = {label: sorted((i for i, own in learnt if own == label), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
                for label in (0, 1)}
    drawn = {i: (label, len(ids) / min(len(ids), 60)) for label, ids in by_label.items() for i in ids[:60]}
    unit = {}
    for k, t in terms.items():
        unit[k] = t * idf / max(np.sqrt(((t * idf) ** 2).sum()), 1e-12)
    voters = sorted((k for k, (i, _) in enumerate(rows) if i in drawn), key=lambda k: rows[k][0])
    model = quality.Voters(np.stack([terms[k] for k in voters]).astype(np.float32), np.array([drawn[rows[k][0]][0] for k in voters]),
                           np.array([drawn[rows[k][0]][1] for k in voters]), idf)
    vector = {k: (unit[k] @ model.map) / max(np.linalg.norm(unit[k] @ model.map), 1e-12) for k in unit}
    found = {(r.doc_id, r.text): r.score for r in docs.withColumn("score", quality.score_of(docs, labels, learn)(F.col("text")))
             .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "score").collect()}
    off = 0
    for k, (i, text) in enumerate(rows):
        near = sorted(((float(vector[k] @ vector[v]), v) for v in voters), reverse=True)
        edge = near[quality.NEIGHBOURS - 1][0] if len(near) >= quality.NEIGHBOURS else near[-1][0]
        votes = [(max(s, 1e-6) ** 4 * drawn[rows[v][0]][1], drawn[rows[v][0]][0]) for s, v in near if s >= edge - 1e-6]
        off += abs(found[i, text] - sum(w for w, label in votes if label) / sum(w for w, _ in votes)) > 1e-3
    assert off <= 0.01 * len(rows)  # float ties at the edge of the neighbourhood


def test_quality_takes_odd_rows(odd_docs, spark, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(0, 1), (None, 0), (1, None)], "doc_id long, label int")
    kept = quality.accepted(odd_docs, labels, F.lit(True))
    assert kept.dtypes == odd_docs.dtypes and 0 < kept.count() <= odd_docs.count()
    scores = quality.scored(odd_docs, labels, F.lit(True)).collect()
    assert len(scores) == odd_docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert quality.accepted(no_docs, labels, F.lit(True)).count() == 0
    found = language.identify(odd_docs, F.lit(True)).collect()
    assert len(found) == odd_docs.count() and {r.lang_pred for r in found} <= {"en", "de", "und"}


def test_headers_decide_which_blocks_meet(spark, monkeypatch):
    """With lengths far apart few buckets are sent any query; with equal lengths all are. The result is exact in both cases."""
    monkeypatch.setattr(topk, "BUCKET", 32)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(8)
    shares = []
    for spread in (0.0, 3.0):
        lengths = np.exp(spread * rng.standard_normal(800)) * 5
        points = rng.standard_normal((800, 6))
        points *= (lengths / np.linalg.norm(points, axis=1))[:, None]
        rows = [(i, p.tolist()) for i, p in enumerate(points)]
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("vec_id", topk.scaled(F.col("embedding")).alias("numbers"))
        assert sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 100 == 0, 10).collect())) == brute_top(rows, 10)
        sized = vectors.withColumn("dim", F.size("numbers")).withColumn("norm", F.aggregate("numbers", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
        buckets, groups = topk._blocks(sized, "v", 32).cache(), topk._blocks(sized.filter("vec_id % 100 = 0"), "q", 4).cache()
        sent = topk._sent(buckets, groups, topk._bounds(buckets, groups, 10)).collect()
        shares.append(sum(len(r.ids) // 8 for r in sent) / (8 * buckets.count()))
    assert shares[0] == 1.0 and shares[1] < 0.3
