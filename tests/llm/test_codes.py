"""Fill-in-middle, vector codes and token counts against plain Python and the tokenizer itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoal.llm import infill, part_codes, transducers
from shoal.llm.queries import ORACLES  # noqa: F401 - the module must import
from shoal.llm.tokens import batches_of
from shoal.llm.topk import scaled

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [" a", "a ", "  a  b", "a\n \nb c\t d", "\n\n x", "x \n y", "", "I's we'll  \x1c z", "a\xa0 b", "é é́ ́b c", "<|endoftext|> k", "  \n",
       "'s", "''s", " 's", "x!'s", "a'rea'v'l'll'lx've 're\n're 1'm1 'd'", "\x85 a  b", "日本 語\n日", "x" * 5000, "ab" * 4000, " " * 3000,
       "!" * 2500, "a<|endoftext|><|endoftext|>  <|endoftext|>\n", "\x00a\x00", "a" + "b" * 1100 + "'s", "日本語" * 900]


def drawn(doc_id):
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def plain_infill(doc_id, text):
    text = text or ""
    n, (a, b, c, d) = len(text), drawn(doc_id)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    one, two = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = text[:one], text[one:two], text[two:]
    if d % 100 < 20:
        return n, "spm", one, two - one, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", one, two - one, f"<P>{p}<S>{s}<M>{m}"


def test_infill_equals_plain_python_and_restores(spark, make_docs, odd_rows):
    rng = random.Random(4)
    pool = ["<", "P", ">", "S", "M", "<P", "S>", "a", "é", "日", "\U0001F600", " ", "\n"]
    rows = odd_rows + [(1000 + i, "".join(rng.choice(pool) for _ in range(rng.randrange(12))), "en", "a") for i in range(400)]
    made = infill.restored(infill.infill(make_docs(rows))).collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    want = sorted(((i, t or "", *plain_infill(i, t)) for i, t, _, _ in rows), key=key)
    got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=key)
    assert got == want
    assert {r[3] for r in got} == {"plain", "psm", "spm"}
    assert all(r.restored == r.text for r in made)


def test_infill_of_no_rows_and_outputs_without_form(spark, no_docs):
    assert infill.restored(infill.infill(no_docs)).count() == 0
    odd = spark.createDataFrame([(1, None, "x", 3), (2, "plain", None, None), (3, "plain", "y", 4)],
                                "doc_id long, form string, output string, restored_n int")
    assert {r.doc_id: r.restored for r in infill.restored(odd).collect()} == {1: None, 2: None, 3: "y"}


def test_a_cut_may_fall_anywhere():
    texts = [t.encode() for t in ("aé日\U0001F600b",) * 21]
    cuts = [(a, b) for a in range(6) for b in range(a, 6)]
    for form in ("psm", "spm"):
        forms = np.array([form] * 21, dtype=object)
        out = infill.arrange(texts, forms, np.array([a for a, _ in cuts]), np.array([b - a for a, b in cuts]))
        for (a, b), data in zip(cuts, out, strict=True):
            p, m, s = "aé日\U0001F600b"[:a], "aé日\U0001F600b"[a:b], "aé日\U0001F600b"[b:]
            assert data.decode() == (f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}")
        assert infill.rebuild(out, forms) == texts


@pytest.fixture(scope="module")
def tool():
    return Tokenizer.from_file(PATH)


def test_counts_are_those_of_the_plain_call(tool):
    rng = random.Random(3)
    pool = [" ", " ", "\n", "  ", "a", "the", "'s", "'", "'re", "é", "1", "٣", "²", "!", "_", "日", "<|endoftext|>", "\xa0", "ll", "'v", "'l", "́"]
    letters = "abcdefghijklmnopqrstuvwxyzABC"
    texts = (ODD + ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(2000)]
             + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(500)]
             + ["".join(chr(rng.randrange(0x20, 0x3000)) for _ in range(rng.randrange(60))) for _ in range(200)])
    want = [len(e.ids) for e in tool.encode_batch(texts, add_special_tokens=False)]
    own, got = transducers.Counter(PATH), []
    for part in batches_of(texts, limit=20_000):
        sizes, counts = own.count(texts[part])
        assert sizes.tolist() == [len(t.encode()) for t in texts[part]]
        got += counts.tolist()
    assert got == want


def test_counts_survive_forgetting_and_small_chunks(tool, monkeypatch):
    monkeypatch.setattr(transducers, "KEPT", 50)
    monkeypatch.setattr(transducers, "CHUNK", 3)
    monkeypatch.setattr(transducers, "WORD_CHUNK", 4)
    monkeypatch.setattr(transducers, "WARM", 2)
    rng = random.Random(8)
    texts = [t[:400] for t in ODD] + ["".join(rng.choice("aaabnt e'sl") for _ in range(rng.randrange(90))) for _ in range(200)]
    own = transducers.Counter(PATH)
    got = [n for part in batches_of(texts, limit=300) for n in own.count(texts[part])[1].tolist()]
    assert got == [len(e.ids) for e in tool.encode_batch(texts, add_special_tokens=False)]


def test_every_token_is_one_token_by_its_own_bytes(tool):
    names = [t for t in (tool.decode([i]) for i in range(0, 50_000, 97)) if "�" not in t]
    want = [len(e.ids) for e in tool.encode_batch(names, add_special_tokens=False)]
    assert transducers.counter(PATH).count(names)[1].tolist() == want


def test_token_counts_of_odd_rows(odd_docs, odd_rows, no_docs, tool):
    rows = transducers.token_counts(odd_docs, PATH, limit=50).collect()
    want = [(i, len((t or "").encode()), len(tool.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in odd_rows]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r)) == sorted(
        want, key=lambda r: (r[0] is None, r[0] or 0, r))
    assert all(r.over_limit == (r.n_tokens > 50) for r in rows)
    assert transducers.token_counts(no_docs, PATH).count() == 0


@pytest.mark.parametrize("shape", [(900, 5, 300), (900, 8, 2), (1, 3, 5), (700, 2, 0), (60, 1, 9)])
def test_trees_assign_exactly(shape):
    n, d, s = shape
    rng = np.random.default_rng(n + d)
    points = rng.integers(-s, s + 1, (n, d))
    points[:n // 3] = points[0]
    entries = points[rng.integers(0, n, 16)]
    ball = part_codes.tree(points, leaf=10)
    assert sorted(ball.order.tolist()) == list(range(n))
    for a, b, c, r in zip(ball.start, ball.end, ball.sums, ball.radius, strict=True):
        own = ball.points[a:b].astype(np.int64)
        assert (own.sum(axis=0) == c).all()
        assert (np.sqrt(((own - c / max(b - a, 1)) ** 2).sum(axis=1)) <= r + 1e-9).all()
    want = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    code, sums, numbers, _ = part_codes.assign(ball, entries)
    assert (code == want[ball.order]).all()
    assert (numbers == np.bincount(want, minlength=16)).all()
    for k in range(16):
        assert (sums[k] == points[want == k].sum(axis=0)).all()


def test_balls_spare_comparisons():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 8)) * 1000
    points = (centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 8)) * 30).astype(int)
    looked = part_codes.assign(part_codes.tree(points), points[:16])[3]
    assert looked < 0.1 * 3000 * 16


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None]
    width = -(-max([len(v) for _, v, _ in kept] + [1]) // parts) * parts
    padded = [(i, list(v) + [0] * (width - len(v))) for i, v, _ in kept]
    order = sorted(padded, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    each = width // parts
    books = [[v[p * each:(p + 1) * each] for _, v in order] for p in range(parts)]

    def nearest(p, v):
        own = v[p * each:(p + 1) * each]
        return min((sum((x - y) ** 2 for x, y in zip(own, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = [[[] for _ in books[p]] for p in range(parts)]
        for _, v in padded:
            for p in range(parts):
                groups[p][nearest(p, v)[1]].append(v[p * each:(p + 1) * each])
        books = [[[sum(c) // len(g) for c in zip(*g, strict=True)] if g else e for g, e in zip(groups[p], books[p], strict=True)]
                 for p in range(parts)]
    rows = []
    for i, v in padded:
        found = [nearest(p, v) for p in range(parts)]
        rows.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return rows, books


@pytest.mark.parametrize("odd", [False, True])
def test_vector_codes_equal_plain_python(spark, odd, monkeypatch):
    monkeypatch.setattr(part_codes, "LEAF", 8)
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-50, 50, 16).tolist(), int(i % 3)) for i in range(0, 600, 2)]
    if odd:
        rows += [(7, [1, 2, 3], None), (7, [1, 2, 3], None), (3, [5] * 17, None), (3, [4] * 17, 1), (None, [9] * 16, None), (1, [], 2), (9, None, 2)]
        rows += [(1001 + i, [6] * 16, 1) for i in range(200)]
    frame = spark.createDataFrame([(i, v, label, "c", 1) for i, v, label in rows],
                                  "vec_id long, numbers array<long>, label int, code string, _salt int").repartition(3)
    coded, books = part_codes.compress(frame)
    got = part_codes.with_label_error(coded).collect()
    want, want_books = plain_codes(rows)
    order = lambda rs: sorted(rs, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert order((r.vec_id, r.code, r.error) for r in got) == order(want)
    assert books.tolist() == want_books
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in got) and (None in sums) == odd


def test_vector_codes_of_few_or_no_rows_and_too_large_numbers(spark):
    schema = "vec_id long, numbers array<long>, label int"
    coded, books = part_codes.compress(spark.createDataFrame([], schema))
    assert part_codes.with_label_error(coded).count() == 0 and books.size == 0
    coded, books = part_codes.compress(spark.createDataFrame([(5, [3] * 8, None)], schema))
    assert [tuple(r) for r in coded.collect()] == [(5, None, "00" * 8, 0)] and books.shape == (8, 1, 1)
    with pytest.raises(Exception, match="components must be below"):
        part_codes.compress(spark.createDataFrame([(5, [1 << 26] * 8, None)], schema))


def test_scaled_vectors_leave_out_what_is_not_finite(spark):
    rows = [(1, [0.5, -0.0001]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n for r in frame.select("vec_id", scaled(frame.embedding, 4096.0).alias("n")).collect()}
    assert got == {1: [2048, -1], 2: None, 3: None, 4: None, 5: None}
