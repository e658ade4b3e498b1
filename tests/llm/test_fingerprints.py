"""Fingerprints against plain Python, down to the hashes: words, grams, kept runs, digest, edited texts and likeness."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from shoal.llm import syncmers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def of_text(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), seed=42))


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed=seed)
    return signed(seed)


def plain(text):
    words = []
    for w in WORD.findall(text or ""):
        words += [of_text(w)] if len(w) <= syncmers.WHOLE else [of_text(w[i:i + syncmers.GRAM]) for i in range(len(w) - syncmers.GRAM + 1)]
    kept = [i for i in range(len(words) - 2) if min(words[i], words[i + 2]) <= words[i + 1]]
    if kept:
        hashes = [chained(words[i:i + 3]) for i in kept]
    elif words:
        total = 0
        for w in words:
            total = chained([total, w])
        hashes = [total]
    else:
        return "", set()
    listed = ",".join(map(str, kept)) + ";" + ",".join(map(str, hashes))
    return hashlib.sha256(listed.encode()).hexdigest(), set(hashes)


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_equal_plain_python(make_docs):
    rng = random.Random(21)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += [None, "", " \t\n", "one", "one two", "one two three", "x" * 16, "x" * 17, "日本語の長い文章は空白を含まないことがあります" * 4,
              "\U0001F600" * 30, "a\U0001F600é" * 9, " ".join(["same"] * 50), "".join(rng.choice("ab") for _ in range(900)), "ab\x0bcd\x0cef  gh"]
    rng.shuffle(texts)
    ids = rng.sample(range(10**6), len(texts))
    found = {r.doc_id: r for r in syncmers.fingerprints(make_docs([(i, t, "en", "a") for i, t in zip(ids, texts, strict=True)])).collect()}
    order = sorted(zip(ids, texts, strict=True))
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        row, own, other = found[doc_id], plain(text), plain(edited)
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (own[0], other[0])
        assert row.near_edited == alike(own[1], other[1]) and row.near_next == alike(own[1], plain(following)[1])


def test_kept_runs_are_the_anchors(make_docs):
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(40)}" for _ in range(200))
    words = [of_text(w) for w in text.split()]
    got = {(r.position, r.hash) for r in syncmers.anchors(make_docs([(1, text, "en", "a")])).collect()}
    assert got == {(i, chained(words[i:i + 3])) for i in range(198) if min(words[i], words[i + 2]) <= words[i + 1]}


def test_rows_without_an_id_are_dealt_by_their_text(spark, make_docs):
    """Half of the rows lack an id: they come first, by the hash of their text, in several ranges of rows."""
    rng = random.Random(6)
    rows = [(None if i % 2 else i, " ".join(f"w{rng.randrange(90)}" for _ in range(rng.randrange(3, 30))), "en", "a") for i in range(240)]
    docs = make_docs(rows)
    parts = syncmers._in_order(docs.withColumn("_tie", F.xxhash64("text"))).groupBy("_part").agg(
        F.count_if(F.col("doc_id").isNull()).alias("nameless"), F.count("*").alias("n")).collect()
    assert sum(r.nameless > 0 for r in parts) >= 2 and all(r.nameless in (0, r.n) for r in parts)
    order = sorted((r for r in rows if r[0] is None), key=lambda r: of_text(r[1])) + sorted((r for r in rows if r[0] is not None))
    want = []
    for k, (doc_id, text, *_) in enumerate(order):
        following, half = order[(k + 1) % len(order)][1], len(text) // 2
        want.append((doc_id, hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest()))
    got = [(r.doc_id, r.edited_sha256) for r in syncmers.fingerprints(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
