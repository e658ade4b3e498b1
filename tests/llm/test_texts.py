"""Token files, packing, repeats, Jaccard groups, fingerprints and mixing against plain Python."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoal.llm import groups, huffman, jaccard, mixing, packing, repeats, syncmers, token_files, tokens, words
from shoal.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [" a", "a ", "  a  b", "a\n \nb c\t d", "\n\n x", "x \n y", "", "I's we'll  \x1c z", "a\xa0 b", "é é́ ́b c", "<|endoftext|> k", "  \n",
       "a   b", "a\n b", "a \nb", "x\ny\n\nz", "à é", "a  b　 ", "\x85 a  b  c", "日本 語\n日", "x" * 5000]


def ids_of(name, texts):
    tool = Tokenizer.from_file(public_tokenizers.path(name))
    tool.encode_special_tokens = True
    return [e.ids for e in tool.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_stretches_encode_as_whole_texts(name):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab \n\té's1") for _ in range(rng.randrange(80))) for _ in range(400)]
    tool = tokens.Encoder(public_tokenizers.path(name))
    got = [x.tolist() for part in tokens.batches_of(texts, limit=500) for x in tool.encode(texts[part])]
    assert got == ids_of(name, texts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_plain_call(spark, make_docs, name):
    rng = random.Random(14)
    path = public_tokenizers.path(name)
    tool = Tokenizer.from_file(path)
    special = [t.content for t in tool.get_added_tokens_decoder().values()]
    assert special and not any(c.isspace() for t in special for c in t)
    pool = special + special + [" ", " ", "\n", "  ", "a", "b's", "é", ".", "<|", "|>", "\xa0"]
    texts = ODD + ["a <|endoftext|> b"] + ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(500)]
    want = [e.ids for e in tool.encode_batch(texts, add_special_tokens=False)]
    own = tokens.encoder(path)
    got = [x.tolist() for part in tokens.batches_of(texts, limit=500) for x in own.encode(texts[part])]
    assert got == want and got != ids_of(name, texts)
    rows = token_files.token_files(make_docs([(i, t, "en", "a") for i, t in enumerate(texts)]), path, end_id=2).collect()
    assert {r.doc_id: r.ids_crc32 for r in rows} == {i: zlib.crc32(np.array(ids + [2], "<u4").tobytes()) for i, ids in enumerate(want)}
    packed = packing.pack(packing.pieces(make_docs([(i, t, "en", "a") for i, t in enumerate(texts)]), path, 1, 4096), 4096).collect()
    assert {r.doc_id: r.length for r in packed} == {i: len(ids) + 1 for i, ids in enumerate(want)}


def test_word_hashes_tell_words_apart(monkeypatch):
    monkeypatch.setattr(words, "_CHUNK", 64)
    monkeypatch.setattr(words, "_POWERS", {})
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab \n\té") for _ in range(rng.randrange(300))).encode() for _ in range(100)] + [b"", b"x" * 500]
    hashes, starts = words.word_hashes(texts)
    seen = {}
    for i, text in enumerate(texts):
        own = text.split()
        assert len(own) == starts[i + 1] - starts[i]
        assert all(seen.setdefault(w, h) == h for w, h in zip(own, hashes[starts[i]:starts[i + 1]], strict=True))
    assert len(set(seen.values())) == len(seen)


def test_huffman_is_prefix_free_limited_and_reversible():
    rng = np.random.default_rng(3)
    ids = (rng.pareto(0.3, 30_000) * 3).astype(np.int64) % 3000
    counts = np.bincount(ids)
    for limit in (12, 16):
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and abs(sum(2.0 ** -lengths[lengths > 0].astype(float)) - 1) < 1e-9
        coder = huffman.Coder(lengths)
        data, first = coder.encode(ids, 256)
        sizes = np.full(len(first), 256)
        sizes[-1] = len(ids) - 256 * (len(first) - 1)
        assert (coder.decode(data, first, sizes) == ids).all()
        assert (coder.decode(data, first[7:9], sizes[7:9]) == ids[7 * 256:9 * 256]).all()  # any block alone
    assert huffman.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0]
    assert huffman.code_lengths(np.array([1, 1, 2, 4])).tolist() == [3, 3, 2, 1]


def test_token_files_round_trip(spark, odd_docs, odd_rows, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = scratch_path(spark, "files")
    manifest = token_files.write_token_files(token_files.token_rows(odd_docs, path, 2), folder, block=16, shard_ids=500)
    got = token_files.read_token_files(spark, folder, manifest, with_ids=True).orderBy("start").collect()
    assert manifest.count() > 3
    want = collections.Counter()
    for (doc_id, *_), ids in zip(odd_rows, ids_of("byte_bpe_50k.json", [t or "" for _, t, *_ in odd_rows]), strict=True):
        want[doc_id, np.array(ids + [2], "<u4").tobytes()] += 1
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        start += r.n_tokens
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and [r.doc_id for r in got[:2]] == [None, None]
    assert token_files.token_files(no_docs, path).count() == 0


def test_packing_fills_sequences_without_gaps(odd_docs, odd_rows, no_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(packing.pieces(odd_docs, path, 1, 64, with_ids=True), 64)
    rows = packed.collect()
    want = collections.Counter()
    for (doc_id, *_), ids in zip(odd_rows, ids_of("word_bpe_49k.json", [t or "" for _, t, *_ in odd_rows]), strict=True):
        ids = np.array(ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 64)):
            want[doc_id, piece, at, ids[at:at + 64].tobytes()] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= -(-sum(r.length for r in rows) // 64) + 1
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert all(whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids) for r in rows)
    assert packing.pack(packing.pieces(no_docs, path), 4096).count() == 0


def test_fullest_equals_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 7))}
        room = rng.randrange(0, 60)
        used = packing.fullest(np.array(sorted(counts, reverse=True)), counts, room)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
        assert sum(k * n for k, n in used.items()) == max(sums) and all(n <= counts[k] for k, n in used.items())


def kept_words(rows, size=13):
    first = {}
    for doc_id, text, *_ in rows:
        own = WORD.findall(text or "")
        for i in range(len(own) - size + 1 if doc_id is not None else 0):
            key = tuple(own[i:i + size])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        own = WORD.findall(text or "")
        gone = set()
        for i in range(len(own) - size + 1 if doc_id is not None else 0):
            if first[tuple(own[i:i + size])] < doc_id:
                gone.update(range(i, i + size))
        out.append((doc_id, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return out


def test_repeats_go_from_later_documents(odd_docs, odd_rows, no_docs):
    got = repeats.remove_repeats(odd_docs, 13).collect()
    want = collections.Counter(kept_words(odd_rows))
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert sum(r.n_removed for r in got) > 300
    for r in got:
        spans = list(zip(r.removed[::2], r.removed[1::2], strict=True))
        assert sum(b - a for a, b in spans) == r.n_removed and all(b - a >= 13 for a, b in spans)
    assert repeats.remove_repeats(no_docs, 13).count() == 0
    small = repeats.without_repeats(odd_docs)
    assert small.dtypes == odd_docs.dtypes and small.count() == len(odd_rows)
    assert small.filter("doc_id = 100").first().text == next(t for i, t, *_ in odd_rows if i == 100)
    assert small.filter("doc_id = 101").first().text == "" and small.filter("doc_id = 120").first().text is None
    with pytest.raises(ValueError):
        repeats.remove_repeats(odd_docs, 12)


def test_crowded_block_is_answered_to_every_group(spark, make_docs):
    rng = random.Random(6)
    line = " ".join(f"c{i}" for i in range(20))
    rows = [(i, " ".join(f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(12))) + " " + line, "en", "a") for i in range(300)]
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in repeats.remove_repeats(make_docs(rows)).collect()}
    assert got == {i: (n, text) for i, _, n, text in kept_words(rows)}


def shingles(text, k):
    own = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(own[i:i + k]) for i in range(len(own) - k + 1)) if len(own) >= k else frozenset([tuple(own)] if own else [])


def brute_groups(rows, per_cent, k):
    sets = [shingles(t, k) for _, t, *_ in rows]
    label = list(range(len(rows)))
    linked = [i for i, (d, *_) in enumerate(rows) if d is not None and sets[i]]
    for a in linked:
        for b in linked:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= per_cent * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                old, new = label[b], label[a]
                label = [new if x == old else x for x in label]
    least = {}
    for i in linked:
        least[label[i]] = min(least.get(label[i], rows[i][0]), rows[i][0])
    return collections.Counter((rows[i][0], len(sets[i]), least[label[i]] if i in linked else rows[i][0]) for i in range(len(rows)))


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        own = base.split()
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_similar_groups_equal_brute_force(make_docs, odd_docs, odd_rows, no_docs):
    got = jaccard.similar_groups(odd_docs, 80, 5).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(odd_rows, 80, 5)
    rng = random.Random(7)
    bases = [" ".join(f"v{rng.randrange(5000)}" for _ in range(n)) for n in (8, 30, 80, 200)]
    texts = [t for base in bases for t in variants(rng, base, 40, 8)]
    rows = [(i, t, "en", "a") for i, t in enumerate(rng.sample(texts, len(texts)))]
    got = jaccard.similar_groups(make_docs(rows), 85, 4).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, 85, 4)
    assert jaccard.similar_groups(no_docs).count() == 0
    one = jaccard.one_of_each(odd_docs)
    kept = {r.doc_id for r in one.collect()}
    assert one.dtypes == odd_docs.dtypes and 100 in kept and not kept & {101, 102, 103} and {120, 121, None} <= kept


def test_candidate_links_hold_all_links_together():
    rng = random.Random(8)
    base = " ".join(f"v{i}" for i in range(150))
    sets = jaccard.shingle_sets(variants(rng, base, 300, 9))
    nodes = np.arange(len(sets))
    marks = np.ones((len(sets), 4), dtype="<u8")
    order = np.argsort([len(s) for s in sets], kind="stable")
    bits = np.stack([jaccard.bitmap(sets[i]) for i in order])

    def labels(links):
        label = list(range(len(sets)))
        for a, b in links:
            old, new = label[a], label[b]
            label = [new if x == old else x for x in label]
        return label

    exact = labels(jaccard.exact_links(nodes, sets))
    brute = labels([(i, j) for i in range(len(sets)) for j in range(i)
                    if 100 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - n)])
    partition = lambda x: {frozenset(i for i, y in enumerate(x) if y == z) for z in set(x)}
    assert partition(exact) == partition(brute)
    maybe = labels([(int(order[a]), int(order[b])) for a, b in jaccard.close_pairs(np.array([len(sets[i]) for i in order]), bits, marks[order])])
    assert all(len({maybe[i] for i in own}) == 1 for own in partition(exact))


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(9)
    for _ in range(100):
        pool = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64))
        a, b = (np.sort(rng.choice(pool, rng.integers(1, 400), replace=False)) for _ in range(2))
        x, y = jaccard.bitmap(a), jaccard.bitmap(b)
        while len(x) > len(y):
            x = jaccard._folded(x)
        while len(y) > len(x):
            y = jaccard._folded(y)
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_fingerprints_follow_the_texts(spark, odd_docs, odd_rows, no_docs):
    rows = syncmers.fingerprints(odd_docs).collect()
    known = sorted((i, t or "") for i, t, *_ in odd_rows if i is not None)
    edited = collections.defaultdict(set)
    ids = [i for i, _ in known]
    for k, (i, text) in enumerate(known):
        if ids.count(i) == 1 and k + 1 < len(known) and ids.count(ids[k + 1]) == 1:
            n = len(text)
            edited[i].add(hashlib.sha256((text[:n - n // 2] + known[k + 1][1][:n // 2]).encode()).hexdigest())
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r.doc_id in edited:
            assert r.edited_sha256 in edited[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[100].fingerprint == by[101].fingerprint and by[100].near_next == 1.0 and by[101].near_next > 0.6
    assert by[121].fingerprint == "" and by[120].n_chars == 0 and 0.2 < by[100].near_edited <= 1
    assert syncmers.fingerprints(no_docs).count() == 0


def test_syncmers_look_at_nothing_outside_the_run(make_docs):
    rng = random.Random(10)
    inner = " ".join(f"k{rng.randrange(1000)}" for _ in range(60))
    rows = [(1, "a b c d " + inner, "en", "a"), (2, "x " + inner + " y z", "en", "a")]
    found = collections.defaultdict(set)
    for r in syncmers.anchors(make_docs(rows)).collect():
        found[r.doc_id].add((r.position - (4 if r.doc_id == 1 else 1), r.hash))
    inside = [{(p, h) for p, h in found[d] if 0 <= p <= 57} for d in (1, 2)]
    assert inside[0] == inside[1] and len(inside[0]) > 25


def test_anchors_of_a_text_without_blanks_survive_an_insertion(make_docs):
    rng = random.Random(12)
    for alphabet in ([chr(0x4E00 + i) for i in range(3000)], [chr(0x20000 + i) for i in range(500)] + list("abc"), list("abcdefgh")):
        text = "".join(rng.choice(alphabet) for _ in range(2000))
        edited = text[:7] + rng.choice(alphabet) + text[7:]
        found = collections.defaultdict(list)
        for r in syncmers.anchors(make_docs([(1, text, "zh", "a"), (2, edited, "zh", "a")])).collect():
            found[r.doc_id].append((r.position, r.hash))
        assert len(found[1]) > 1000 and max(p for p, _ in found[1]) < 2000
        assert {(p + 1, h) for p, h in found[1] if p >= 8} == {(p, h) for p, h in found[2] if p >= 9}
        row = syncmers.fingerprints(make_docs([(1, text, "zh", "a"), (2, edited, "zh", "a")])).filter("doc_id = 1").first()
        assert row.near_next > 0.97


def test_likeness_sees_a_short_passage_in_long_texts(make_docs):
    rng = random.Random(13)
    passage = [f"p{rng.randrange(10**9)}" for _ in range(50)]
    rows = []
    for i in range(12):
        own = [f"u{rng.randrange(10**9)}" for _ in range(2000)]
        at = rng.randrange(2000)
        rows.append((i, " ".join(own[:at] + passage + own[at:]), "en", "a"))
    found = {r.doc_id: r for r in syncmers.fingerprints(make_docs(rows)).collect()}
    runs = collections.defaultdict(set)
    for r in syncmers.anchors(make_docs(rows)).collect():
        runs[r.doc_id].add(r.hash)
    for i, r in found.items():
        other = runs[(i + 1) % 12]
        assert r.near_next == len(runs[i] & other) / len(runs[i] | other) > 0
    moved = [(1, rows[0][1], "en", "a"), (2, "before " + rows[0][1], "en", "a")]  # the same runs at other places
    assert len({r.fingerprint for r in syncmers.fingerprints(make_docs(moved)).collect()}) == 2


def test_mix_meets_targets(odd_docs, odd_rows, no_docs):
    rows = mixing.shares(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    per = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        per[r.source][0] += r["size"]
        per[r.source][1] = r.target
        per[r.source][2] += r.taken
    names = sorted(x for x in per if x is not None) + [None]
    size, weight = [per[x][0] for x in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))]
    total, target, free = 1.5 * sum(size), [0.0] * len(names), set(range(len(names)))
    while True:
        left = total - sum(2 * size[i] for i in range(len(names)) if i not in free)
        target = [left * weight[i] / sum(weight[j] for j in free) if i in free else 2.0 * size[i] for i in range(len(names))]
        over = {i for i in free if target[i] > 2 * size[i]}
        if not over:
            break
        free -= over
    for name, want in zip(names, target, strict=True):
        assert abs(per[name][1] - want) < 1e-6 * total and abs(per[name][2] - want) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.shares(odd_docs).collect()))  # reruns agree
    mixed = mixing.mix(odd_docs)
    assert mixed.dtypes == odd_docs.dtypes
    n = sum(len(WORD.findall(r.text or "")) for r in mixed.collect())
    assert n == sum(r.taken for r in rows)
    assert mixing.shares(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_groups_helpers():
    values = np.array([5, -1, 2**40, 0])
    assert (groups.unplanes(groups.planes(values)) == values).all()
    assert groups.runs(np.array([1, 1, 2, 3, 3])).tolist() == [0, 2, 3] and groups.runs(np.array([])).tolist() == []
    assert groups.run_ids(np.array([0, 2, 3]), 5).tolist() == [0, 0, 1, 2, 2]


def joined_by(links, n):
    label = list(range(n))
    for a, b in links:
        old, new = label[b], label[a]
        label = [new if x == old else x for x in label]
    return {frozenset(i for i in range(n) if label[i] == x) for x in set(label)}


@pytest.mark.parametrize("listed,representatives", [(64, 16), (2, 1), (2, 16), (2, 0), (10**6, 16)])
def test_exact_links_hold_the_same_parts_together(monkeypatch, listed, representatives):
    monkeypatch.setattr(jaccard, "LISTED_SETS", listed)
    monkeypatch.setattr(jaccard, "REPRESENTATIVES", representatives)
    rng = np.random.default_rng(12)
    for edits, bases in ((2, 1), (10, 3), (25, 2), (60, 5)):
        centres = [rng.choice(10**6, 60, replace=False) for _ in range(bases)]
        sets = []
        for i in range(90):
            own = centres[i % bases].copy()
            own[rng.integers(0, 60, rng.integers(0, edits + 1))] = rng.integers(10**6, 10**7)
            sets.append(np.unique(own[: rng.integers(45, 61)]))
        nodes = rng.permutation(90)
        want = joined_by([(a, b) for a in range(90) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))], 90)
        found = jaccard.exact_links(nodes, sets, 80)
        back = {int(x): i for i, x in enumerate(nodes)}
        assert joined_by([(back[a], back[b]) for a, b in found], 90) == want
        assert all(100 * len(np.intersect1d(sets[back[a]], sets[back[b]])) >= 80 * len(np.union1d(sets[back[a]], sets[back[b]])) for a, b in found)


def test_near_copies_cost_their_size_and_not_its_square():
    import time

    rng = np.random.default_rng(3)
    base, spent = rng.choice(10**6, 200, replace=False), []
    for many in (1000, 4000):
        sets = []
        for _ in range(many):
            own = base.copy()
            own[rng.integers(0, 200, 3)] = rng.integers(10**6, 10**9, 3)
            sets.append(np.unique(own))
        start = time.perf_counter()
        assert len(jaccard.exact_links(np.arange(many), sets, 85)) == many - 1
        spent.append(time.perf_counter() - start)
    assert spent[1] < 10 * spent[0]


def test_pack_keeps_other_columns_and_orders_copies(spark):
    rng = random.Random(5)
    rows = [(None if i % 3 == 0 else i % 40, 0, i % 2 * 7, rng.randrange(1, 60), i % 5, f"x{i}", i, 1.5, -1, 3, "old", "a.b") for i in range(600)]
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, _slice string, _rank int, _in double, _before int, sequence_id int,"
              " offset string, `dotted.name` string")
    frame = spark.createDataFrame(rows, schema)
    first = packing.pack(frame, 64)
    assert first.columns == [c for c in frame.columns if c not in ("sequence_id", "offset")] + ["sequence_id", "offset"]
    got = first.collect()
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r["_slice"], r["_rank"], r["dotted.name"]) for r in got) == collections.Counter(
        (r[0], r[2], r[3], r[4], r[5], r[6], r[11]) for r in rows)
    ends = collections.defaultdict(list)
    for r in got:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 64 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    place = lambda rs: collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset) for r in rs)
    assert place(packing.pack(frame.repartition(7), 64).collect()) == place(got)
