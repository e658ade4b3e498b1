"""Every stage of the pipeline against a plain Python version of it, each on that stage's own input."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shoal.llm import quality
from shoal.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before the first stage and after each one."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows_of(frame):
    return [tuple(r) for r in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_names_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "mix", "pack"]
    assert all(s.dtypes == steps[0].dtypes for s in steps[:-1])
    assert all(stage.__doc__ for _, stage in corpus_pipeline.STAGES)


def test_quality_keeps_what_the_votes_accept(spark, steps):
    labels = {r.doc_id: int(r.quality) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r.quality is not None}
    rows = rows_of(steps[0])
    terms = np.stack([quality.term_counts([(t or "").encode()])[0].astype(np.float64) for _, t, *_ in rows])
    idf = np.log((1 + len(rows)) / (1 + (terms > 0).sum(axis=0))) + 1
    learnt = [k for k, r in enumerate(rows) if r[0] in labels and zlib.crc32(str(r[0]).encode()) % 5 != 0]
    learnt.sort(key=lambda k: rows[k][0])
    assert max(collections.Counter(labels[rows[k][0]] for k in learnt).values()) < quality.PER_LABEL
    marks = np.array([labels[rows[k][0]] for k in learnt])
    model = quality.Voters(terms[learnt].astype(np.float32), marks, np.ones(len(learnt)), idf)
    unit = terms * idf
    unit /= np.maximum(np.linalg.norm(unit, axis=1), 1e-12)[:, None]
    mapped = unit @ model.map
    mapped /= np.maximum(np.linalg.norm(mapped, axis=1), 1e-12)[:, None]
    kept, unsure = collections.Counter(), set()
    for k, row in enumerate(rows):
        similar = mapped[learnt] @ mapped[k]
        edge = np.sort(similar)[-quality.NEIGHBOURS]
        votes = np.where(similar >= edge - 1e-6, np.maximum(similar, 1e-6) ** 4, 0)
        score = votes @ marks / votes.sum()
        if abs(score - quality.THRESHOLD) < 1e-3:
            unsure.add(row)
        elif score >= quality.THRESHOLD:
            kept[row] += 1
    got = collections.Counter(rows_of(steps[1]))
    assert {r: n for r, n in got.items() if r not in unsure} == dict(kept) and len(unsure) < 3
    assert 0 < len(got) < len(rows)


def test_one_of_each_group_of_near_duplicates_stays(steps):
    rows = rows_of(steps[1])
    words = [WORD.findall((t or "").translate(LOWER)) for _, t, *_ in rows]
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []) for w in words]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for k, x in enumerate(label):
        least[x] = min(least.get(x, rows[k][0]), rows[k][0])
    want = [r for k, r in enumerate(rows) if r[0] == least[label[k]]]
    assert sorted(rows_of(steps[2]), key=str) == sorted(want, key=str) and len(want) < len(rows)


def test_passages_of_earlier_documents_go(steps):
    rows = rows_of(steps[2])
    first = {}
    for doc_id, text, *_ in rows:
        own = WORD.findall(text or "")
        for i in range(len(own) - 12):
            key = tuple(own[i:i + 13])
            first[key] = min(first.get(key, doc_id), doc_id)
    want, changed = {}, 0
    for doc_id, text, *_ in rows:
        own = WORD.findall(text or "")
        gone = {j for i in range(len(own) - 12) if first[tuple(own[i:i + 13])] < doc_id for j in range(i, i + 13)}
        want[doc_id] = [w for i, w in enumerate(own) if i not in gone]
        changed += bool(gone)
    got = rows_of(steps[3])
    assert {r[0]: WORD.findall(r[1] or "") for r in got} == want and len(got) == len(rows) and changed
    before = {r[0]: r for r in rows}
    for r in got:
        assert (r == before[r[0]]) if want[r[0]] == WORD.findall(before[r[0]][1] or "") else (r[4] == len(r[1]) and r[2:4] == before[r[0]][2:4])


def test_sources_come_to_their_targets(steps):
    rows = rows_of(steps[3])
    sources = sorted({r[3] for r in rows if r[3] is not None}) + ([None] if any(r[3] is None for r in rows) else [])
    words = {r[0]: WORD.findall(r[1] or "") for r in rows}
    size = {s: sum(len(words[r[0]]) for r in rows if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    free, goal = set(sources), {}
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in sources if s not in free)
        goal = {s: left * weight[s] / sum(weight[x] for x in free) if s in free else 2 * size[s] for s in sources}
        over = {s for s in free if goal[s] > 2 * size[s]}
        if not over:
            break
        free -= over
    used, count = collections.Counter(), collections.defaultdict(list)
    for r in rows_of(steps[4]):
        used[r[3]] += len(WORD.findall(r[1] or ""))
        count[r[0]].append(r)
    assert all(abs(used[s] - goal[s]) <= 1 for s in sources)

    def key(doc_id, text):
        draw = (int(hashlib.md5(f"42:{doc_id}".encode()).hexdigest()[:13], 16) + 1) / (2**52 + 1)
        share = sum(c.isalpha() or c in " \t\n\v\f\r" for c in text) / len(text) if text else 1.0
        return -math.log(draw) / (0.1 + 0.9 * share if text else 1.0)

    for s in sources:  # whole epochs for all, then those with the smallest keys once more, the last one cut
        whole = int(goal[s] // size[s]) if size[s] else 0
        left = round(goal[s] - whole * size[s])
        for r in sorted((r for r in rows if r[3] == s), key=lambda r: (key(r[0], r[1]), r[0])):
            n = len(words[r[0]])
            extra = max(0, min(n, left))
            left -= extra
            texts = collections.Counter(x[1] for x in count[r[0]])
            want = collections.Counter({r[1]: whole + (extra == n > 0)}) if n else collections.Counter({r[1]: 1})
            if 0 < extra < n:
                want[" ".join(words[r[0]][:extra])] += 1
            assert texts == +want


def test_packed_pieces_are_the_documents_ids(steps):
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for doc_id, text, *_ in rows_of(steps[4]):
        ids = tool.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = np.array(ids[at:at + 4096], dtype="<u4")
            want[doc_id, piece, at, len(own), zlib.crc32(own.tobytes())] += 1
    rows = steps[5].collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    spans = collections.defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.offset + r.length))
    for own in spans.values():
        own.sort()
        assert own[0][0] == 0 and own[-1][1] <= 4096 and all(a[1] == b[0] for a, b in zip(own, own[1:]))
    assert len(spans) <= math.ceil(sum(r.length for r in rows) / 4096) + 1


def test_run_is_the_stages_in_order(spark, steps):
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, steps[-1].collect()))


def test_stages_take_odd_rows_and_no_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[1:]:
            path = scratch_path(spark, f"odd-{name}")
            stage(spark, docs, FOLDER).write.parquet(path)
            docs = spark.read.parquet(path)
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= {r.doc_id for r in odd_docs.select("doc_id").collect()}
