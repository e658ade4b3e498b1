"""Language of a text by a string kernel.

The kernel of two texts is the number of byte n-grams (n from 1 to 4) present in
both, over the geometric mean of what each holds: a blended spectrum of presences.
n-grams are hashed to a fixed number of places. Landmark texts give a Nyström map;
one ridge regression per language is fitted on the mapped sample. The map and the
regressions are linear in the presences, so they are folded into one matrix, and a
batch of texts is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Places of hashed n-grams, longest n-gram, sample per language and in all, landmarks, ridge.
PLACES = 1 << 15
LONGEST = 4
PER_LANGUAGE = 300
SAMPLE = 3_000
LANDMARKS = 256
RIDGE = 1e-2
#: Texts scored by one matrix product.
ROWS = 128

_MIX = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def has_letter(text: str) -> bool:
    """Whether a character of the classes L* occurs; numbers such as Roman or circled ones are none."""
    return any(c.isalpha() for c in text)


def presence(text: str, row: np.ndarray) -> None:
    """Mark the places of all n-grams of the whole text, in lower case, in a row of zeros."""
    data = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    shift = np.uint32(32 - int(PLACES).bit_length() + 1)
    for at in range(0, len(data), 1 << 18):  # stretches overlap by the longest n-gram, so none is lost
        part = data[at:at + (1 << 18) + LONGEST - 1].astype(np.uint32)
        gram = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, LONGEST + 1):
            if len(part) < n:
                break
            gram = (gram[:len(part) - n + 1] << np.uint32(8)) | part[n - 1:]
            row[((gram + np.uint32(n)) * _MIX[n - 1]) >> shift] = 1


def sample(docs: DataFrame, learn: Column) -> DataFrame:
    """At most ``PER_LANGUAGE`` texts of each language, those with the smallest hash of their id, ``SAMPLE`` in all.

    Ids are ranked first, so that no text is moved to rank it.
    """
    known = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    order = [F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")]
    ranked = known.select("doc_id", "lang").withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ids = ranked.filter(F.col("nth") <= PER_LANGUAGE).orderBy("nth", "lang", "doc_id").limit(SAMPLE).collect()
    picked = docs.sparkSession.createDataFrame([(r["doc_id"],) for r in ids], "doc_id long")
    return known.join(F.broadcast(picked), "doc_id", "left_semi")  # at most SAMPLE ids


def fit(rows: list[tuple[str, np.ndarray]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the folded matrix (places × languages) and the offset of each language."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return [], np.zeros((PLACES, 0), dtype=np.float32), np.zeros(0, dtype=np.float32)
    seen: dict[str, int] = {}
    nth = []  # landmarks take turns among the languages
    for lang, _ in rows:
        seen[lang] = nth_own = seen.get(lang, 0) + 1
        nth.append((nth_own, lang))
    marks = [i for _, i in sorted((key, i) for i, key in enumerate(nth))][:LANDMARKS]
    x = np.stack([v for _, v in rows]).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    landmarks = x[marks]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    to_map = vectors[:, good] / np.sqrt(values[good])
    mapped = (x @ landmarks.T).astype(np.float64) @ to_map
    y = np.array([[lang == own for own in languages] for lang, _ in rows], dtype=np.float64)
    counts = y.sum(axis=0)
    weight = (y @ (1 / counts))[:, None]  # every language weighs the same
    centre = (mapped * weight).sum(axis=0) / weight.sum()
    level = (y * weight).sum(axis=0) / weight.sum()
    m = mapped - centre
    solved = np.linalg.solve(m.T @ (m * weight) + RIDGE * np.eye(m.shape[1]) * weight.sum() / len(rows),
                             m.T @ ((y - level) * weight))
    return languages, (landmarks.T @ (to_map @ solved)).astype(np.float32), (level - centre @ solved).astype(np.float32)


def identify(docs: DataFrame, learn: Column) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; learns from the rows where ``learn`` holds.

    ``und`` and 0 for null texts, texts without a letter, and where there is nothing to learn from. Of equal scores
    the language first in the alphabet wins. The score is the winner's regression, cut to 0 to 1. Texts are read whole,
    whatever their length; repeated rows are scored one by one, and each counts in the sample if its id is drawn.
    """
    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                row = np.zeros(PLACES, dtype=np.uint8)
                presence(text, row)
                out.append(np.packbits(row).tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": batch["lang"], "bits": out})

    drawn = sample(docs, learn).select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text").mapInPandas(
        vectors, "doc_id long, lang string, bits binary").orderBy("doc_id", "lang", "bits").collect()
    languages, matrix, offset = fit([(r["lang"], np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8))) for r in drawn])
    shared = docs.sparkSession.sparkContext.broadcast((languages, matrix, offset))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, weights, level = shared.value
        block = np.zeros((ROWS, PLACES), dtype=np.float32)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            told, scores = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if names and has_letter(t)]
            for at in range(0, len(known), ROWS):
                part = known[at:at + ROWS]
                block[:] = 0
                for k, i in enumerate(part):
                    presence(texts[i], block[k])
                own = block[:len(part)]
                found = (own @ weights) / np.sqrt(np.maximum(own.sum(axis=1, keepdims=True), 1)) + level
                told[part] = [names[k] for k in found.argmax(axis=1)]
                scores[part] = np.clip(found.max(axis=1), 0, 1)
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "lang_pred": told, "score": scores})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(score, "doc_id long, lang_pred string, score double")
