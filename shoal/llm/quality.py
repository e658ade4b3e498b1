"""Quality of a text by votes of its nearest labelled neighbours.

A text becomes a vector of hashed terms: its words, the shapes of its words (runs of
capitals, small letters, digits; other characters as they are), how many of its
three-word runs and how many words at once it repeats, and how long its words are. Terms weigh by how few of all
texts have them. The vectors of a bounded sample of labelled texts give a latent-semantic map (truncated SVD of
weighted terms). The mapped sample is broadcast, every text is compared with all of it by
blocked matrix products, and the labels of its nearest neighbours vote, each by its
similarity and by the number of labelled texts it stands for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import batches_of
from .words import as_bytes, joined, mix, span_hashes, window_hashes, word_spans

#: Bound of the labelled sample (per label), places of words and of shapes, latent dimensions, neighbours.
PER_LABEL = 2_000
WORD_PLACES = 1 << 10
SHAPE_PLACES = 1 << 11
STEPS = 16
DIMENSIONS = 64
NEIGHBOURS = 25
#: A text is good from this score on.
THRESHOLD = 0.3

PLACES = WORD_PLACES + SHAPE_PLACES + 2 * STEPS + 2
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[128:] = 2
_CLASS[48:58] = 3
_CLASS[[32, *range(9, 14)]] = 32


def term_counts(texts: list[bytes]) -> np.ndarray:
    """Rows of weighted terms, one per text: the square root of each term's share of the text's words."""
    out = np.zeros((len(texts), PLACES), dtype=np.float32)
    data, starts = joined(texts)
    begin, end = word_spans(data)
    where = np.searchsorted(begin, starts)
    hashes = span_hashes(data, begin, end)
    classes = _CLASS[data]
    keep = np.append(True, classes[1:] != classes[:-1])
    keep[begin] = True
    shape_ends = np.cumsum(keep)
    shapes = span_hashes(classes[keep], shape_ends[begin] - 1, shape_ends[end - 1])
    owner = np.repeat(np.arange(len(texts)), np.diff(where))
    flat = out.ravel()
    n = np.maximum(np.diff(where), 1)
    for places, first, values in ((WORD_PLACES, 0, hashes), (SHAPE_PLACES, WORD_PLACES, shapes)):
        at = owner * PLACES + first + (mix(values) % np.uint64(places)).astype(np.int64)
        flat += np.bincount(at, minlength=len(flat)).astype(np.float32)
    out /= n[:, None]
    np.sqrt(out, out=out)
    for i, (a, b) in enumerate(zip(where[:-1], where[1:], strict=True)):
        if b > a:
            runs = window_hashes(hashes[a:b], 3)
            again = 1 - len(np.unique(runs)) / len(runs) if len(runs) else 0.0
            out[i, PLACES - 2 * STEPS + min(int(again * STEPS), STEPS - 1)] = 0.5
            out[i, PLACES - STEPS + min(int(np.mean(end[a:b] - begin[a:b])), STEPS - 1)] = 0.5
            doubled = np.mean(hashes[a + 1:b] == hashes[a:b - 1]) if b > a + 1 else 0.0
            out[i, WORD_PLACES + SHAPE_PLACES] = 2 * np.sqrt(doubled)
            out[i, WORD_PLACES + SHAPE_PLACES + 1] = again
    return out


def sparse(row: np.ndarray) -> tuple[bytes, bytes]:
    """The places of a row's terms and their weights."""
    at = np.flatnonzero(row).astype("<u2")
    return at.tobytes(), row[at].tobytes()


def dense(places: Iterable[bytes], terms: Iterable[bytes]) -> np.ndarray:
    """Rows of terms from those of ``sparse``."""
    places = list(places)
    out = np.zeros((len(places), PLACES), dtype=np.float32)
    for row, at, weights in zip(out, places, terms, strict=True):
        row[np.frombuffer(at, dtype="<u2")] = np.frombuffer(weights, dtype=np.float32)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """``doc_id, text, label, stands`` of at most ``PER_LABEL`` texts per label, those with the smallest hash of their id.

    ``stands`` is how many labelled ids each one stands for: all of its label over those drawn. Rows without an id or a label aren't learnt from; an id with several labels counts with the smallest.
    """
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy("doc_id")
              .agg(F.min("label").alias("label")).filter(learn))
    order = [F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")]
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}  # one row per label
    # Every task gives up its first PER_LABEL rows of a label; no label is sorted as a whole.
    rows = [r for label in sorted(counts)
            for r in marked.filter(F.col("label") == label).orderBy(*order).limit(PER_LABEL).select("doc_id", "label").collect()]
    picked = docs.sparkSession.createDataFrame(
        [(r["doc_id"], r["label"], counts[r["label"]] / min(counts[r["label"]], PER_LABEL)) for r in rows],
        "doc_id long, label int, stands double")
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


class Voters:
    """The map and the mapped sample: (places × dimensions) and (sample × dimensions) numbers.

    The sample's terms are weighed in place, as they are the largest thing the driver holds.
    """

    def __init__(self, terms: np.ndarray, labels: np.ndarray, stands: np.ndarray, idf: np.ndarray):
        rng = np.random.default_rng(7)
        self.idf = idf.astype(np.float32)
        x = self._weighed(terms, out=terms)
        draw = rng.standard_normal((x.shape[1], DIMENSIONS + 16)).astype(np.float32)
        basis = x @ draw
        for _ in range(3):
            basis, _ = np.linalg.qr(basis)
            basis, _ = np.linalg.qr(x.T @ basis)
            basis = x @ basis
        basis, _ = np.linalg.qr(basis)
        _, _, rows = np.linalg.svd(basis.T @ x, full_matrices=False)
        self.map = np.ascontiguousarray(rows[:DIMENSIONS].T)
        self.vectors = self._mapped(x)
        self.labels = labels.astype(np.float32)
        self.stands = stands

    def _weighed(self, terms: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        x = np.multiply(terms, self.idf, out=out)
        x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-12)[:, None]
        return x

    def _mapped(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.map
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, terms: np.ndarray) -> np.ndarray:
        """Share of good labels among the nearest neighbours; ties at the edge all vote.

        A vote counts by similarity and by how many labelled texts its text stands for, so that a thinned label
        keeps its share.
        """
        similar = self._mapped(self._weighed(terms)) @ self.vectors.T
        k = min(NEIGHBOURS, similar.shape[1])
        edge = np.partition(similar, similar.shape[1] - k, axis=1)[:, -k][:, None]
        weight = np.where(similar >= edge, np.maximum(similar, 1e-6) ** 4, 0) * self.stands
        return np.clip((weight @ self.labels) / weight.sum(axis=1), 0, 1)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Weight of each term by the number of all texts that have it; a task sends one row per term."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(PLACES, dtype=np.int64), 0
        for batch in batches:
            texts = [as_bytes(t) for t in batch["text"]]
            n += len(texts)
            for part in batches_of(texts, limit=500_000):
                total += (term_counts(texts[part]) > 0).sum(axis=0)
        yield pd.DataFrame({"place": np.arange(PLACES + 1), "n": np.append(total, n)})

    rows = docs.select("text").mapInPandas(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(PLACES + 1)
    for r in rows:
        counts[r["place"]] = r["n"]
    return np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1


def score_of(docs: DataFrame, labels: DataFrame, learn: Column) -> Callable[[Column], Column]:
    """A function from a text column to its score; fitted on ``docs`` and ``labels`` (doc_id, label) where ``learn`` holds.

    The score is from 0 to 1, higher for texts like those labelled 1. Null texts count as empty, and an empty text
    is as near to every labelled text as to any other: it gets the share of good labels. Without any
    label the score is 1, as nothing speaks against a text.
    """
    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [as_bytes(t) for t in batch["text"]]
            for part in batches_of(texts):
                rows = [sparse(r) for r in term_counts(texts[part])]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[part].array, "label": batch["label"].iloc[part].array,
                                    "stands": batch["stands"].iloc[part].array,
                                    "places": [at for at, _ in rows], "terms": [r for _, r in rows]})

    drawn = labelled_sample(docs, labels, learn).select(F.col("doc_id").cast("long"), "text", "label", "stands").mapInPandas(
        vectors, "doc_id long, label int, stands double, places binary, terms binary").toPandas().sort_values(["doc_id", "places", "terms"])
    voters = None
    if len(drawn):
        voters = Voters(dense(drawn["places"], drawn["terms"]), drawn["label"].to_numpy(), drawn["stands"].to_numpy(),
                        inverse_frequencies(docs))
    shared = docs.sparkSession.sparkContext.broadcast(voters)  # bounded by the sample and the dimensions

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        texts = [as_bytes(t) for t in text]
        found = np.ones(len(texts))
        for part in batches_of(texts, limit=500_000):
            if shared.value is not None:
                found[part] = shared.value.score(term_counts(texts[part]))
        return pd.Series(found)

    return score


def scored(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """``doc_id, score`` of every row of (doc_id, text); an empty table gives no rows.

    Texts are read whole, whatever their length. Repeated rows are scored one by one; those of a labelled id each
    stand in the sample. Rows without an id are scored like any other and never learnt from.
    """
    score = score_of(docs, labels, learn)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text")).alias("score"))


def accepted(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns, whatever these are called; other cases as of ``scored``."""
    score = score_of(docs, labels, learn)
    return docs.filter(score(F.col("text")) >= threshold)
