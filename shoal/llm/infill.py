"""Fill-in-middle examples: prefix, middle and suffix of each text, put in another order behind marks.

A batch of texts is one row of bytes. Cuts are given in characters; a scan over the bytes that begin a character
turns them into places. A segment moves as a whole, so all its bytes have the same displacement: a difference array
holds, where a segment begins, by how much its displacement differs from the one before, its running sum is the
output place of every byte, and one scatter writes all outputs. Restoring finds the marks, builds the same
displacements, and gathers the bytes back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import batches_of

#: Marks before prefix, suffix and middle.
MARKS = (b"<P>", b"<S>", b"<M>")
#: Percentage of texts that stay plain, and of the others the percentage with the suffix first.
PLAIN_PER_CENT = 10
SPM_PER_CENT = 20
_MARK = len(MARKS[0])
_PLAIN, _PSM, _SPM = "plain", "psm", "spm"
#: Order of (prefix, middle, suffix) in the output; the marks of the parts are 0, 2 and 1.
_ORDERS = {_PSM: (0, 2, 1), _SPM: (2, 0, 1)}
_MARK_OF = {0: 0, 1: 2, 2: 1}


def char_starts(data: np.ndarray) -> np.ndarray:
    """Places of the bytes at which a character of UTF-8 begins."""
    return np.flatnonzero((data & 0xC0) != 0x80)


def _displaced(bounds: np.ndarray, targets: np.ndarray, size: int) -> np.ndarray:
    """Where each of ``size`` bytes goes: segments begin at ``bounds`` (ascending) and move to ``targets``."""
    change = np.zeros(size + 1, dtype=np.int64)
    shift = targets - bounds
    np.add.at(change, bounds, np.diff(shift, prepend=0))  # empty segments share their place with the next one
    return np.arange(size) + np.cumsum(change[:size])


def _layout(sizes: np.ndarray, forms: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the three parts in the output, and of the three marks (-1 where the text stays plain)."""
    parts, marks = np.zeros((len(forms), 3), dtype=np.int64), np.full((len(forms), 3), -1, dtype=np.int64)
    plain = forms == _PLAIN
    parts[plain] = starts[plain, None] + np.concatenate([np.zeros((plain.sum(), 1), dtype=np.int64), np.cumsum(sizes[plain, :2], axis=1)], axis=1)
    for form, order in _ORDERS.items():
        rows = forms == form
        at = starts[rows]
        for part in order:
            marks[rows, _MARK_OF[part]] = at
            at = at + _MARK
            parts[rows, part] = at
            at = at + sizes[rows, part]
    return parts, marks


def arrange(texts: list[bytes], forms: np.ndarray, prefix: np.ndarray, middle: np.ndarray) -> list[bytes]:
    """Outputs of texts cut after ``prefix`` and after ``prefix + middle`` characters (read for forms other than plain)."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))])
    chars = np.append(char_starts(data), len(data))
    first = np.searchsorted(chars, edges[:-1])
    begin, end = edges[:-1], edges[1:]
    moved = forms != _PLAIN
    one = np.where(moved, chars[first + np.where(moved, prefix, 0)], begin)
    two = np.where(moved, chars[first + np.where(moved, prefix + middle, 0)], begin)
    bounds = np.stack([begin, one, two], axis=1)
    sizes = np.diff(np.concatenate([bounds, end[:, None]], axis=1), axis=1)
    lengths = end - begin + np.where(moved, 3 * _MARK, 0)
    out_edges = np.concatenate([[0], np.cumsum(lengths)])
    parts, marks = _layout(sizes, forms, out_edges[:-1])
    out = np.zeros(int(out_edges[-1]), dtype=np.uint8)
    out[_displaced(bounds.ravel(), parts.ravel(), len(data))] = data
    for k, mark in enumerate(MARKS):
        out[marks[moved, k][:, None] + np.arange(_MARK)] = np.frombuffer(mark, dtype=np.uint8)
    return [out[a:b].tobytes() for a, b in zip(out_edges[:-1], out_edges[1:], strict=True)]


def rebuild(outputs: list[bytes], forms: np.ndarray) -> list[bytes]:
    """The texts behind the outputs, from output and form alone.

    A moved text holds no mark, so each mark's first place behind the mark before it's looked for is the mark itself.
    """
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, outputs), dtype=np.int64, count=len(outputs)))])
    sizes = np.zeros((len(outputs), 3), dtype=np.int64)
    for i, (data, form) in enumerate(zip(outputs, forms, strict=True)):
        if form == _PLAIN:
            sizes[i, 0] = len(data)
            continue
        order = _ORDERS[form]
        second = data.index(MARKS[_MARK_OF[order[1]]], _MARK)
        third = data.index(MARKS[_MARK_OF[order[2]]], second + _MARK)
        for part, a, b in zip(order, (_MARK, second + _MARK, third + _MARK), (second, third, len(data)), strict=True):
            sizes[i, part] = b - a
    data = np.frombuffer(b"".join(outputs), dtype=np.uint8)
    text_edges = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
    bounds = text_edges[:-1, None] + np.concatenate([np.zeros((len(outputs), 1), dtype=np.int64), np.cumsum(sizes[:, :2], axis=1)], axis=1)
    parts, _ = _layout(sizes, forms, edges[:-1])
    back = data[_displaced(bounds.ravel(), parts.ravel(), int(text_edges[-1]))]
    return [back[a:b].tobytes() for a, b in zip(text_edges[:-1], text_edges[1:], strict=True)]


def _draw(doc_id: Column, seed: int, group: int) -> Column:
    """A group of 8 hex digits of the SHA-256 of ``seed:doc_id`` as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"), 256)
    return F.conv(F.substring(digest, 1 + 8 * group, 8), 16, 10).cast("long")


def infill(docs: DataFrame, seed: int = 1, plain_per_cent: int = PLAIN_PER_CENT, spm_per_cent: int = SPM_PER_CENT,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n, form, prefix_chars, middle_chars, output`` of each whole text.

    The cuts and the form come from the SHA-256 of seed and id, so that reruns agree; rows that share an id share the
    draws, rows without one draw as ``null``. Null texts are empty. Texts that are empty or hold a mark stay plain, as do
    ``plain_per_cent`` of the others, and their cuts are null. An empty table gives no rows; other columns aren't
    read, whatever their names.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    draws = [_draw(F.col("doc_id"), seed, k) for k in range(4)]
    n = F.char_length("text").cast("long")
    held = F.col("text").rlike("|".join(re.escape(m.decode()) for m in MARKS))
    plain = (n == 0) | held | (draws[2] % 100 >= 100 - plain_per_cent)
    cut = picked.select(
        "doc_id", "text", n.alias("n"),
        F.when(plain, _PLAIN).when(draws[3] % 100 < spm_per_cent, _SPM).otherwise(_PSM).alias("form"),
        (draws[0] % (n + 1)).alias("_a"), (draws[1] % (n + 1)).alias("_b"))
    moved = F.col("form") != _PLAIN
    cut = cut.select("doc_id", "text", "n", "form", F.when(moved, F.least("_a", "_b")).alias("prefix_chars"),
                     F.when(moved, F.abs(F.col("_a") - F.col("_b"))).alias("middle_chars"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batches_of(batch["text"].tolist()):
                own = batch.iloc[part].copy()
                forms = own["form"].to_numpy(dtype=object)
                cuts = [own[c].fillna(0).to_numpy(dtype=np.int64) for c in ("prefix_chars", "middle_chars")]
                done = arrange([t.encode() for t in own["text"]], forms, *cuts)
                own["output"] = [x.decode() for x in done]
                for name in ("doc_id", "prefix_chars", "middle_chars"):
                    own[name] = own[name].astype("Int64")
                yield own

    return cut.mapInPandas(run, "doc_id long, text string, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(examples: DataFrame) -> DataFrame:
    """The examples with ``restored``, the text rebuilt from ``output`` and ``form`` (null where one of them is null)."""
    names = examples.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in batches_of(batch["output"].tolist()):
                own = batch.iloc[part][names].copy()
                known = (own["output"].notna() & own["form"].notna()).to_numpy()
                texts = np.full(len(own), None, dtype=object)
                texts[known] = [x.decode() for x in rebuild([t.encode() for t in own.loc[known, "output"]],
                                                            own.loc[known, "form"].to_numpy(dtype=object))]
                own["restored"] = texts
                for field in whole:
                    own[field] = own[field].astype("Int64")
                yield own

    whole = [f.name for f in examples.schema.fields if f.dataType.simpleString() in ("int", "bigint")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in examples.schema.fields)
    return examples.mapInPandas(run, schema + ", restored string")
