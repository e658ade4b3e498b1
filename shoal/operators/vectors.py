"""Scores between blocks of vectors, shared by the neighbour operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

# Rows per step inside a block pair when distances need the full difference.
_STEP = 64
# More than rounding to twelve places can add.
_ROUNDED = 1e-12
# Dimensions of that difference held at once.
_DIMS = 32
# Pairs whose difference is taken at once.
_PAIRS = 1 << 15

NEAREST = "id string, item string, score double"


def best_per_row(scores: np.ndarray, ids: np.ndarray, items: np.ndarray, n: int, floor: float | None,
                 keep_self: bool) -> pd.DataFrame:
    """The n highest entries of every row; columns come sorted by item, so ties go by item."""
    many = scores.shape[1]
    scores = np.where(np.isnan(scores), -np.inf, scores)
    if not keep_self:
        # Numbers for ids: comparing strings cell by cell costs more than the products.
        codes = pd.factorize(np.concatenate([ids, items]))[0]
        scores[codes[:len(ids), None] == codes[None, len(ids):]] = -np.inf
    # Rounding keeps the order, so only what may round up to the n-th best is rounded and sorted.
    least = np.partition(scores, many - n, axis=1)[:, many - n] if 0 < n < many else np.full(len(scores), -np.inf)
    row, column = np.nonzero((scores >= least[:, None] - 2 * _ROUNDED) & (scores > -np.inf))
    value = np.round(scores[row, column], 12)
    if floor is not None:
        enough = value >= floor
        row, column, value = row[enough], column[enough], value[enough]
    order = np.lexsort((column, -value, row))
    row, column, value = row[order], column[order], value[order]
    keep = (np.arange(len(row)) - np.searchsorted(row, row) < n) & np.isfinite(value)
    return pd.DataFrame({"id": ids[row[keep]], "item": items[column[keep]], "score": value[keep]})


class Reaching:
    """The n highest entries of every row of a block, ties by item, while other blocks pass by.

    ``reach`` is each row's n-th best score so far, which scores have to reach; it rises from block to block. New entries are
    sorted in when they are many, and never more than a few times n are held for a row.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, reach: np.ndarray, n: int, floor: float | None, keep_self: bool):
        self.ids, self.matrix, self.best = ids, matrix, np.array(reach)
        self.n, self.floor, self.keep_self = n, floor, keep_self
        self.own, self.values, self.names = np.arange(0), np.array([]), np.array([], dtype=object)
        self.fresh, self.waiting = [], 0

    def see(self, asked: np.ndarray, other: np.ndarray, items: np.ndarray, scores_of: Callable[[np.ndarray, np.ndarray], np.ndarray],
            screened: Callable[..., np.ndarray] | None = None) -> None:
        """The rows ``asked`` meet a block. ``screened`` gives the scores as :func:`near_distances` does."""
        if not len(asked):
            return
        matrix = self.matrix if len(asked) == len(self.matrix) else self.matrix[asked]
        distinct, bound = self.keep_self or len(set(items)) == len(items), self.best[asked]
        wide = len(items) - self.n - (not self.keep_self)  # the own item may be among the best, once where ids are distinct
        scores = screened(matrix, other, bound, len(items) - wide if distinct and wide > 0 else None) if screened else scores_of(matrix, other)
        open_ = np.flatnonzero(np.isneginf(bound))
        if distinct and wide > 0 and len(open_):
            some = scores[open_]
            bound[open_] = np.partition(np.where(np.isnan(some), -np.inf, some), wide, axis=1)[:, wide]
        row, column = np.nonzero((scores >= bound[:, None] - 2 * _ROUNDED) & (scores > -np.inf))
        score = np.round(scores[row, column], 12)
        row = asked[row]
        kept = score >= self.best[row]
        if not self.keep_self:
            kept &= self.ids[row] != items[column]
        if self.floor is not None:
            kept &= score >= self.floor
        self.fresh.append((row[kept], score[kept], items[column[kept]]))
        self.waiting += len(self.fresh[-1][0])
        if self.waiting >= self.n * len(self.ids) // 4:
            self.sort_in()

    def sort_in(self) -> None:
        if not self.waiting:
            return
        own, values, names = (np.concatenate(x) for x in zip((self.own, self.values, self.names), *self.fresh))
        self.fresh, self.waiting = [], 0
        order = np.lexsort((-values, own))
        own, values, names = own[order], values[order], names[order]
        # All that equal the n-th stay, for names decide among them.
        start = np.searchsorted(own, np.arange(len(self.ids)))
        full = np.flatnonzero(np.searchsorted(own, np.arange(len(self.ids)), side="right") - start >= self.n)
        self.best[full] = np.maximum(self.best[full], values[start[full] + self.n - 1])
        kept = values >= self.best[own]
        self.own, self.values, self.names = own[kept], values[kept], names[kept]
        if len(self.own) > 2 * self.n * len(self.ids):
            self.cut()

    def cut(self) -> None:
        order = np.lexsort((pd.factorize(self.names, sort=True)[0], -self.values, self.own))
        own = self.own[order]
        first = order[np.arange(len(own)) - np.searchsorted(own, own) < self.n]
        self.own, self.values, self.names = self.own[first], self.values[first], self.names[first]

    def found(self) -> pd.DataFrame:
        self.sort_in()
        self.cut()
        return pd.DataFrame({"id": self.ids[self.own], "item": self.names, "score": self.values})


def reaching(ids: np.ndarray, matrix: np.ndarray, reach: np.ndarray, wanted: np.ndarray, blocks: list, scores_of: Callable[[np.ndarray, np.ndarray], np.ndarray],
             n: int, floor: float | None, keep_self: bool, screened: Callable[..., np.ndarray] | None = None) -> pd.DataFrame:
    """The n highest entries of every row over several blocks (place, matrix, items); ``wanted`` tells by place which rows have to see which blocks."""
    rows = Reaching(ids, matrix, reach, n, floor, keep_self)
    for place, other, items in blocks:
        rows.see(np.flatnonzero(wanted[:, place]), other, items, scores_of, screened)
    return rows.found()


def similarities(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Higher is nearer: cosine, or the negated Euclidean distance."""
    if metric == "euclidean":
        out = np.empty((len(a), len(b)))
        for start in range(0, len(a), _STEP):
            squares = np.zeros((len(a[start:start + _STEP]), len(b)))
            for d in range(0, a.shape[1], _DIMS):
                squares += ((a[start:start + _STEP, None, d:d + _DIMS] - b[None, :, d:d + _DIMS]) ** 2).sum(axis=2)
            out[start:start + _STEP] = -np.sqrt(squares)
        return out
    lengths = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
    return np.divide(a @ b.T, lengths, out=np.zeros((len(a), len(b))), where=lengths > 0)


def near_distances(a: np.ndarray, b: np.ndarray, least: np.ndarray, most: int | None) -> np.ndarray:
    """Negated Euclidean distances as :func:`similarities` gives them, -inf for those that can't count.

    These are entries below a row's ``least`` and, where a row's ``least`` is -inf and ``most`` is given, those not among its
    ``most`` highest. A matrix product with a bound on its error tells them; only the others' differences are taken.
    """
    out = np.full((len(a), len(b)), -np.inf)
    with np.errstate(over="ignore", invalid="ignore"):
        x, y = (a ** 2).sum(axis=1), (b ** 2).sum(axis=1)
        squares = x[:, None] + y[None] - 2 * (a @ b.T)
        error = 16 * (a.shape[1] + 8) * np.finfo(float).eps * (x + y.max(initial=0))
        # What rounds to the same twelve places counts as well.
        reach = (2 * _ROUNDED - least) ** 2
        free = np.isneginf(least)
        if most is not None and free.any():
            highest = np.partition(squares[free], most - 1, axis=1)[:, most - 1] + 2 * error[free]
            reach[free] = (2 * _ROUNDED + np.sqrt(np.maximum(highest, 0))) ** 2
        # Unknown ones, as where squares overflow, are not left out.
        row, column = np.nonzero(~(squares > (reach + error)[:, None]))
    for start in range(0, len(row), _PAIRS):
        i, j = row[start:start + _PAIRS], column[start:start + _PAIRS]
        exact = np.zeros(len(i))
        for d in range(0, a.shape[1], _DIMS):
            exact += ((a[i, d:d + _DIMS] - b[j, d:d + _DIMS]) ** 2).sum(axis=1)
        out[i, j] = -np.sqrt(exact)
    return out
