"""Token counts of whole texts by finite-state transducers compiled from a byte-level BPE vocabulary.

Counting needs no ids, so the tokenizer is compiled into two deterministic machines.

* The *cutter* reads classes of characters and finds the words inside which merges happen. It has twelve states;
  a text is cut into chunks of equal length, every chunk is run from all states at once, which gives its state
  map, and the maps are composed by a parallel prefix scan. That gives the state in which each chunk begins.
* The *counter* reads the bytes of a word. The last token of the encoding of each prefix fixes the encoding: a
  token that is a suffix of the prefix is the last one if and only if no merge crosses the border between it and
  the last token before it. A state holds the longest suffix that may still grow into a token (a node of the
  vocabulary's trie) and, for each place where a token may have begun, the last token up to there and how many
  tokens fewer there are. Each transition is annotated with the tokens it emits: how the number of tokens changes by
  the byte (it may fall, as a byte may let earlier tokens merge). States and transitions are made when a text first
  needs them and belong to the worker; all words are run in step, one byte each at a time.

A long word is run in chunks as well, each from the state that the bytes before it lead to; where the scan finds
that a chunk is entered in another state, it's walked again from that one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import batches_of

#: Characters of a chunk of the cutter, bytes of a chunk of a long word and bytes read before it.
CHUNK = 256
WORD_CHUNK = 512
WARM = 48
#: Characters of a slice of texts, and transitions kept by a worker before it starts anew with the next slice.
SLICE = 1_000_000
KEPT = 600_000
_SLOTS = 1 << 16
_NEVER = 1 << 60
_UNKNOWN = 255

# Classes of characters: end of text, blank, other white space, apostrophe, other sign, digit, letter, and the letters of contractions.
_END, _BLANK, _WHITE, _APOSTROPHE, _SIGN, _DIGIT, _LETTER, _ENDING, _R, _V, _L, _E = range(12)
_CONTRACTIONS = {"s": _ENDING, "t": _ENDING, "m": _ENDING, "d": _ENDING, "r": _R, "v": _V, "l": _L, "e": _E}
# States: a word begins; in letters, digits, signs; a word that is one apostrophe, with r, v, l behind it; one white character
# (blank, other), several (the last one a blank, another).
_START, _IN_L, _IN_N, _IN_P, _QUOTE, _QUOTE_R, _QUOTE_V, _QUOTE_L, _ONE_B, _ONE_W, _MORE_B, _MORE_W = range(12)


def _step(state: int, kind: int) -> tuple[int, int]:
    """Next state and borders: 1, a word begins at this character; 2, one began at the character before."""
    white, letter = kind in (_BLANK, _WHITE), kind >= _LETTER
    group = _IN_L if letter else _IN_N if kind == _DIGIT else _IN_P
    fresh = {_END: _START, _BLANK: _ONE_B, _WHITE: _ONE_W, _APOSTROPHE: _QUOTE}.get(kind, group)
    if state in (_QUOTE_R, _QUOTE_V, _QUOTE_L):
        if kind == (_L if state == _QUOTE_L else _E):
            return _START, 0
        return (_IN_L, 2) if letter else (fresh, 3)
    if kind == _END or state == _START:
        return fresh, 1
    if state in (_IN_L, _IN_N, _IN_P):
        return (state, 0) if group == state and not white else (fresh, 1)
    if state == _QUOTE:
        if kind == _ENDING:
            return _START, 0
        after = {_R: _QUOTE_R, _V: _QUOTE_V, _L: _QUOTE_L}.get(kind)
        return (after, 0) if after else (_IN_P, 0) if kind in (_APOSTROPHE, _SIGN) else (fresh, 1)
    if white:
        return (_MORE_B if kind == _BLANK else _MORE_W), 0
    return (group if state in (_ONE_B, _MORE_B) else fresh), {_ONE_B: 0, _ONE_W: 1, _MORE_B: 2, _MORE_W: 3}[state]


_NEXT = np.array([[_step(s, k)[0] for k in range(12)] for s in range(12)], dtype=np.int64)
_BORDER = np.array([[_step(s, k)[1] for k in range(12)] for s in range(12)], dtype=np.uint8)


def borders(kinds: np.ndarray) -> np.ndarray:
    """Places at which words begin in a row of character classes, which starts and ends like a text."""
    n = len(kinds)
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, _END, dtype=np.int64)
    grid[:n] = kinds
    grid = grid.reshape(rows, CHUNK).T.copy()
    jump = (_NEXT * 12).ravel()  # states stand multiplied, so that a class is added to find the next one
    maps = np.tile(np.arange(12, dtype=np.int64) * 12, (rows, 1))
    for column in grid:
        maps = jump[maps + column[:, None]]
    maps //= 12
    reach = 1
    while reach < rows:  # maps[i] becomes the map of chunks i - 2 * reach + 1 to i
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2
    state = np.concatenate([[_START], maps[:-1, _START]]) * 12
    found = np.zeros((CHUNK, rows), dtype=np.uint8)
    out = _BORDER.ravel()
    for k, column in enumerate(grid):
        found[k] = out[state + column]
        state = jump[state + column]
    marks = found.T.ravel()[:n]
    begins = (marks & 1).astype(bool)
    begins[:-1] |= marks[1:] > 1
    return np.flatnonzero(begins)


def _byte_of() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte: itself if printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Counter:
    """Both machines of one vocabulary file in one worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cutter = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True)
                or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError("needs a plain byte-level BPE vocabulary")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or "\n" in t["content"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must match as they stand")
        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        byte_of = _byte_of()
        self.names = {bytes(byte_of[c] for c in word): i for word, i in model["vocab"].items() if all(c in byte_of for c in word)}
        self._merges(model, byte_of)
        self._trie()
        self.kinds = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
        self.kinds[[ord(" "), ord("'")]] = _BLANK, _APOSTROPHE
        for letter, kind in _CONTRACTIONS.items():
            self.kinds[ord(letter)] = kind
        self._forget()

    def _merges(self, model: dict, byte_of: dict[str, int]) -> None:
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, both = model["vocab"][left], model["vocab"][right], model["vocab"][left + right]
            self.rank.setdefault((a, b), rank)
            made.setdefault(both, (rank, a, b))
        self.made = made
        self.first, self.last = {}, {}  # token: its edges from the byte up, each with the merge that ends it
        self.fits: dict[tuple[int, int], bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        edge, end = [], _NEVER
        while True:
            edge.append((token, end))
            if token not in self.made:
                return edge[::-1]
            end, token = self.made[token][0], self.made[token][side]

    def _border_holds(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is these two: no merge crosses the border while the tokens form."""
        known = self.fits.get((left, right))
        if known is not None:
            return known
        if left not in self.last:
            self.last[left] = self._edge(left, 2)
        if right not in self.first:
            self.first[right] = self._edge(right, 1)
        a, b, i, j, holds = self.last[left], self.first[right], 0, 0, True
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.rank.get((x, y), _NEVER)
            if rank < x_ends and rank <= y_ends:  # of equal merges the left one comes first
                holds = rank == _NEVER
                break
            if x_ends == y_ends == _NEVER:
                break
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
        self.fits[left, right] = holds
        return holds

    def _trie(self) -> None:
        """Nodes are prefixes of tokens; ``fall`` leads to the longest proper suffix that is a node."""
        self.child: dict[int, int] = {}
        self.depth, self.token = [0], [-1]
        for name in sorted(self.names, key=len):
            node = 0
            for byte in name:
                after = self.child.get(node << 8 | byte)
                if after is None:
                    after = self.child[node << 8 | byte] = len(self.depth)
                    self.depth.append(self.depth[node] + 1)
                    self.token.append(-1)
                node = after
            self.token[node] = self.names[name]
        self.fall = [0] * len(self.depth)
        for key, node in sorted(self.child.items(), key=lambda kv: self.depth[kv[1]]):
            if key >> 8:
                self.fall[node] = self._node(self.fall[key >> 8], key & 255)

    def _node(self, node: int, byte: int) -> int:
        while True:
            after = self.child.get(node << 8 | byte)
            if after is not None:
                return after
            if not node:
                return 0
            node = self.fall[node]

    def _forget(self) -> None:
        self.states: list[tuple] = [(0, -1, ())]
        self.number = {self.states[0]: 0}
        self.where = np.full(_SLOTS, -1, dtype=np.int64)  # open addressing: state and byte, then what follows
        self.what = np.zeros(_SLOTS, dtype=np.int64)
        self.made_n = 0

    def _follow(self, state: int, byte: int) -> int:
        """Next state and tokens emitted, as ``state * 256 + tokens + 128``."""
        node, last, behind = self.states[state]
        before = {0: (last, 0)} | {d: (t, n) for d, t, n in behind}
        after = self._node(node, byte)
        chain, at, found = [], after, None
        while at:
            entry = before[self.depth[at] - 1]
            chain.append((self.depth[at], *entry))
            token = self.token[at]
            if found is None and token >= 0 and (entry[0] < 0 or self._border_holds(entry[0], token)):
                found = token, entry[1] + 1
            at = self.fall[at]
        if found is None:
            raise ValueError("the vocabulary lacks a byte")
        token, emitted = found
        new = (after, token, tuple((d, t, n - emitted) for d, t, n in chain))
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
        return number << 8 | emitted + 128

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return spread >> np.uint64(32)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct new keys to the table, which stays at most half full."""
        self.made_n += len(keys)
        if 2 * self.made_n > len(self.where):
            old = self.where >= 0
            keys, values = np.concatenate([self.where[old], keys]), np.concatenate([self.what[old], values])
            size = 1 << int(4 * self.made_n).bit_length()
            self.where, self.what = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int64)
        mask = np.int64(len(self.where) - 1)
        slots = self._slot(keys).astype(np.int64) & mask
        while len(keys):
            free = self.where[slots] < 0
            self.where[slots[free]] = keys[free]  # of keys that meet in a slot one stays
            done = self.where[slots] == keys
            self.what[slots[done]] = values[done]
            keys, values, slots = keys[~done], values[~done], (slots[~done] + 1) & mask

    def _look(self, keys: np.ndarray) -> np.ndarray:
        """What follows each ``state * 256 + byte``; transitions not met before are made."""
        while True:
            mask = np.int64(len(self.where) - 1)
            slots = self._slot(keys).astype(np.int64) & mask
            held = self.where[slots]
            found = self.what[slots]
            open_ = np.flatnonzero(held != keys)
            missing = []
            while len(open_):
                empty = held[open_] < 0
                missing.append(open_[empty])
                open_ = open_[~empty]
                slots[open_] = (slots[open_] + 1) & mask
                held[open_] = self.where[slots[open_]]
                found[open_] = self.what[slots[open_]]
                open_ = open_[held[open_] != keys[open_]]
            missing = np.concatenate(missing) if missing else open_
            if not len(missing):
                return found
            new = np.unique(keys[missing])
            self._put(new, np.array([self._follow(int(k) >> 8, int(k) & 255) for k in new.tolist()], dtype=np.int64))

    def run(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last states and emitted tokens of spans of ``data`` that start in the states given, all in step."""
        size = end - begin
        order = np.argsort(-size, kind="stable")
        at, state, size = begin[order], state[order], -size[order]
        total = np.zeros(len(at), dtype=np.int64)
        for step in range(int(-size[0]) if len(size) else 0):
            n = int(np.searchsorted(size, -step, side="left"))
            found = self._look(state[:n] << 8 | data[at[:n] + step])
            total[:n] += (found & 255) - 128
            state[:n] = found >> 8
        last, emitted = np.empty_like(state), np.empty_like(total)
        last[order], emitted[order] = state, total
        return last, emitted

    def count_words(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each word, given by its first byte and the byte behind it."""
        counts = np.zeros(len(begin), dtype=np.int64)
        long = end - begin > 2 * WORD_CHUNK
        short = np.flatnonzero(~long)
        counts[short] = self.run(data, begin[short], end[short], np.zeros(len(short), dtype=np.int64))[1]
        for i in np.flatnonzero(long):
            counts[i] = self._long(data, int(begin[i]), int(end[i]))
        return counts

    def _long(self, data: np.ndarray, begin: int, end: int) -> int:
        starts = np.arange(begin, end, WORD_CHUNK)
        ends = np.append(starts[1:], end)
        entered = self.run(data, np.maximum(starts - WARM, begin), starts, np.zeros(len(starts), dtype=np.int64))[0]
        left, emitted = self.run(data, starts, ends, entered.copy())
        state, total = 0, 0
        for k in range(len(starts)):
            if entered[k] != state:  # the chunk's map has no entry for this state yet
                last, own = self._walk(data[starts[k]:ends[k]].tolist(), state)
            else:
                last, own = int(left[k]), int(emitted[k])
            state, total = last, total + own
        return total

    def _walk(self, span: list[int], state: int) -> tuple[int, int]:
        total, known = 0, {}
        for byte in span:
            key = state << 8 | byte
            found = known.get(key)
            if found is None:
                found = known[key] = self._follow(state, byte)
            total += (found & 255) - 128
            state = found >> 8
        return state, total

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        """Classes of characters; those not met before are asked of the library's own cutter."""
        kinds = self.kinds[points]
        if (kinds == _UNKNOWN).any():
            new = np.unique(points[kinds == _UNKNOWN]).tolist()
            groups = {}
            for sign, kind in (("a", _LETTER), ("1", _DIGIT), ("!", _SIGN)):
                probe = sign + sign.join(map(chr, new)) + sign
                inside = np.zeros(len(probe) + 1, dtype=bool)
                for _, (a, b) in self.cutter.pre_tokenize_str(probe):
                    inside[a + 1:b] = True
                # Both borders of the character are inside one word of the probe's kind.
                groups[kind] = inside[1:-1:2] & inside[2::2]
            for i, point in enumerate(new):
                self.kinds[point] = next((k for k, own in groups.items() if own[i]), _WHITE)
            kinds = self.kinds[points]
        return kinds

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text; strings of added tokens are one token each, as in the library's plain call."""
        if self.made_n > KEPT:
            self._forget()
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        kinds = self._kinds(points)
        stops = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1) - 1
        kinds[stops] = _END
        marks = np.array([m.span() for m in self.special.finditer(joined)] if self.special else [], dtype=np.int64).reshape(-1, 2)
        for a, b in marks:
            kinds[a:b] = _END
        at = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])
        begin = borders(kinds)
        end = np.append(begin[1:], len(points))
        own = kinds[begin] != _END
        begin, end = begin[own], end[own]
        counts = self.count_words(np.frombuffer(joined.encode(), dtype=np.uint8), at[begin], at[end])
        sums = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(begin, stops)]
        sums += np.searchsorted(marks[:, 0], stops)
        ends = at[stops]
        return np.diff(ends, prepend=-1) - 1, np.diff(sums, prepend=0)


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each whole text and, with ``limit``, ``over_limit``.

    The number of tokens is that of the tokenizer's plain call without added tokens at the ends. Null texts are empty
    and have no token. Rows without an id and repeated rows are counted one by one. An empty table gives no rows;
    other columns aren't read, whatever their names.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = counter(vocabulary)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            ids = batch["doc_id"].astype("Int64")
            for part in batches_of(texts, limit=SLICE):
                sizes, counts = own.count(texts[part])
                yield pd.DataFrame({"doc_id": ids.iloc[part].array, "n_bytes": sizes, "n_tokens": counts})

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = picked.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long")
    return found if limit is None else found.withColumn("over_limit", F.col("n_tokens") > limit)
