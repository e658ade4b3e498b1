"""Ids of whole texts by a public tokenizer, with the ids of repeated words kept.

The vocabularies used here cut a text into words before any merge, and never merge
across a single blank or line feed between two characters that aren't white space.
So a text is cut there, each distinct stretch (with the blank before it) is encoded
once, and the text's ids are put together from its stretches. The ids equal those
of the whole text, which tests check. Stretches are told apart by 64-bit hashes. The
table of known stretches belongs to the Python worker and is bounded; a stretch
beyond the bound is encoded anew with each batch.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np

from .words import span_hashes

#: Stretches remembered by one worker.
KEPT_STRETCHES = 1_000_000
#: Stretches encoded together.
JOINED = 2_000

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 10]] = True
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
# First, last but one and last bytes of the white space beyond ASCII in UTF-8; a few other characters share them.
_WIDE_FIRST, _WIDE_MIDDLE, _WIDE_LAST = (np.zeros(256, dtype=bool) for _ in range(3))
_WIDE_FIRST[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WIDE_MIDDLE[[0xC2, 0x9A, 0x80, 0x81]] = True
_WIDE_LAST[[0x85, 0x9F, *range(0x80, 0x8B), 0xA0, 0xA8, 0xA9, 0xAF]] = True
_ENCODERS: dict[str, Encoder] = {}


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of blanks and line feeds between two characters that surely aren't white space."""
    at = np.flatnonzero(_BLANK[data])
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    unsure = _WHITE[before] | _WHITE[after] | _WIDE_FIRST[after]
    unsure |= _WIDE_LAST[before] & _WIDE_MIDDLE[data[np.maximum(at - 2, 0)]]
    return at[~unsure]


def _byte_widths(path: str, tokenizer) -> np.ndarray | None:
    """Bytes of text behind each id, for vocabularies over bytes without a normalizer; else None.

    Byte-level vocabularies write one character for each byte, so a token's name is as long as its text.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
        return None
    names = tokenizer.get_vocab(with_added_tokens=True)
    width = np.zeros(max(names.values()) + 1, dtype=np.int64)
    width[list(names.values())] = [len(name) for name in names]
    for i, token in tokenizer.get_added_tokens_decoder().items():
        width[i] = len(token.content.encode())
    return width


class _Places(NamedTuple):
    """Sorted keys of stretches with the begin and the number of their ids."""

    keys: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def none(cls) -> _Places:
        return cls(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))

    def merged(self, other: _Places) -> _Places:
        at = np.searchsorted(self.keys, other.keys)
        return _Places(*(np.insert(a, at, b) for a, b in zip(self, other, strict=True)))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, self.starts[at], self.sizes[at]


class Encoder:
    """One vocabulary file in one worker; ``special_as_text`` reads the strings of special tokens as ordinary text."""

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.width = _byte_widths(path, self.tokenizer)
        # Stretches known for long and the newer ones, each as sorted keys with places in the ids; merged when the newer have grown.
        self.old = self.new = _Places.none()
        self.flat = np.zeros(1 << 16, dtype="<u4")
        self.used = 0

    def _append(self, ids: np.ndarray) -> int:
        """Put ids behind the known ones; returns the place of the first."""
        at = self.used
        if at + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[:at], np.zeros(at + 2 * len(ids), dtype="<u4")])
        self.flat[at:at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _add(self, keys: np.ndarray, stretches: list[bytes], inner: np.ndarray) -> None:
        """Learn stretches, whose keys ascend.

        ``inner`` ones begin at a cut and end before one, so that many of them joined are cut the same way; where ids tell
        their bytes, they are encoded together and parted by the bytes.
        """
        starts, sizes = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        together = np.flatnonzero(inner) if self.width is not None else np.zeros(0, dtype=np.int64)
        apart = np.flatnonzero(~inner) if self.width is not None else np.arange(len(keys))
        for at in range(0, len(together), JOINED):
            part = together[at:at + JOINED]
            own = [stretches[i] for i in part]
            ids = np.array(self.tokenizer.encode_batch_fast([b"".join(own).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
            reach, wanted = np.cumsum(self.width[ids]), np.cumsum(np.fromiter(map(len, own), dtype=np.int64, count=len(own)))
            last = np.searchsorted(reach, wanted)
            if last[-1] >= len(reach) or not np.array_equal(reach[last], wanted):
                raise ValueError("the vocabulary merges across a cut")
            sizes[part] = np.diff(last, prepend=-1)
            starts[part] = self._append(ids) + last + 1 - sizes[part]
        for at in range(0, len(apart), 100):
            part = apart[at:at + 100]
            lists = [e.ids for e in self.tokenizer.encode_batch_fast([stretches[i].decode() for i in part], add_special_tokens=False)]
            sizes[part] = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            ids = np.fromiter(chain.from_iterable(lists), dtype="<u4", count=int(sizes[part].sum()))
            starts[part] = self._append(ids) + np.cumsum(sizes[part]) - sizes[part]
        self.new = self.new.merged(_Places(keys, starts, sizes))
        if 8 * len(self.new.keys) > len(self.old.keys):
            self.old, self.new = self.old.merged(self.new), _Places.none()

    @staticmethod
    def _inner(begin: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether a stretch is neither the first nor the last one of its text."""
        edge = np.zeros(len(begin) + 1, dtype=bool)
        edge[np.searchsorted(begin, bounds)] = True
        return ~(edge[:-1] | edge[1:])

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is known, and the begin and number of its ids."""
        known, starts, sizes = self.old.find(keys)
        if len(self.new.keys) and not known.all():
            rest = np.flatnonzero(~known)
            known[rest], starts[rest], sizes[rest] = self.new.find(keys[rest])
        return known, starts, sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        raw = [t.encode() for t in texts]
        joined = b"".join(raw)
        if not joined:
            return [np.zeros(0, dtype="<u4")] * len(texts)
        data = np.frombuffer(joined, dtype=np.uint8)
        bounds = np.cumsum([0, *map(len, raw)])
        begin = np.sort(np.concatenate([cuts(data), bounds[:-1][np.diff(bounds) > 0]]))
        begin = begin[np.append(True, begin[1:] != begin[:-1])]
        end = np.append(begin[1:], len(data))
        keys, first, inverse = np.unique(span_hashes(data, begin, end), return_index=True, return_inverse=True)
        known, starts, sizes = self._find(keys)
        if not known.all():
            before = self.old, self.new, self.used
            fresh = np.flatnonzero(~known)
            places = first[fresh]
            inner = self._inner(begin, bounds)[places]
            self._add(keys[fresh], [joined[begin[i]:end[i]] for i in places], inner)
            _, starts, sizes = self._find(keys)
            if len(self.old.keys) + len(self.new.keys) > KEPT_STRETCHES:
                self.old, self.new, self.used = before
        starts, sizes = starts[inverse], sizes[inverse]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
        limits = np.concatenate([[0], ends])[np.searchsorted(begin, bounds)]
        return [ids[a:b] for a, b in zip(limits[:-1], limits[1:], strict=True)]


def encoder(path: str) -> Encoder:
    """The worker's encoder whose ids are those of the tokenizer's plain call; special tokens hold no blank to cut at."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, special_as_text=False)
    return _ENCODERS[path]


def batches_of(values: list, size=len, limit: int = 1_000_000) -> Iterator[slice]:
    """Slices of the list whose sizes add up to about ``limit``; a larger element stands alone."""
    at, total = 0, 0
    for i, value in enumerate(values):
        n = size(value) if value is not None else 0
        if i > at and total + n > limit:
            yield slice(at, i)
            at, total = i, 0
        total += n
    if at < len(values):
        yield slice(at, len(values))
