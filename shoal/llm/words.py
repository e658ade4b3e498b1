"""Words of texts and their hashes, for whole batches of texts at once.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. All hashes are
64-bit, the same in every process, and computed by array arithmetic: no Python
statement runs per word.
"""

from __future__ import annotations

import numpy as np

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be inverted
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CHUNK = 1 << 15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[name] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, each text followed by one blank, and the start of each text."""
    data = np.frombuffer(b"".join(t + b" " for t in texts), dtype=np.uint8)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return (_LOWER[data] if lower else data), starts


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in ``data``, which ends with a blank."""
    blank = _SPACE[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(data) and not blank[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial in the bytes of each span, modulo 2**64, mixed with its length.

    Runs over stretches of the data, so that the powers stay in cache; sums wrap.
    """
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    for at in range(0, len(data), _CHUNK):
        part = data[at:at + _CHUNK].astype(np.uint64) + np.uint64(1)
        part *= _powers("up", _BASE, len(part))
        np.cumsum(part, out=sums[at + 1:at + 1 + len(part)])
    # Sums restart in every stretch; a span that crosses into the next one gets the rest of its stretch added.
    rel = begin % _CHUNK
    first = begin - rel
    low = np.where(rel == 0, np.uint64(0), sums[begin])
    inside = end <= first + _CHUNK
    value = (sums[np.minimum(end, first + _CHUNK)] - low) * _powers("down", _INVERSE, _CHUNK)[rel]
    for i in np.flatnonzero(~inside):  # at most one span per stretch begins here and ends beyond
        value[i] = np.uint64(_whole(data[begin[i]:end[i]]))
    return mix(value + mix((end - begin).astype(np.uint64)))


def _whole(span: np.ndarray) -> int:
    """The same polynomial for one span of any length."""
    total, power = np.uint64(0), np.uint64(1)
    with np.errstate(over="ignore"):
        for at in range(0, len(span), _CHUNK):
            part = span[at:at + _CHUNK].astype(np.uint64) + np.uint64(1)
            total += np.sum(part * _powers("up", _BASE, len(part)), dtype=np.uint64) * power
            power *= _powers("up", _BASE, _CHUNK)[-1] * _BASE
    return int(total)


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, in order, and the index at which each text's words start."""
    data, starts = joined(texts, lower)
    begin, end = word_spans(data)
    return span_hashes(data, begin, end), np.searchsorted(begin, starts)


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` words; runs at the end that are too short have none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    factor = pow(int(_BASE) ^ (2 * seed), size, 1 << 64)
    for k in range(size):
        factor = factor * ((int(_BASE) ^ (2 * seed)) | 1) % (1 << 64)
        total += words[k:k + n] * np.uint64(factor | 1)
    return mix(total)


def as_bytes(value) -> bytes:
    """Text as UTF-8; a null text is empty."""
    return value.encode("utf-8") if isinstance(value, str) else b""
