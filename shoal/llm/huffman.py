"""Canonical length-limited Huffman codes over ids, as array arithmetic.

A coded sequence is cut into blocks of a fixed number of ids. The bit at which
each block begins is kept, so blocks are decoded on their own, all at once: step
k looks up id k of every block in one table.
"""

from __future__ import annotations

import numpy as np

MAX_BITS = 16


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Code length per symbol, 0 for symbols that never occur, by package-merge.

    The lengths minimise the coded size among codes of at most ``max_bits`` bits;
    the limit rises to what the number of symbols needs.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, kinds = leaves, [np.ones(n, dtype=bool)]
    for _ in range(max_bits - 1):
        packages = level[0:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        kinds.append(rank < n)
    take, depth = 2 * n - 2, np.zeros(n, dtype=np.int64)
    for is_leaf in reversed(kinds):
        own = int(is_leaf[:take].sum())
        depth[:own] += 1
        take = 2 * (take - own)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol), each the one before plus one, shifted to its length."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    code = 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        own = np.flatnonzero(lengths == bits)
        codes[own] = code + np.arange(len(own), dtype=np.uint32)
        code = (code + len(own)) << 1
    return codes


class Coder:
    """Tables of one code; built once per task."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.bits = max(1, int(lengths.max(initial=1)))
        self.codes = canonical_codes(lengths).astype(np.uint64)

    def encode(self, ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Coded bytes and the first bit of each block."""
        data, _, first, _ = self.encode_all(ids, np.array([len(ids)]), block)
        return data, first

    def encode_all(self, ids: np.ndarray, sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Many sequences at once, one after the other in ``ids``; each begins on a byte.

        Returns the coded bytes, the byte at which each sequence begins (and the end), the first bit of each block
        counted from its sequence's begin, and the number of blocks of each sequence. Codes are put into 64-bit words.
        """
        sizes = np.asarray(sizes, dtype=np.int64)
        blocks = -(-sizes // block)
        if not len(ids):
            return np.zeros(0, dtype=np.uint8), np.zeros(len(sizes) + 1, dtype=np.int64), np.zeros(0, dtype=np.int64), blocks
        width = self.lengths[ids].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(width)])
        edges = np.concatenate([[0], np.cumsum(sizes)])
        begin = np.concatenate([[0], np.cumsum((ends[edges[1:]] - ends[edges[:-1]] + 7) >> 3)])
        at = ends[:-1] + np.repeat(8 * begin[:-1] - ends[edges[:-1]], sizes)
        before = np.cumsum(blocks) - blocks
        nth = np.arange(int(blocks.sum())) - np.repeat(before, blocks)
        first = at[np.repeat(edges[:-1], blocks) + nth * block] - np.repeat(8 * begin[:-1], blocks)
        words = np.zeros((int(begin[-1]) >> 3) + 2, dtype=np.uint64)
        code, word = self.codes[ids], at >> 6
        over = (at & 63) + width - 64  # bits that reach into the next word
        own = np.where(over > 0, code >> np.maximum(over, 0).astype(np.uint64), code << np.maximum(-over, 0).astype(np.uint64))
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[starts]] = np.bitwise_or.reduceat(own, starts)
        split = np.flatnonzero(over > 0)  # at most one code of each word
        words[word[split] + 1] |= code[split] << (64 - over[split]).astype(np.uint64)
        return words.astype(">u8").view(np.uint8)[:int(begin[-1])], begin, first, blocks

    def decoder(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length for every possible window of ``bits`` bits."""
        symbols = np.zeros(1 << self.bits, dtype=np.uint32)
        widths = np.ones(1 << self.bits, dtype=np.uint8)
        used = np.flatnonzero(self.lengths)
        rank = used[np.lexsort((used, self.lengths[used]))]
        spread = 1 << (self.bits - self.lengths[rank].astype(np.int64))
        total = int(spread.sum())
        symbols[:total] = np.repeat(rank, spread)
        widths[:total] = np.repeat(self.lengths[rank], spread)
        return symbols, widths

    def decode(self, data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of all blocks, one after the other; ``first`` and ``sizes`` per block."""
        symbols, widths = self.decoder()
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint32)
        window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(int(starts[-1]), dtype=np.uint32)
        live = np.argsort(-sizes, kind="stable")  # the longest first, so that finished blocks fall off the end
        at, place, left = first[live].astype(np.int64), starts[:-1][live], sizes[live]
        for step in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-left, -step, side="left"))
            at, place, left = at[:n], place[:n], left[:n]
            key = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - self.bits)
            out[place + step] = symbols[key]
            at = at + widths[key]
        return out
