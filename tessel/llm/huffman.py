"""Canonical length-limited Huffman codes: lengths from counts, packing, table-driven decoding."""

from __future__ import annotations

import heapq

import numpy as np


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    # Each level holds the merged, sorted weights of leaves and of the pairs below; only which are leaves is kept.
    levels = []
    pairs = np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([weight, pairs])
        at = np.argsort(merged, kind="stable")
        levels.append(at < n)
        merged = merged[at]
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def plain_lengths(counts: np.ndarray) -> np.ndarray:
    """Unlimited Huffman lengths by a heap; a check on small inputs."""
    heap = [(int(c), i, (i,)) for i, c in enumerate(counts) if c]
    lengths = np.zeros(len(counts), dtype=np.int64)
    if len(heap) == 1:
        lengths[heap[0][1]] = 1
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for i in a[2] + b[2]:
            lengths[i] += 1
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol), as right-aligned integers."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order) == 0:
        return codes
    width = lengths[order].astype(np.int64)
    top = int(width[-1])
    # A code is the sum of the space that all shorter or earlier codes take.
    before = np.concatenate([[0], np.cumsum(1 << (top - width))[:-1]])
    codes[order] = (before >> (top - width)).astype(np.uint64)
    return codes


class Coder:
    """Packs ids to big-endian bit strings and back, by lengths alone."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, dtype=np.uint8)
        self.wide = self.lengths.astype(np.int64)
        self.codes = canonical_codes(self.lengths)
        self.top = int(self.lengths.max(initial=0))
        self._table: tuple[np.ndarray, np.ndarray] | None = None

    def pack(self, ids: np.ndarray, every: int, chunk: int = 1 << 14) -> tuple[bytes, np.ndarray]:
        """The bits, and the bit offset of each `every`-th id; by chunks that stay in the cache."""
        if len(ids) == 0:
            return b"", np.empty(0, dtype=np.int64)
        out = np.zeros(len(ids) * self.top // 64 + 2, dtype=np.uint64)
        marks, total = [], 0
        for k in range(0, len(ids), chunk):
            part = ids[k : k + chunk]
            size = self.wide[part]
            if not size.all():
                raise ValueError("an id has no code")
            end = np.cumsum(size) + total
            start = end - size
            marks.append(start[-k % every :: every])
            total = int(end[-1])
            word = start >> 6
            shift = 64 - (start & 63) - size  # negative: the code goes on into the next word
            code = self.codes[part]
            over = np.flatnonzero(shift < 0)  # at most one in each word
            head = code << (shift & 63).astype(np.uint64)
            head[over] = code[over] >> (-shift[over]).astype(np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[first]] |= np.bitwise_or.reduceat(head, first)
            out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[: (total + 7) // 8], np.concatenate(marks)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length by the next `top` bits."""
        if self._table is None:
            order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
            order = order[self.lengths[order] > 0]
            room = (1 << (self.top - self.wide[order])) if len(order) else np.empty(0, dtype=np.int64)
            symbol = np.repeat(order, room).astype(np.uint32)
            fill = (1 << self.top) - len(symbol)
            self._table = np.pad(symbol, (0, fill)), np.pad(self.lengths[symbol], (0, fill), constant_values=1)
        return self._table

    def unpack(self, data: bytes, n: int, marks: np.ndarray, every: int) -> np.ndarray:
        """n ids; all stretches between checkpoints are decoded side by side."""
        if n == 0:
            return np.empty(0, dtype=np.uint32)
        symbol, size = self.table()
        raw = np.frombuffer(data + b"\0" * 8, dtype=np.uint8)
        # windows[i]: the 32 bits from byte i on, so that any offset needs one lookup
        wide = raw.astype(np.uint32)
        windows = (wide[:-3] << np.uint32(24)) | (wide[1:-2] << np.uint32(16)) | (wide[2:-1] << np.uint32(8)) | wide[3:]
        at = np.array(marks, dtype=np.int64)
        out = np.zeros((every, len(at)), dtype=np.uint32)
        last = n - (len(at) - 1) * every
        down, mask = np.int64(32 - self.top), np.int64((1 << self.top) - 1)
        for k in range(min(every, n)):
            if k == last:
                at = at[:-1]
            bits = (windows[at >> 3].astype(np.int64) >> (down - (at & 7))) & mask
            out[k, : len(at)] = symbol[bits]
            at = at + size[bits]
        return out.T.reshape(-1)[:n]
