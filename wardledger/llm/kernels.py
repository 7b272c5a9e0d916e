"""Words and hashes of Arrow text columns, as numpy operations over whole buffers.

A column is taken in slices of a few MB (one text at least), so the arrays stay
small whatever the number of rows in a batch. Words are found on UTF-8 bytes:
every separator used here is ASCII, so a multi-byte character is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20
_P = U64(0x9E3779B97F4A7C15)
_TAIL = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)  # of a block, its first bytes


def byte_table(separator: str) -> np.ndarray:
    """256 entries: True where a byte separates words. ``space``: 0x20 and 0x09-0x0D;
    ``symbol``: every ASCII byte but digits and letters."""
    b = np.arange(256)
    if separator == "space":
        return (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
    if separator == "symbol":
        word = ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x41) & (b <= 0x5A)) | ((b >= 0x61) & (b <= 0x7A)) | (b >= 0x80)
        return ~word
    raise ValueError(separator)


def lower_table() -> np.ndarray:
    b = np.arange(256, dtype=np.uint8)
    b[0x41:0x5B] += 32
    return b


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit over all bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class Texts:
    """Some consecutive texts: bytes and where each begins; null counts as empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int) -> None:
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return self.offsets.size - 1


def slices(column: pa.Array | pa.ChunkedArray, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a column in order, a few MB at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(at, at[begin] + max_bytes, "right")) - 1
        end = min(n, max(begin + 1, end))
        yield Texts(raw[at[begin] : at[end]], at[begin : end + 1] - at[begin], begin)
        begin = end


class Words:
    """Words of ``Texts``: ``start``, ``end`` (byte positions), ``text`` (row), ``hash``;
    ``of`` holds the first word of each text and the number of all at its end."""

    def __init__(self, texts: Texts, separator: np.ndarray, lower: bool = True, hashed: bool = True) -> None:
        data, n = texts.data, texts.data.size
        inside = np.zeros(n + 1, bool)
        inside[:n] = ~separator[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cut = texts.offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        begins[cut] |= inside[cut]  # a word ends with its text
        self.start = np.flatnonzero(begins[:n])
        ends = np.zeros(n + 1, bool)
        ends[1:] = inside[:n] & ~inside[1:]
        ends[cut] |= inside[cut - 1]
        self.end = np.flatnonzero(ends)
        self.of = np.searchsorted(self.start, texts.offsets)
        self.of[-1] = self.start.size
        self.count = np.diff(self.of)
        self.text = np.repeat(np.arange(len(texts)), self.count)
        self.data = lower_table()[data] if lower else data
        if hashed:
            self.hash = hash_spans(self.data, self.start, self.end)


def span_blocks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of spans in blocks of 8, the last filled up with zeros: span and place in it of each block, and its value."""
    span, block = runs((end - start + 7) // 8)
    at = start[span] + 8 * block
    padded = np.concatenate([np.ascontiguousarray(data), np.zeros(8, np.uint8)])
    return span, block, np.ndarray(data.size + 1, "<u8", padded, strides=(1,))[at] & _TAIL[np.minimum(end[span] - at, 8)]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans: blocks of 8 bytes are mixed with their place, then added up with the length.

    ``data`` holds bytes, or code points in 32 bits. No polynomial: those modulo 2 ** 64
    give regular texts of some thousand bytes equal values.
    """
    if data.itemsize > 1:
        return hash_spans(data.view(np.uint8), data.itemsize * start, data.itemsize * end)
    size = end - start
    span, block, words = span_blocks(data, start, end)
    place = mix64(np.arange(1, int(block.max(initial=0)) + 2).astype(U64) * _P)
    total = np.zeros(span.size + 1, U64)
    np.cumsum(mix64(words ^ place[block]), out=total[1:])
    last = np.cumsum(-(-size // 8))
    return mix64(total[last] - total[last + size // -8] + size.astype(U64) * U64(0x5851F42D4C957F2D))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each position, and whether they are of one text."""
    h, size = words.hash, words.hash.size
    if size < n:
        return np.zeros(0, U64), np.zeros(0, bool)
    out = np.zeros(size - n + 1, U64)
    for i in range(n):
        out = out * U64(0xD6E8FEB86659FD93) + h[i : size - n + 1 + i]
    return mix64(out + U64(n)), words.text[: size - n + 1] == words.text[n - 1 :]


def sliding(a: np.ndarray, n: int, op: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``n`` neighbours, in log n steps."""
    width = 1
    while width < n:
        step = min(width, n - width)
        a = op(a[:-step], a[step:])
        width += step
    return a


class HashIndex:
    """Open addressing over arrays: 64-bit key to its number, in order of arrival."""

    def __init__(self, log2_slots: int = 16) -> None:
        self._clear(log2_slots)
        self.keys = np.zeros(0, U64)

    def _clear(self, log2_slots: int) -> None:
        self.mask = U64((1 << log2_slots) - 1)
        self.slot_number = np.full(1 << log2_slots, -1, np.int32)
        self.slot_key = np.zeros(1 << log2_slots, U64)
        self.log2_slots = log2_slots

    def _place(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        at = (keys & self.mask).astype(np.int64)
        while keys.size:
            free = self.slot_number[at] < 0
            self.slot_number[at[free]] = numbers[free]  # of several, the last write stays
            won = self.slot_number[at] == numbers
            self.slot_key[at[won]] = keys[won]
            keys, numbers, at = keys[~won], numbers[~won], (at[~won] + 1) & int(self.mask)

    def add(self, keys: np.ndarray) -> None:
        """``keys``: distinct and not in the index."""
        if self.keys.size + keys.size > (1 << self.log2_slots) * 0.4:
            log2_slots = self.log2_slots
            while self.keys.size + keys.size > (1 << log2_slots) * 0.4:
                log2_slots += 1
            self._clear(log2_slots)
            self._place(self.keys, np.arange(self.keys.size, dtype=np.int32))
        self._place(keys, np.arange(self.keys.size, self.keys.size + keys.size, dtype=np.int32))
        self.keys = np.concatenate([self.keys, keys])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of ``keys``, -1 where absent."""
        at = (keys & self.mask).astype(np.int64)
        number = self.slot_number[at]
        out = np.where((number >= 0) & (self.slot_key[at] == keys), number, np.int32(-1))
        todo = np.flatnonzero((number >= 0) & (out < 0))
        at = at[todo]
        while todo.size:
            at = (at + 1) & int(self.mask)
            number = self.slot_number[at]
            hit = (number >= 0) & (self.slot_key[at] == keys[todo])
            out[todo[hit]] = number[hit]
            on = (number >= 0) & ~hit
            todo, at = todo[on], at[on]
        return out


def runs(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of ``count`` items: group of each item, position in its group."""
    group = np.repeat(np.arange(count.size), count)
    first = np.cumsum(count) - count
    return group, np.arange(group.size) - first[group]


def gather(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``values[start[i] : start[i] + count[i]]`` of all ``i``, one after the other."""
    at = np.repeat(start - (np.cumsum(count) - count), count)
    at += np.arange(at.size)
    return values[at]
