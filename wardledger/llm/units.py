"""Token ids of texts by way of their distinct units.

A text is cut at every single white-space byte between other characters and between a
letter and a following mark. None of the tokenizers used here joins across such a place,
so the ids of a text are those of its units in order, and a worker encodes each distinct
unit once. Units are compared by their bytes (Arrow's dictionary encoding), not by hash.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

from .kernels import Texts, lower_table

MEMO = 1_000_000  # units that a worker remembers
SHORT = 64  # characters of a unit that is remembered
MARK = np.isin(np.arange(256), list(b".,;:!?"))
Encoder = Callable[[list[str]], list[list[int]]]


def cut_units(texts: Texts) -> np.ndarray:
    """Byte position of each unit. White space beyond ASCII may follow a cut only from the left."""
    data, n = texts.data, texts.data.size
    begins = np.zeros(n + 1, bool)
    if n > 1:
        letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) & (data < 0x80)
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # Latin letters with marks
        begins[1:n] = letter[:-1] & MARK[data[1:]]
    if n > 2:
        space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
        wide = (data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3)  # first byte of other white space
        here = (data[1:-1] == 0x20) | (data[1:-1] == 0x0A)
        begins[1 : n - 1] |= here & ~space[:-2] & ~space[2:] & ~wide[2:]
    begins[texts.offsets[:-1]] = True
    return np.flatnonzero(begins[:n])


class UnitMemo:
    """Ids of units under one or more encoders (lanes).

    ``lower``: the encoders do not tell A-Z from a-z, but in the names of special tokens.
    """

    def __init__(self, encoders: list[Encoder], limit: int = MEMO, lower: bool = False) -> None:
        self.encoders, self.limit, self.lower = encoders, limit, lower
        self.number: dict[str, int] = {}
        self.lanes = [(np.zeros(0, np.int32), np.zeros(1, np.int64)) for _ in encoders]

    def _numbers(self, units: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Number of each of some distinct units; by lane all ids and where those of each number begin."""
        known = self.number
        number = np.fromiter((known.get(u, -1) for u in units), np.int64, len(units))
        new = np.flatnonzero(number < 0).tolist()
        if not new:
            return number, self.lanes
        new.sort(key=lambda i: len(units[i]) > SHORT)  # those to remember come first
        fresh = [units[i] for i in new]
        base = len(known)
        number[new] = base + np.arange(len(new))
        lanes = []
        for encode, (ids, ends) in zip(self.encoders, self.lanes, strict=True):
            found = encode(fresh)
            count = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(count.sum()))
            lanes.append((np.concatenate([ids, flat]), np.concatenate([ends, ends[-1] + np.cumsum(count)])))
        kept = sum(len(u) <= SHORT for u in fresh)
        if base + kept <= self.limit:
            known.update(zip(fresh[:kept], range(base, base + kept), strict=True))
            size = base + kept
            self.lanes = [(ids[: ends[size]], ends[: size + 1]) for ids, ends in lanes]
        return number, lanes

    def encode(self, texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
        """By lane: the ids of all texts one after the other, and how many each text has."""
        start = cut_units(texts)
        of = np.searchsorted(start, texts.offsets)
        of[-1] = start.size
        bounds = np.append(start, texts.data.size).astype(np.int32 if texts.data.size < 1 << 31 else np.int64)
        kind = pa.string() if bounds.dtype == np.int32 else pa.large_string()
        data = np.ascontiguousarray(texts.data)
        if self.lower and not ((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any():  # no "<|"
            data = lower_table()[data]
        units = pa.Array.from_buffers(kind, start.size, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = units.dictionary_encode()
        number, lanes = self._numbers(coded.dictionary.to_pylist())
        number = number[coded.indices.to_numpy()] if start.size else np.zeros(0, np.int64)
        out = []
        for ids, ends in lanes:
            count = np.diff(ends)[number]
            total = np.concatenate([[0], np.cumsum(count)])
            # Place of each id: a running number, moved to where its unit's ids begin.
            at = np.arange(total[-1]) + np.repeat(ends[number] - total[:-1], count)
            out.append((ids[at], np.diff(total[of])))
        return out


def worker_memo(key: tuple[str, ...], build: Callable[[], UnitMemo]) -> UnitMemo:
    """The memo of this Python worker for ``key``; it lives as long as the worker does."""
    cache = sys.modules.setdefault("_unit_worker_cache", types.ModuleType("_unit_worker_cache"))
    if getattr(cache, "key", None) != key:
        cache.memo, cache.key = build(), key
    return cache.memo
