"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOL_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None, pattern: re.Pattern = WORD) -> list[str]:
    return pattern.findall((text or "").translate(LOWER))


def shingles(text: str | None, n: int) -> frozenset:
    words = words_of(text)
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components(texts: dict[int, str | None], n: int, num: int, den: int) -> dict[int, int]:
    """Least id of the group of each id; all pairs that share a shingle are compared."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    both = Counter((min(a, b), max(a, b)) for ids in holders.values() for k, a in enumerate(ids) for b in ids[:k])
    parent = {i: i for i in texts}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), k in both.items():
        if den * k >= num * (len(sets[a]) + len(sets[b]) - k):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}


def crc(value: object) -> int:
    return zlib.crc32(str(value).encode())
