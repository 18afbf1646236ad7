"""Plain versions that the operators are compared with."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, size: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def components(sets: dict, share: int, of: int) -> dict:
    """The smallest key reachable by links, for each key."""
    parent = {key: key for key in sets}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and of * common >= share * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {key: root(key) for key in keys}


def normal_words(text: str | None) -> str:
    return " ".join(re.findall(r"[^\W_]+", (text or "").lower()))


def edit_distance_within(pattern: str, text: str) -> int:
    """Smallest edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        above, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (a != b)))
    return min(row)
