"""Find benchmark items in documents, with up to ``rate`` of an item's characters edited.

An item of n characters may differ by k = floor(rate * n) insertions, deletions or substitutions. It
is split into k + 1 pieces. By the pigeonhole principle an occurrence with at most k edits holds one
piece unchanged, within k characters of its place. One Aho-Corasick automaton finds all pieces of all
items in one pass over a text, and Myers' bit-parallel algorithm gives the smallest edit distance of
the item to any part of the text around a hit. So no occurrence within the budget is missed.

Texts and items are compared in lower case, with each run of other than letters and digits as one
space; places refer to that form. Items shorter than ``min_chars`` in that form are looked for if
``short`` says so, as they are in op10 and the pipeline: unchanged, and as whole words, so that "art" is
not found in "party". In scripts written without spaces (Chinese, Japanese, Thai and the like) a word
may begin and end at any character.

Scale: documents are scanned where they lie, without a shuffle. Items go out in blocks of about
``BLOCK_CHARS`` characters, dealt by hash. ``matches`` reads the documents once per block, a task each with
one block's automaton. ``clean`` passes them through all blocks in one task, which then holds all automata,
and the driver holds the items of all blocks while the plan is built: the benchmark has to fit there.

Defined cases: NULL and empty texts hold nothing. For each row of documents and each item_id there is
one result, the smallest distance and then the first place. Repeated documents give repeated results.
Items that repeat change nothing, and neither do those without a letter or digit. Each text without an
item_id is an item of its own with a NULL item_id, unless it repeats that of an item with an id. Extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial, reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from subtide.llm.common import record_batches, trimming
from subtide.sources import written

RATE = 0.05
MIN_CHARS = 20
BLOCK_CHARS = 1_000_000

WORDS = re.compile(r"[^\W_]+")
# Fixed value: characters of scripts that put no spaces between words (Thai to Tibetan, Myanmar, Khmer,
# kana, Chinese characters).
UNSPACED = re.compile(
    "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]"
)

FOUND = "doc_id long, item_id long, distance int, start int, end int"
FOUND_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("distance", pa.int32()),
        ("start", pa.int32()),
        ("end", pa.int32()),
    ]
)


def normal(text: str | None) -> str:
    return " ".join(WORDS.findall((text or "").lower()))


def pieces(length: int, errors: int) -> list[tuple[int, int]]:
    """(start, end) of ``errors + 1`` pieces of nearly equal length."""
    cuts = [length * i // (errors + 1) for i in range(errors + 2)]
    return list(zip(cuts, cuts[1:]))


def edit_search(pattern: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of the pattern to any part of the text, and where the first one ends."""
    size = len(pattern)
    every, high = (1 << size) - 1, 1 << (size - 1)
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    up, down, score = every, 0, size
    best, end = size, 0
    for j, c in enumerate(text):
        eq = equal.get(c, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus = down | (every & ~(horizontal | up))
        minus = up & horizontal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = plus << 1, minus << 1
        up = (minus | ~(vertical | plus)) & every
        down = plus & vertical & every
        if score < best:
            best, end = score, j + 1
    return best, end


def at_word_end(text: str, at: int) -> bool:
    """Whether a word may begin or end before the character at ``at`` of a normal text."""
    if at in (0, len(text)):
        return True
    before, after = text[at - 1], text[at]
    return before == " " or after == " " or bool(UNSPACED.match(before) or UNSPACED.match(after))


class Items:
    """Normal items with one automaton over all their pieces.

    Those shorter than ``min_chars`` are found unchanged and as whole words only.
    """

    def __init__(self, items: list[tuple[int | None, str]], rate: float, min_chars: int = 0):
        self.items = [(key, text) for key, text in items if text]
        items = self.items
        self.whole = [len(text) < min_chars for _, text in items]
        self.budgets = [0 if w else int(rate * len(text)) for w, (_, text) in zip(self.whole, items)]
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for start, end in pieces(len(text), self.budgets[i]):
                places.setdefault(text[start:end], []).append((i, start))
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) of each item in a normal text, the best place each."""
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        # By (whether the item has an id, its id or else its place in the list).
        best: dict[tuple[bool, int], tuple[int, int, int]] = {}
        for last, (length, where) in self.automaton.iter(text):
            for i, offset in where:
                start = last + 1 - length - offset
                if not self.whole[i]:
                    starts.setdefault(i, set()).add(start)
                elif at_word_end(text, start) and at_word_end(text, last + 1):
                    key, hit = self._key(i), (0, start, last + 1)
                    best[key] = min(best.get(key, hit), hit)
        for i, found in starts.items():
            key, item = self._key(i), self.items[i][1]
            for hit in self._verify(text, item, self.budgets[i], sorted(found)):
                best[key] = min(best.get(key, hit), hit)
        return [(key if named else None, *hit) for (named, key), hit in sorted(best.items())]

    def _key(self, i: int) -> tuple[bool, int]:
        key = self.items[i][0]
        return (False, i) if key is None else (True, key)

    @staticmethod
    def _verify(text: str, item: str, budget: int, starts: list[int]) -> Iterator[tuple[int, int, int]]:
        size, at = len(item), 0
        while at < len(starts):
            first = last = starts[at]
            while at < len(starts) and starts[at] - last <= budget:
                last = starts[at]
                at += 1
            low = max(0, first - budget)
            window = text[low : last + size + budget]
            exact = window.find(item)
            if exact >= 0:
                yield 0, low + exact, low + exact + size
                continue
            distance, end = edit_search(item, window)
            if distance <= budget:
                back = window[max(0, end - size - budget) : end][::-1]
                yield distance, low + end - edit_search(item[::-1], back)[1], low + end


def item_blocks(
    items: DataFrame, min_chars: int, block_chars: int, short: bool = False
) -> Iterator[list[tuple[int | None, str]]]:
    """Normal items, a bounded block at a time."""
    rows = items.select(F.col("item_id").cast("long"), "text").filter(F.col("text").isNotNull()).distinct()
    named = rows.filter(F.col("item_id").isNotNull())
    nameless = rows.filter(F.col("item_id").isNull()).join(named.select("text"), "text", "left_anti")
    rows = written(named.unionByName(nameless))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    for block in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        read = [(r["item_id"], normal(r["text"])) for r in own.collect()]
        yield [(key, text) for key, text in read if text and (short or len(text) >= min_chars)]


@trimming
def _matches(batches: Iterator[pa.RecordBatch], items: list, rate: float, min_chars: int) -> Iterator[pa.RecordBatch]:
    known = Items(items, rate, min_chars)

    def rows() -> Iterator[dict]:
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for found in known.find(normal(text)):
                    yield dict(zip(FOUND_SCHEMA.names, (key, *found)))

    yield from record_batches(rows(), FOUND_SCHEMA, 10_000)


def matches(
    docs: DataFrame,
    items: DataFrame,
    rate: float = RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
    short: bool = False,
) -> DataFrame:
    """Rows of (doc_id, item_id, distance, start, end) for every item found in a document."""
    read = docs.select(F.col("doc_id").cast("long"), "text")
    found = [
        read.mapInArrow(partial(_matches, items=block, rate=rate, min_chars=min_chars), FOUND)
        for block in item_blocks(items, min_chars, block_chars, short)
    ]
    return reduce(DataFrame.unionAll, found)


@trimming
def _clean(batches: Iterator[pa.RecordBatch], items: list, rate: float, min_chars: int) -> Iterator[pa.RecordBatch]:
    known = Items(items, rate, min_chars)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        yield batch.filter(pa.array([not known.find(normal(t)) for t in texts], pa.bool_()))


def clean(
    docs: DataFrame,
    items: DataFrame,
    rate: float = RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
    short: bool = False,
) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    for block in item_blocks(items, min_chars, block_chars, short):
        docs = docs.mapInArrow(partial(_clean, items=block, rate=rate, min_chars=min_chars), docs.schema)
    return docs
