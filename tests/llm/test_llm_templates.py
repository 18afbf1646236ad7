"""The Jaccard join on texts from one template: many shared shingles, few links, no comparing of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from llm_plain import components, shingles
from subtide.llm import jaccard

FIELDS, VALUES = 60, 6


def templated(count: int, seed: int = 1) -> list[np.ndarray]:
    """Sets of 60 fields with one of 6 values each, six shingles a value."""
    dice = np.random.default_rng(seed)
    known = dice.integers(0, 2**63, (FIELDS, VALUES, 6)).astype(np.uint64)
    picks = dice.integers(0, VALUES, (count, FIELDS))
    return [np.unique(known[np.arange(FIELDS), pick].ravel()) for pick in picks]


def roots(count: int, links) -> list[int]:
    root = list(range(count))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        low, high = sorted((top(int(a)), top(int(b))))
        root[high] = low
    return [top(i) for i in range(count)]


def test_looked_at_pairs_grow_with_the_sets_only(monkeypatch):
    looked = []
    common = jaccard.Members.common

    def counting(self, one, others):
        looked.append(len(others))
        return common(self, one, others)

    monkeypatch.setattr(jaccard.Members, "common", counting)
    found = {}
    for count in (1000, 2000):
        looked.clear()
        assert jaccard.join_block(templated(count)) == []
        found[count] = sum(looked)
    assert found[2000] < 2000 * 20  # of two million pairs


@pytest.mark.parametrize("seed", range(12))
def test_blocks_equal_all_pairs(seed):
    dice = random.Random(seed)
    similar = dice.choice([(85, 100), (80, 100), (50, 100), (95, 100), (100, 100)])
    sets = []
    for _ in range(12):
        base = [dice.getrandbits(63) for _ in range(dice.choice([1, 2, 5, 8, 20, 60, 150]))]
        for _ in range(dice.randint(1, 12)):
            own = set(base)
            for _ in range(dice.randint(0, max(1, len(base) // 6))):
                if len(own) > 1 and dice.random() < 0.5:
                    own.discard(dice.choice(sorted(own)))
                else:
                    own.add(dice.getrandbits(63))
            sets.append(np.array(sorted(own), dtype=np.uint64))
    sets += [s for s in templated(40, seed)]
    dice.shuffle(sets)
    plain = components({i: frozenset(s.tolist()) for i, s in enumerate(sets)}, *similar)
    assert roots(len(sets), jaccard.join_block(sets, similar)) == [plain[i] for i in range(len(sets))]


def test_templated_documents(spark):
    """One cell holds nearly all of them; copies with one field changed link, others do not."""
    dice = random.Random(2)
    rows = []
    for i in range(300):
        fields = [f"field{f} has the value {dice.randrange(VALUES)}" for f in range(FIELDS)]
        rows.append((i, " ".join(fields)))
        if i % 25 == 0:
            fields[7] = "field7 says something else"
            rows.append((1000 + i, " ".join(fields)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()}
    assert found == components({key: shingles(text, 4) for key, text in rows}, 85, 100)
    assert found[1000] == 0 and found[1] == 1


@pytest.mark.parametrize("families", [0, 3])
def test_large_cells_of_templated_documents(spark, monkeypatch, families):
    """Cut into blocks, a cell's sets meet in parts that several components hold, not block by block."""
    monkeypatch.setattr(jaccard, "BLOCK", 3_000)
    met = []
    across, cells = jaccard._join_across_blocks, jaccard._join_cells

    def counting(known, similar):
        met.append(known.count())
        return across(known, similar)

    def regions(sets, placed, similar, by_parts=True):
        if not by_parts:
            met.append(placed.count())
        return cells(sets, placed, similar, by_parts)

    monkeypatch.setattr(jaccard, "_join_across_blocks", counting)
    monkeypatch.setattr(jaccard, "_join_cells", regions)
    dice = random.Random(4)
    rows = []
    for i in range(200):
        fields = [f"field{f} has the value {dice.randrange(VALUES)}" for f in range(FIELDS)]
        rows.append((i, " ".join(fields)))
        for copy in range(40 if i < families else i % 20 == 0):
            near = list(fields)
            for _ in range(1 + copy % 3):
                near[dice.randrange(FIELDS)] = f"field7 says {dice.randrange(10**6)} something else"
            rows.append((1000 * (copy + 1) + i, " ".join(near)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df).collect()}
    sets = {key: shingles(text, 4) for key, text in rows}
    assert found == components(sets, 85, 100)
    blocks = sum(map(len, sets.values())) / 3_000
    by_blocks = 2 * len(rows) * blocks  # every set meets every block, and every block of others all sets
    assert met and sum(met) < (by_blocks if families else by_blocks / 3)
