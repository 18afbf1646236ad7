"""Hard negatives, against all pairs one by one."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subtide.llm import negatives

ROWS = "vec_id long, embedding array<double>, label int, key int, rank string, dim int"


def vectors(spark, rows):
    """Vectors with further columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], ROWS)


def plain(rows, positives=5, count=3, low=50, high=95) -> list:
    whole = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if all(x is not None and math.isfinite(x) for x in vector):
            whole.add((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for a_id, a_label, a in whole:
        if a_id % 50:
            continue
        others = [(sum(x * y for x, y in zip(a, v)), i, own) for i, own, v in whole if i != a_id and len(v) == len(a)]
        own = sorted({(-s, i) for s, i, label in others if label == a_label})[:positives]
        rest = sorted({(-s, i) for s, i, label in others if label != a_label})
        for minus, positive in own:
            fit = [(-s, i) for s, i in rest if low * -minus <= 100 * -s <= high * -minus]
            out += [(a_id, positive, k, i, -minus, s) for k, (s, i) in enumerate(fit[:count], 1)]
    return sorted(out)


def found_in(frame) -> list:
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def mined(spark, rows, **options):
    return found_in(negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 50 == 0, **options))


def random_rows(dice, count, dim, digits, labels=3):
    """Coarse components, so that many scores are equal."""
    return [
        (i, [round(dice.uniform(-1, 1.5), digits) for _ in range(dim)], dice.randrange(labels)) for i in range(count)
    ]


@pytest.mark.parametrize("dim, digits", [(3, 0), (8, 1), (13, 2), (64, 3)])
def test_equals_all_pairs(spark, dim, digits):
    rows = random_rows(random.Random(dim), 260, dim, digits)
    found = mined(spark, rows)
    assert found == plain(rows) and found


def test_chunks_and_batches(spark, monkeypatch):
    """Floors that one chunk leaves for the next lose nothing."""
    rows = random_rows(random.Random(5), 400, 6, 1)
    expected = plain(rows)
    whole = vectors(spark, rows).repartition(23)
    assert found_in(negatives.hard_negatives(whole, F.col("vec_id") % 50 == 0)) == expected
    wide = negatives.hard_negatives(whole, F.col("vec_id") % 50 == 0, positives=2, negatives=7, low=10, high=90)
    assert found_in(wide) == plain(rows, 2, 7, 10, 90)


def test_defined_cases(spark):
    dice = random.Random(9)
    rows = random_rows(dice, 120, 4, 1)
    rows += [(None, [1.0] * 4, 1), (50, None, 1), (100, [1.0] * 4, None), (200, [1.0, None, 1.0, 1.0], 1)]
    rows += [(250, [1.0, math.nan, 1.0, 1.0], 1), (300, [1.0, math.inf, 1.0, 1.0], 1), (350, [], 1), (351, [], 1)]
    rows += [(400, [1.0] * 5, 1), (401, [2.0] * 5, 1), (402, [1.5] * 5, 2), (450, [9.0] * 6, 7)]
    # Repeated rows, also of anchors; rows that share an id but differ.
    rows += rows[:60] + [(50, [1.0, 1.0, 0.0, 1.0], 0), (51, [1.0, 1.0, 0.0, 1.0], 0), (0, rows[0][1], 5)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


def test_scores_beyond_64_bits_on_the_way(spark):
    """Sums that 64 bits might not hold are added with Python's integers."""
    dice = random.Random(3)
    rows = [
        (i, [dice.uniform(-9, 9)] + [dice.choice([-1, 1]) * dice.uniform(0, 1e6) for _ in range(8)], i % 2)
        for i in range(101)
    ]
    rows += [(150, [2.0**42] + [0.0] * 8, 0), (151, [9.0] + [0.0] * 8, 0), (153, [8.5] + [0.0] * 8, 1)]
    assert negatives.exact_type(np.array([[2**50] * 9]), 30) is object
    assert mined(spark, rows) == plain(rows)


def test_tables_and_planes():
    dice = np.random.default_rng(1)
    anchors, others = dice.integers(-300, 300, (5, 11)), dice.integers(-70, 900, (40, 11))
    sums = negatives.subset_sums(anchors)
    assert sums.shape == (2, 256, 5) and (sums[0, 0b101] == anchors[:, 0] + anchors[:, 2]).all()
    assert (negatives.scores(sums, negatives.bit_planes(others)) == others @ anchors.T).all()
    zeros = np.zeros((3, 11), dtype=np.int64)
    assert (negatives.scores(sums, negatives.bit_planes(zeros)) == 0).all()
