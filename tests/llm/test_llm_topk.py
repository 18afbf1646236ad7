"""Top-k search: how blocks meet, bounds of chunks, numbers of any size."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from subtide.llm import topk


def brute_force(rows: list[tuple[int, list]], asked, k: int) -> list[tuple]:
    expected = []
    for q, a in {q: min(v for i, v in rows if i == q) for q, _ in rows if asked(q)}.items():
        scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q and len(a) == len(b)]
        expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(expected)


def blocks(ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, rows: int) -> list[dict]:
    lists = pa.array(vectors.tolist(), pa.list_(pa.int64()))
    batch = pa.record_batch([pa.array(ids, pa.int64()), lists], names=["vec_id", "vector"])
    found = topk._pack(iter([batch]), {vectors.shape[1]: pivots}, rows)
    return [{k: v for k, v in row.items() if k != "block"} for part in found for row in part.to_pylist()]


def clustered(count: int, dim: int, seed: int = 3) -> np.ndarray:
    n = np.random.default_rng(seed)
    centres = n.integers(-300, 300, (12, dim))
    return centres[n.integers(0, 12, count)] + n.integers(-4, 5, (count, dim))


@pytest.mark.parametrize("groups", [1, 3])
def test_query_set_is_neither_broadcast_nor_copied_to_groups(spark, monkeypatch, groups):
    # Small blocks: 40 of candidates and 8 of queries, in several parts.
    for name, value in (("BLOCK_ROWS", 10), ("GROUPS", groups), ("PART_BLOCKS", 2)):
        monkeypatch.setattr(topk, name, value, raising=False)
    n = random.Random(5)
    rows = [(i, [n.randint(-50, 50) for _ in range(4)]) for i in range(380)]
    rows += [(i, [n.randint(-9, 9) for _ in range(2)]) for i in range(400, 420)]
    rows += [(5, rows[5][1]), (10, rows[10][1]), (10, [50, 50, 50, 50])]
    doubles = [(i, [float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame(doubles, "vec_id long, embedding array<double>").repartition(4)
    found = topk.top_k(df, F.col("vec_id") % 5 == 0, k=3, scale=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan and "CartesianProduct" in plan
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == brute_force(
        rows, lambda q: q % 5 == 0, 3
    )


def test_search_over_several_blocks_and_chunks_equals_brute_force():
    vectors = clustered(3000, 8)
    vectors[100:400] = vectors[7]
    ids = np.arange(3000)
    ids[2000:2040] = ids[1000:1040]
    pivots = topk.Vectors(ids[:16], vectors[:16])
    (asked,) = blocks(ids[5:900:30], vectors[5:900:30], pivots.vectors, 4096)
    queries = topk.Asked(**asked, k=4, pivots=pivots)
    for block in blocks(ids, vectors, pivots.vectors, 1100):
        topk.search(queries, topk.Block(**block))
    hits = sorted(queries.hits().to_pylist(), key=lambda h: (h["query_id"], -h["score"], h["vec_id"]))
    whole = list(zip(ids.tolist(), vectors.tolist()))
    wanted = set(ids[5:900:30].tolist())
    expected = [(q, v, s) for q, _, v, s in brute_force(whole, wanted.__contains__, 4)]
    assert [(h["query_id"], h["vec_id"], h["score"]) for h in hits] == expected


def test_chunks_below_the_k_best_are_left_out(monkeypatch):
    vectors, ids = clustered(4000, 8), np.arange(4000)
    pivots = topk.Vectors(ids[:16], vectors[:16])
    (packed,), (asked,) = (blocks(ids[::s], vectors[::s], pivots.vectors, 4096) for s in (1, 50))
    seen, whole = [], topk.products

    def counted(*args):
        seen.append(whole(*args))
        return seen[-1]

    queries = topk.Asked(**asked, k=4, pivots=pivots)
    monkeypatch.setattr(topk, "products", counted)
    topk.search(queries, topk.Block(**packed))
    assert sum(s.size for s in seen) < 0.4 * 4000 * 80


@pytest.mark.parametrize("far", [1, 10**6, 10**11])
def test_no_score_is_above_its_bound(far):
    vectors, ids = clustered(1000, 5), np.arange(1000)
    pivots = vectors[:16] * np.array([far] + [1] * 15)[:, None]
    (packed,) = blocks(ids, vectors, pivots, 4096)
    block = topk.Block(**packed)
    bounds = topk.upper_bounds(block, block)
    scores = block.vectors.astype(np.int64) @ block.vectors.astype(np.int64).T
    assert (np.maximum.reduceat(scores, block.starts, axis=1) <= bounds).all()


@pytest.mark.parametrize("size", [100, 30_000, 2**20, 2**26, 2**30])
def test_numbers_of_any_size_are_exact(spark, size):
    n = random.Random(size)
    rows = [(i, [float(n.randint(-size, size)) for _ in range(3)]) for i in range(200)]
    rows += [(i + 200, rows[i][1][:2] + [rows[i][1][2] + 1]) for i in range(0, 200, 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, F.col("vec_id") % 10 == 0, k=20, scale=1).collect()
    whole = [(i, [int(x) for x in v]) for i, v in rows]
    expected = brute_force(whole, lambda q: q % 10 == 0, 20)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == expected
