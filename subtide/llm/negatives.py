"""Hard negatives of labelled vectors, scored by the method of the Four Russians.

Vectors become integers, ``floor(scale * x)``, and the score of two is their inner product. An anchor's
dimensions go in groups of eight; per group a table holds the sum of every subset of its eight
components, 256 sums. A candidate's components are cut into bit planes (two's complement), and each
plane packed to one byte per group. That byte is the index of the subset whose sum the group adds to
the plane, so a score needs no multiplication: per plane look up and add, then shift and add the planes,
the highest with a minus. All scores are full and exact.

For each anchor the positives are the best rows of its own label; a negative of an anchor and a
positive is a row of another label whose score lies between two shares of the positive's. The first
pass scores candidates of the anchor's label, the second those of other labels, so no pair of rows is
scored twice.

Spark packs candidates into chunks of bit planes and anchors into batches; each batch meets each
chunk. A task makes the tables of a batch, scores the chunk in steps of a few anchors, and gives only
the best of each anchor (and positive); it remembers the lowest score that still counts, so later
chunks give fewer. Windows keep the best over all chunks, and Spark applies their limit before the
shuffle too. Chunks hold rows of any label, so a label with a third of all rows is dealt like any other.

Defined cases: rows with a NULL id, label or vector, or a NULL or non-finite component, take no part.
Vectors of different lengths never meet. Rows with the anchor's id are neither its positives nor its
negatives. Exactly repeated rows count once, as anchors and as candidates; rows that share an id but
differ take part each, as candidates once per score. An anchor without another row of its label, or a
positive without a negative, gives no row. An empty table gives none. Extra columns are ignored.
Components must stay below 2^53 when scaled, and scores within 64 bits; where sums on the way may need more,
they are added with Python's integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from subtide.sources import written

GROUP = 8
CHUNK_ROWS = 16384
BATCH_ROWS = 512
# Anchors scored at a time: their tables stay in a core's cache.
STEP = 64

PACKED = "dim int, bits int, ids binary, labels binary, planes binary"
PACKED_SCHEMA = pa.schema(
    [("dim", pa.int32()), ("bits", pa.int32())] + [(c, pa.binary()) for c in ("ids", "labels", "planes")]
)
BATCH = "batch string, dim int, keys binary, ids binary, labels binary, vectors binary, lows binary, highs binary"
BATCH_SCHEMA = pa.schema(
    [("batch", pa.string()), ("dim", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "ids", "labels", "vectors", "lows", "highs")]
)
NO_SCORE = np.iinfo(np.int64).min


def labelled_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Rows of (vec_id, label, vector array<long>) of the rows that take part."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("_x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(
            F.col("vec_id").cast("long"), F.col("label").cast("long"), doubles.alias("_x")
        )
        .filter("vec_id IS NOT NULL AND label IS NOT NULL AND _x IS NOT NULL")
        .filter(~bad)
        .select("vec_id", "label", F.transform("_x", lambda x: F.floor(x * scale)).alias("vector"))
    )


# --- scores ---------------------------------------------------------------------------------------


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """Packed two's complement planes, lowest first: (bits, rows, groups) bytes."""
    low, high = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
    bits = max((~low if low < 0 else low).bit_length(), (~high if high < 0 else high).bit_length()) + 1
    planes = [(vectors >> bit) & 1 for bit in range(bits)]
    return np.stack([np.packbits(p.astype(np.uint8), axis=1, bitorder="little") for p in planes])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """The sums of all subsets of each group of eight dimensions: (groups, 256, anchors)."""
    count, dim = anchors.shape
    groups = -(-dim // GROUP)
    padded = np.zeros((groups * GROUP, count), dtype=anchors.dtype)
    padded[:dim] = anchors.T
    sums = np.zeros((groups, 1 << GROUP, count), dtype=anchors.dtype)
    for group in range(groups):
        for bit in range(GROUP):
            half = 1 << bit
            sums[group, half : 2 * half] = sums[group, :half] + padded[group * GROUP + bit]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of all rows of the planes with all anchors of the tables: (rows, anchors)."""
    total = np.zeros((planes.shape[1], sums.shape[2]), dtype=sums.dtype)
    for place in range(len(planes) - 1, -1, -1):
        total += total
        for group, table in enumerate(sums):
            found = table[planes[place, :, group]]
            total = total - found if place == len(planes) - 1 else np.add(total, found, out=total)
    return total


def exact_type(anchors: np.ndarray, bits: int) -> type:
    """The narrowest type that holds every sum on the way to a score."""
    largest = max((abs(int(v)) for v in (anchors.min(), anchors.max())), default=0) if anchors.size else 0
    need = (largest * max(1, anchors.shape[1])).bit_length() + bits
    return np.int32 if need < 31 else np.int64 if need < 63 else object


# --- packing --------------------------------------------------------------------------------------


def _lists(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, list[dict]]]:
    """Rows by the length of their vectors, up to ``rows`` at a time."""
    held: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            own = held.setdefault(len(r["vector"]), [])
            own.append(r)
            if len(own) >= rows:
                yield len(r["vector"]), held.pop(len(r["vector"]))
    yield from held.items()


def _matrix(rows: list[dict], dim: int) -> np.ndarray:
    return np.array([r["vector"] for r in rows], dtype=np.int64).reshape(len(rows), dim)


def _pack_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for dim, rows in _lists(batches, CHUNK_ROWS):
        planes = bit_planes(_matrix(rows, dim))
        ids, labels = (np.array([r[c] for r in rows], dtype=np.int64).tobytes() for c in ("vec_id", "label"))
        values = [dim, len(planes), ids, labels, planes.tobytes()]
        yield pa.RecordBatch.from_pylist([dict(zip(PACKED_SCHEMA.names, values))], PACKED_SCHEMA)


def _pack_anchors(batches: Iterator[pa.RecordBatch], positives: int) -> Iterator[pa.RecordBatch]:
    """Batches of anchors; ``lows`` and ``highs`` bound the negatives of each positive."""
    for dim, rows in _lists(batches, BATCH_ROWS):
        own = [np.array([r[c] for r in rows], dtype=np.int64).tobytes() for c in ("key", "vec_id", "label")]
        lows = np.zeros((len(rows), positives), dtype=np.int64)
        highs = np.full((len(rows), positives), NO_SCORE)
        for i, r in enumerate(rows):
            for j, (low, high) in enumerate(zip(r.get("lows") or [], r.get("highs") or [])):
                lows[i, j], highs[i, j] = low, high
        name = f"{rows[0]['key']}-{dim}-{len(rows)}"
        values = [name, dim, *own, _matrix(rows, dim).tobytes(), lows.tobytes(), highs.tobytes()]
        yield pa.RecordBatch.from_pylist([dict(zip(BATCH_SCHEMA.names, values))], BATCH_SCHEMA)


class Meeting:
    """A batch of anchors and a chunk of candidates."""

    def __init__(self, r: dict):
        numbers = {c: np.frombuffer(r[c], dtype=np.int64) for c in ("keys", "a_ids", "a_labels", "ids", "labels")}
        self.__dict__.update(numbers)
        count = len(self.keys)
        self.vectors = np.frombuffer(r["vectors"], dtype=np.int64).reshape(count, r["dim"])
        self.lows, self.highs = (np.frombuffer(r[c], dtype=np.int64).reshape(count, -1) for c in ("lows", "highs"))
        groups = -(-r["dim"] // GROUP)
        self.planes = np.frombuffer(r["planes"], dtype=np.uint8).reshape(r["bits"], len(self.ids), groups)
        self.type = exact_type(self.vectors, r["bits"])

    def scored(self, anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each of some anchors with its scores against some rows of the chunk."""
        planes = self.planes[:, rows]
        for start in range(0, len(anchors), STEP):
            some = anchors[start : start + STEP]
            found = scores(subset_sums(self.vectors[some].astype(self.type)), planes)
            yield from zip(some.tolist(), np.ascontiguousarray(found.T))

    def by_label(self) -> Iterator[tuple[int, np.ndarray]]:
        for label in np.unique(self.a_labels):
            yield label, np.flatnonzero(self.a_labels == label)


def best(scored: np.ndarray, ids: np.ndarray, count: int, least: int) -> list[tuple[int, int]]:
    """The first ``count`` different (score, id), from ``least`` on: high scores, then small ids."""
    some = np.flatnonzero(scored >= least)
    if len(some) > 4 * count and scored.dtype != object:
        # Repeated ids count once, so look until enough different ones are found.
        wanted = 4 * count
        while wanted < len(some):
            high = np.partition(scored[some], -wanted)[-wanted]
            top = some[scored[some] >= high]
            if len(np.unique(ids[top])) >= count:
                some = top
                break
            wanted *= 4
    found = sorted({(-int(s), int(i)) for s, i in zip(scored[some], ids[some])})
    return [(-s, i) for s, i in found[:count]]


# --- passes ---------------------------------------------------------------------------------------

HITS = "key long, anchor_id long, positive int, vec_id long, score long"
HITS_SCHEMA = pa.schema([(c, pa.int32() if c == "positive" else pa.int64()) for c in HITS.replace(",", "").split()[::2]])


def _found(batches: Iterator[pa.RecordBatch], count: int, own_label: bool) -> Iterator[pa.RecordBatch]:
    # The lowest score that can still be among an anchor's best, by batch.
    floors: dict[str, np.ndarray] = {}
    for batch in batches:
        for r in batch.to_pylist():
            meeting, hits = Meeting(r), [[] for _ in HITS_SCHEMA]
            slots = 1 if own_label else meeting.lows.shape[1]
            floor = floors.setdefault(r["batch"], np.full((len(meeting.keys), slots), NO_SCORE))
            for label, anchors in meeting.by_label():
                rows = np.flatnonzero((meeting.labels == label) == own_label)
                if not len(rows):
                    continue
                for anchor, found in meeting.scored(anchors, rows):
                    mine = meeting.ids[rows] != meeting.a_ids[anchor]
                    ids, found = meeting.ids[rows][mine], found[mine]
                    for slot in range(slots):
                        some, names, least = found, ids, floor[anchor, slot]
                        if not own_label:
                            low, high = meeting.lows[anchor, slot], meeting.highs[anchor, slot]
                            inside = (found >= max(low, least)) & (found <= high)
                            some, names = found[inside], ids[inside]
                        top = best(some, names, count, least)
                        if len(top) == count:
                            floor[anchor, slot] = max(least, top[-1][0])
                        for score, name in top:
                            values = (meeting.keys[anchor], meeting.a_ids[anchor], slot, name, score)
                            for column, value in zip(hits, values):
                                column.append(int(value))
            columns = [pa.array(c, f.type) for c, f in zip(hits, HITS_SCHEMA)]
            yield pa.RecordBatch.from_arrays(columns, schema=HITS_SCHEMA)


def _meet(asked: DataFrame, packed: DataFrame, groups: int, count: int, own_label: bool) -> DataFrame:
    """Each batch with each chunk; the best of each anchor and slot over all chunks, ranked."""
    asked = asked.withColumnsRenamed({"ids": "a_ids", "labels": "a_labels"})
    copies = F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")
    met = asked.withColumn("_group", F.explode(copies)).join(packed, ["dim", "_group"])
    hits = met.mapInArrow(partial(_found, count=count, own_label=own_label), HITS).distinct()
    order = W.partitionBy("key", "positive").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """Rows of (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, label and embedding. A negative's score s meets
    ``low * positive_score <= 100 * s <= high * positive_score``.
    """
    whole = labelled_vectors(vectors, scale)
    packed = written(whole.mapInArrow(_pack_candidates, PACKED))
    groups = max(1, packed.count())
    packed = packed.withColumn("_group", F.pmod(F.xxhash64("ids", "dim"), F.lit(groups)))
    anchors = whole.filter(is_anchor).distinct()
    anchors = written(anchors.withColumn("key", F.xxhash64("vec_id", "label", "vector")))
    tasks = max(1, -(-anchors.count() // BATCH_ROWS))
    pack = partial(_pack_anchors, positives=positives)

    asked = written(anchors.repartition(tasks, "key").mapInArrow(pack, BATCH))
    chosen = _meet(asked, packed, groups, positives, True)
    chosen = written(chosen.select("key", F.col("vec_id").alias("positive_id"), "score", "rank"))

    # In the order of the positives; scores in between, rounded inwards.
    by_rank = F.array_sort(F.collect_list(F.struct("rank", "score")))
    bounds = chosen.groupBy("key").agg(by_rank.alias("_p"))
    lows = F.transform("_p", lambda p: -_floor_share(-p["score"], low))
    highs = F.transform("_p", lambda p: _floor_share(p["score"], high))
    bounds = bounds.select("key", lows.alias("lows"), highs.alias("highs"))
    asked = written(anchors.join(bounds, "key").repartition(tasks, "key").mapInArrow(pack, BATCH))
    found = _meet(asked, packed, groups, negatives, False)
    positive = chosen.withColumn("positive", F.col("rank") - 1).withColumnRenamed("score", "positive_score")
    return found.join(positive.drop("rank"), ["key", "positive"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _floor_share(score: Column, share: int) -> Column:
    """floor(score * share / 100), exactly."""
    return F.floor(score.cast("decimal(20,0)") * F.lit(share) / F.lit(100)).cast("long")
