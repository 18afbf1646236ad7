"""Exact top-k search by integer inner product, with a pivot table.

Vectors become integers, ``floor(scale * x)``. For a pivot p the distances |q - p| and |x - p| bound
the distance of query and candidate from below, |q - x| >= | |q - p| - |x - p| |, and

    <q, x> = (|q|^2 + |x|^2 - |q - x|^2) / 2

turns the largest lower bound over all pivots into an upper bound on the score. The vectors of a block are
sorted by their nearest pivot and the distance to it and cut into chunks; a chunk has one bound for a query, from
the least and largest distance of its vectors to each pivot. Each query evaluates the chunks of a block in the order of
their bounds, until the next bound lies below its k-th best score; a bound equal to it goes on, because ties
go to the smaller id. All queries that are at the same chunk are scored by one matrix product. The best scores against
the pivots, which are candidates themselves, give the first k-th best.

Spark cuts candidates and queries into blocks of packed vectors with their rows of the pivot table, the
narrowest integers that hold a block. Candidates are dealt to a fixed number of groups, queries to parts of a few
blocks, and a task has one group and one part: the pairs are made in the task, so no copy of the query set is
shuffled or goes through the driver. A task keeps the k best of its queries over all blocks of its group, and only
these leave it, so what is shuffled grows with the queries and not with the pairs. A
window keeps the k best per query; Spark applies its row limit before the shuffle too. The pivots are
a fixed number of vectors.

Defined cases: a vector that is NULL, or holds NULL or a non-finite component, takes no part, neither
does a row without id. Vectors of different lengths never meet. Rows with the query's id are not its
candidates; repeated rows of another id are one candidate each. A query id that is repeated is asked once,
with its smallest vector, number by number. Fewer candidates than k give fewer
rows. Extra columns are ignored. Components must stay below 2^53 when scaled; block products that
doubles cannot hold exactly are computed with Python's integers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from subtide.sources import written

PIVOTS = 16
BLOCK_ROWS = 4096
# Vectors of a block that share one bound.
CHUNK_ROWS = 256
# Groups of candidates, at most, and blocks of queries in a part.
GROUPS = 32
PART_BLOCKS = 4
# Behind every id.
NO_ID = np.iinfo(np.int64).max

BLOCK = "dim int, block string, ids binary, vectors binary, table binary"
BLOCK_SCHEMA = pa.schema(
    [
        ("dim", pa.int32()),
        ("block", pa.string()),
        ("ids", pa.binary()),
        ("vectors", pa.binary()),
        ("table", pa.binary()),
    ]
)
HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Rows of (vec_id, vector array<long>) of all vectors that take part."""
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("_x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long"), doubles.alias("_x"))
        .filter(F.col("vec_id").isNotNull() & F.col("_x").isNotNull() & ~bad)
        .select("vec_id", F.transform("_x", lambda x: F.floor(x * scale)).alias("vector"))
    )


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table: one row per vector, one distance per pivot."""
    a, b = vectors.astype(np.float64), pivots.astype(np.float64)
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def narrowest(vectors: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    low, high = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
    types = (np.int8, np.int16, np.int32, np.int64)
    return vectors.astype(next(t for t in types if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, for each length of its vectors."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield ids[rows], flat[starts[rows][:, None] + np.arange(dim)]


def _pack(
    batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray], rows: int
) -> Iterator[pa.RecordBatch]:
    """Blocks of up to ``rows`` vectors of one length, with their rows of the pivot table."""
    held: dict[int, list] = {}

    def blocks(dim: int, least: int) -> Iterator[pa.RecordBatch]:
        """Takes blocks off what is held, as long as that is ``least`` rows or more."""
        keys, vectors = (np.concatenate(x) for x in zip(*held.pop(dim)))
        while len(keys) >= least:
            known = distances(vectors[:rows], pivots[dim])
            order = np.lexsort((known.min(1), known.argmin(1)))
            own = narrowest(vectors[:rows][order])
            columns = [keys[:rows][order].tobytes(), own.tobytes(), known[order].tobytes()]
            values = [dim, uuid.uuid4().hex, *columns]
            yield pa.RecordBatch.from_pylist([dict(zip(BLOCK_SCHEMA.names, values))], BLOCK_SCHEMA)
            keys, vectors = keys[rows:], vectors[rows:]
        if len(keys):
            held[dim] = [(keys.copy(), vectors.copy())]

    for batch in batches:
        for keys, vectors in _by_length(batch):
            own = held.setdefault(dim := vectors.shape[1], [])
            own.append((keys, vectors))
            if sum(len(k) for k, _ in own) >= rows:
                yield from blocks(dim, rows)
    for dim in list(held):
        yield from blocks(dim, 1)


class Vectors:
    """Integer vectors with what exact inner products need, worked out once."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        doubles = vectors.astype(np.float64)
        self.norms = (doubles**2).sum(1)
        self.longest = float(np.sqrt(self.norms.max(initial=0.0)))
        self._typed: dict[type, np.ndarray] = {}

    def typed(self, kind: type) -> np.ndarray:
        if kind not in self._typed:
            self._typed[kind] = self.vectors.astype(kind)
        return self._typed[kind]


class Block(Vectors):
    """A packed block, and for each of its chunks the range of the distances to each pivot."""

    def __init__(self, dim: int, ids: bytes, vectors: bytes, table: bytes):
        keys = np.frombuffer(ids, dtype=np.int64).copy()
        width = len(vectors) // (len(keys) * dim) if dim else 8
        whole = np.frombuffer(vectors, dtype=f"i{width}").reshape(len(keys), dim)
        super().__init__(keys, whole.copy())
        self.table = np.frombuffer(table).reshape(len(keys), -1).copy()
        self.starts = np.arange(0, len(keys), CHUNK_ROWS)
        self.low = np.minimum.reduceat(self.table, self.starts)
        self.high = np.maximum.reduceat(self.table, self.starts)
        self.most = np.maximum.reduceat(self.norms, self.starts)


def products(queries: Vectors, rows: int | np.ndarray, block: Vectors, some: slice | np.ndarray) -> np.ndarray:
    """Exact inner products of one query or several with some vectors.

    Sums on the way to a product are integers up to the product of both lengths, so floating point is exact where that
    is small enough; otherwise Python's integers are used.
    """
    most = queries.longest * block.longest * (1 + 1e-9)
    kind = np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else object
    return queries.typed(kind)[rows] @ block.typed(kind)[some].T


def below(scores: np.ndarray) -> np.ndarray:
    """Doubles that are not above the scores."""
    if scores.dtype != object:
        return scores.astype(np.float64)
    return np.nextafter(scores.astype(np.float64), -np.inf)


class Asked(Block):
    """A block of queries, and the k best that were found for each."""

    def __init__(self, dim: int, ids: bytes, vectors: bytes, table: bytes, k: int, pivots: Vectors):
        super().__init__(dim, ids, vectors, table)
        self.scores = np.full((len(self.ids), k), -np.inf)
        self.found = np.full((len(self.ids), k), NO_ID)
        # Of each query, a score that its k-th best reaches.
        self.floors = np.full(len(self.ids), -np.inf)
        known = below(products(self, np.arange(len(self.ids)), pivots, slice(None)))
        known[self.ids[:, None] == pivots.ids] = -np.inf
        if known.shape[1] >= k:
            self.floors = np.sort(known, axis=1)[:, -k]

    def keep(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Takes in scored candidates, as one row number of this block, score and id each."""
        if object in (scores.dtype, self.scores.dtype):
            scores, self.scores = scores.astype(object), self.scores.astype(object)
        k = self.scores.shape[1]
        own, place = np.unique(rows, return_inverse=True)
        places = np.concatenate([np.repeat(np.arange(len(own)), k), place])
        scores = np.concatenate([self.scores[own].ravel(), scores])
        ids = np.concatenate([self.found[own].ravel(), ids])
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda i: (places[i], -scores[i], ids[i])), dtype=np.int64)
        else:
            order = np.lexsort((ids, -scores, places))
        first = order[np.searchsorted(places[order], np.arange(len(own)))[:, None] + np.arange(k)]
        self.scores[own], self.found[own] = scores[first], ids[first]
        self.floors[own] = np.maximum(self.floors[own], below(self.scores[own, -1]))

    def hits(self) -> pa.RecordBatch:
        rows, places = np.nonzero(self.scores > -np.inf)
        columns = [self.ids[rows], self.found[rows, places], [int(s) for s in self.scores[rows, places]]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=HITS)


def upper_bounds(queries: Block, block: Block) -> np.ndarray:
    """Scores that no vector of a chunk exceeds: one row per query, one column per chunk."""
    gaps = np.zeros((len(queries.ids), len(block.starts)))
    for known, low, high in zip(queries.table.T[:, :, None], block.low.T, block.high.T):
        # The distances are rounded.
        gap = np.maximum(low - known, known - high) - 1e-13 * (known + high)
        np.maximum(gaps, gap, out=gaps)
    norms = queries.norms[:, None] + block.most
    # A little above the bound, for the same reason.
    return (norms - gaps * gaps) / 2 + 1e-6 * norms + 0.5


def scored(queries: Asked, rows: np.ndarray, block: Block, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of a chunk that are among the k best so far, as (row, score, id), for some queries."""
    some = slice(block.starts[chunk], block.starts[chunk] + CHUNK_ROWS)
    scores, ids, k = products(queries, rows, block, some), block.ids[some], queries.scores.shape[1]
    floors = queries.floors[rows].astype(scores.dtype)
    at = np.flatnonzero(scores >= floors[:, None])
    if len(at) > 4 * k * len(rows) and len(ids) > k and scores.dtype != object:
        others = np.where(ids == queries.ids[rows][:, None], -np.inf, scores)
        floors = np.maximum(floors, np.partition(others, -k, axis=1)[:, -k])
        at = np.flatnonzero(scores >= floors[:, None])
    place, column = np.divmod(at, len(ids))
    rows, scores, ids = rows[place], scores[place, column], ids[column]
    last, last_id = queries.scores[rows, -1], queries.found[rows, -1]
    better = (ids != queries.ids[rows]) & ((scores > last) | ((scores == last) & (ids < last_id))).astype(bool)
    return rows[better], scores[better].astype(object if scores.dtype == object else np.float64), ids[better]


def search(queries: Asked, block: Block) -> None:
    """Takes the best of the block into the queries' k best."""
    bounds = upper_bounds(queries, block)
    order = np.argsort(-bounds, axis=1, kind="stable")
    for chunks, bound in zip(order.T, np.take_along_axis(bounds, order, axis=1).T):
        active = np.flatnonzero(bound >= queries.floors)
        if not len(active):
            break
        at = chunks[active]
        found = [scored(queries, active[at == chunk], block, chunk) for chunk in np.unique(at)]
        rows, scores, ids = (np.concatenate(x) for x in zip(*found))
        if len(rows):
            queries.keep(rows, scores, ids)


def _search(batches: Iterator[pa.RecordBatch], k: int, pivots: dict) -> Iterator[pa.RecordBatch]:
    asked: dict[str, Asked] = {}
    name, block = None, None
    for batch in batches:
        for i in range(batch.num_rows):

            def parts(prefix: str = "") -> list:
                return [batch.column(f"{prefix}{c}")[i].as_buffer() for c in ("ids", "vectors", "table")]

            dim, own, other = (batch.column(c)[i].as_py() for c in ("dim", "block", "q_block"))
            if own != name:
                name, block = own, Block(dim, *parts())
            if other not in asked:
                asked[other] = Asked(dim, *parts("q_"), k, pivots[dim])
            search(asked[other], block)
    for queries in asked.values():
        yield queries.hits()


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """Rows of (query_id, rank, vec_id, score) for the rows that meet the condition ``is_query``."""
    whole = integer_vectors(vectors, scale)
    # The pivots of each length: the vectors first by hash, so spread over the whole table.
    first = W.partitionBy("_dim").orderBy("_hash", "vec_id")
    ranked = whole.withColumn("_dim", F.size("vector")).withColumn("_hash", F.xxhash64("vec_id", "vector"))
    chosen = ranked.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= PIVOTS)
    found: dict[int, list] = {}
    for row in chosen.select("_dim", "vec_id", "vector").collect():
        found.setdefault(row["_dim"], []).append((row["vec_id"], row["vector"]))
    pivots = {
        dim: Vectors(
            np.array([key for key, _ in rows], dtype=np.int64),
            np.array([v for _, v in rows], dtype=np.int64).reshape(len(rows), dim),
        )
        for dim, rows in found.items()
    }
    tables = {dim: known.vectors for dim, known in pivots.items()}
    packed = written(whole.mapInArrow(partial(_pack, pivots=tables, rows=BLOCK_ROWS), BLOCK))
    queries = written(whole.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")))
    tasks = max(1, -(-queries.count() // BLOCK_ROWS))
    dealt = queries.repartition(tasks)
    asked = written(dealt.mapInArrow(partial(_pack, pivots=tables, rows=BLOCK_ROWS), BLOCK))
    # The query set meets every block: each task reads one group of blocks and one part of the queries.
    packed = packed.repartition(max(1, min(GROUPS, packed.count())))
    asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in BLOCK_SCHEMA.names])
    asked = asked.repartition(-(-tasks // PART_BLOCKS)).hint("shuffle_replicate_nl")
    met = packed.join(asked, F.col("dim") == F.col("q_dim"))
    found = partial(_search, k=k, pivots=pivots)
    hits = met.mapInArrow(found, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "vec_id", "score")
