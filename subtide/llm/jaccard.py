"""Exact Jaccard join of documents by word shingles, as a join in a metric space.

A document is its set of distinct 4-word shingles; d = 1 - |x & y| / |x | y| is a metric. Documents
with d <= TAU link. The result is the component of each document, with no link lost.

Almost all pairs of unrelated texts lie at distance 1 from each other. Around document pivots alone,
every document would then be a boundary document of every region. So regions are made in two steps:

1. Pivots are single shingles, the rarest first in one global order. Each document lies at its
   smallest distance, 1 - 1/n, from those it holds. A linked document misses at most n - 0.85 n of
   them, so a window of floor(0.15 n) + 1 pivots reaches every linked document: it is replicated to
   the regions of these pivots. A shingle that no other document holds makes no region, and a document
   with more such shingles than the window lets be missed has no link at all. Regions that share a
   document join into a cell.
2. In a cell pivots are documents. With p as pivot the others fall into the near (d <= TAU), the
   boundary (d <= 2 TAU) and the far. By the triangle inequality a near one can link with the near and
   the boundary only, and a boundary one only with the near whose distance to p differs from its own
   by at most TAU. Links inside the near part join what p joins already. So only boundary documents
   not joined yet meet the near part, within that window, and boundary and far recurse with the next
   pivot until all are joined or have been a pivot. A pivot does not look at a whole cell: two linked
   documents hold the same shingles in one of D + 1 parts of the hash space if they differ in at most D
   (see ``Parts``), so only documents with an equal part are looked at. Templated texts share many
   shingles and end in one cell, but seldom a whole part.

Cells beyond ``BLOCK`` shingles are cut into blocks by hash, and each block is joined by itself. What is
left are links between components. Equal parts say where they can be: one pair of each component, with the
component that shares most parts with it, is compared first, which joins the pieces of a family cut by the
blocks. Then only parts held by sets of several components matter. Where the sets that hold one have fewer
shingles in all, these parts are the next regions and are joined like cells; texts of a template have
hardly any. Elsewhere the documents outside of their cell's largest component meet all blocks: pairs inside
that component need no look, all others have one side in a block of the former. Both ways are exact, and
the cheaper one is taken cell by cell.

Scale: equal sets are one class, found by a digest. A first pass counts, in packed hashes of a third of
the shingle space, the shingles no other set holds: more than 0.15 n of them prove that a document
has no link, and only the others go on. A shingle travels once per packed chunk, however many
documents hold it, so hot shingles weigh as little as others. No step lists all pairs of a group: a
region's edges form a star, and blocks give a spanning forest of links.

Hashes have 64 bits: sets are equal, and shingles are equal, up to collisions of these.

Defined cases: NULL, empty and blank texts have no shingles and link with nothing, not with each
other. With fewer than four words the whole sequence is one shingle. Repeated rows link with each
other. A NULL doc_id is never a component_id unless nothing else is there. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from subtide.llm.components import components
from subtide.llm.common import trimming
from subtide.sources import written

SIZE = 4
SIMILAR = (85, 100)

CHUNK = 2_000_000  # shingles in a packed chunk of the first pass
BUNDLE = 500_000  # shingles in a bundle of sets
SLICE = 2_000_000  # hashes in a slice, on average
BLOCK = 2_000_000  # shingles in a block of a cell
PART = 86  # of 256 parts of the shingle space, those that the first pass looks at

MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = pc.not_equal(flat, "")
    owner = owner[real.to_numpy(zero_copy_only=False)]
    coded = flat.filter(real).dictionary_encode()
    known = coded.dictionary.cast(pa.binary()).to_pylist()
    digests = np.array([xxhash.xxh64_intdigest(w) for w in known], dtype=np.uint64)
    words = digests[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.uint64)
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    rolled = words[: max(0, len(words) - size + 1)].copy()
    for k in range(1, size):
        rolled = rolled * STEP + words[k : k + len(rolled)]
    rolled = _mixed(rolled)
    out, start = [], 0
    for end in ends.tolist():
        if end - start >= size:
            out.append(np.unique(rolled[start : end - size + 1]))
        elif end > start:
            short = np.full(1, end - start, dtype=np.uint64)
            for word in words[start:end]:
                short = short * STEP + word
            out.append(_mixed(short))
        else:
            out.append(np.zeros(0, np.uint64))
        start = end
    return out


def set_key(shingles: np.ndarray) -> int:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


@trimming
def _profile(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(batch.column("text"), size)
        counts = pa.array([len(s) for s in sets], pa.int64())
        keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
        rest = batch.drop_columns(["text"])
        arrays = [*rest.columns, counts, keys]
        yield pa.RecordBatch.from_arrays(arrays, [*rest.schema.names, "n_shingles", "key"])


# --- which documents can have a link at all ---------------------------------------------------

POSTED = pa.schema(
    [
        ("slice", pa.int32()),
        ("chunk", pa.string()),
        ("hashes", pa.binary()),
        ("owners", pa.binary()),
        ("keys", pa.binary()),
        ("sizes", pa.binary()),
    ]
)
ALONE = pa.schema(
    [("chunk", pa.string()), ("alone", pa.binary()), ("keys", pa.binary()), ("sizes", pa.binary())]
)
SHARED = 0xFFFF  # owner of a hash that several documents of the chunk hold


def planes(values: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as differences, byte by byte, which compresses well."""
    steps = np.diff(values, prepend=values.dtype.type(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    bytewise = np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(bytewise).view("<u4").ravel(), dtype=np.uint32)


def cut(ordered: np.ndarray, slices: int) -> np.ndarray:
    """Where each slice of the hash space begins in ascending hashes, and the end."""
    bounds = np.array([(i << 64) // slices for i in range(slices)], dtype=np.uint64)
    return np.append(np.searchsorted(ordered, bounds), len(ordered))


def low_bits(ordered: np.ndarray, slice_: int, slices: int) -> np.ndarray:
    """Hashes of one slice as ascending 32-bit numbers."""
    begin = np.uint64((slice_ << 64) // slices)
    width = (1 << 64) // slices
    return ((ordered - begin) >> np.uint64(max(0, width.bit_length() - 32))).astype(np.uint32)


def _chunk_rows(name: str, sets: dict[int, np.ndarray], full: list[int], slices: int) -> Iterator[dict]:
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets.values()])
    hashes = np.concatenate([*sets.values(), np.zeros(0, np.uint64)])
    order = np.argsort(hashes)
    hashes, owners = hashes[order], owners[order]
    first = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
    several = np.append(first[1:], True)[: len(hashes)] == False  # noqa: E712
    hashes, owners = hashes[first], np.where(several, SHARED, owners)[first]
    at = cut(hashes, slices)
    for s in range(slices):
        if at[s] < at[s + 1]:
            low = low_bits(hashes[at[s] : at[s + 1]], s, slices)
            own = owners[at[s] : at[s + 1]].astype("<u2")
            yield {"slice": s, "chunk": name, "hashes": planes(low), "owners": own.tobytes()}
    keys = np.array(list(sets), dtype=np.int64).tobytes()
    sizes = np.array(full, dtype=np.int64).tobytes()
    yield {"slice": xxhash.xxh32_intdigest(name) % slices, "chunk": name, "keys": keys, "sizes": sizes}


@trimming
def _post(batches: Iterator[pa.RecordBatch], size: int, slices: int) -> Iterator[pa.RecordBatch]:
    """The part of the shingle space looked at, in packed chunks cut into slices."""
    task, number = TaskContext.get().partitionId(), 0
    sets: dict[int, np.ndarray] = {}
    full: list[int] = []
    held = 0
    for batch in batches:
        for shingles in shingle_sets(batch.column("text"), size):
            if not len(shingles):
                continue
            key = set_key(shingles)
            if key not in sets:
                some = shingles[(shingles & np.uint64(0xFF)) < PART]
                sets[key] = some
                full.append(len(shingles))
                held += len(some)
            if held >= CHUNK or len(sets) >= SHARED:
                rows = list(_chunk_rows(f"{task}-{number}", sets, full, slices))
                yield from (pa.RecordBatch.from_pylist([r], POSTED) for r in rows)
                sets, full, held, number = {}, [], 0, number + 1
    if sets:
        rows = list(_chunk_rows(f"{task}-{number}", sets, full, slices))
        yield from (pa.RecordBatch.from_pylist([r], POSTED) for r in rows)


def _count_alone(rows: pa.Table) -> pa.Table:
    """Per chunk of a slice: how many hashes of each document no other document holds."""
    found = rows.to_pylist()
    posted = [r for r in found if r["hashes"] is not None]
    out = [{"chunk": r["chunk"], "keys": r["keys"], "sizes": r["sizes"]} for r in found if r["keys"] is not None]
    if posted:
        parts = [from_planes(r["hashes"]) for r in posted]
        hashes = np.concatenate(parts)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        same = ordered[1:] == ordered[:-1]
        single = np.ones(len(hashes), dtype=bool)
        single[order[1:][same]] = False
        single[order[:-1][same]] = False
        start = 0
        for r, part in zip(posted, parts):
            own = np.frombuffer(r["owners"], dtype="<u2")
            alone = own[single[start : start + len(part)] & (own != SHARED)]
            counts = np.bincount(alone).astype("<u4")
            out.append({"chunk": r["chunk"], "alone": counts.tobytes()})
            start += len(part)
    return pa.Table.from_pylist(out, ALONE)


def _linkable(rows: pa.Table, similar: tuple[int, int]) -> pa.Table:
    """The keys of one chunk's documents that may have a link."""
    found = rows.to_pylist()
    head = next(r for r in found if r["keys"] is not None)
    keys = np.frombuffer(head["keys"], dtype=np.int64)
    sizes = np.frombuffer(head["sizes"], dtype=np.int64)
    alone = np.zeros(len(keys), dtype=np.int64)
    for r in found:
        if r["alone"] is not None:
            counts = np.frombuffer(r["alone"], dtype="<u4")
            alone[: len(counts)] += counts
    return pa.table({"key": keys[alone <= missable(sizes, similar)]})


def missable(sizes: np.ndarray, similar: tuple[int, int] = SIMILAR) -> np.ndarray:
    """How many shingles of a set a linked set can be without: n - ceil(0.85 n)."""
    return sizes - -(-sizes * similar[0] // similar[1])


# --- regions of shingle pivots ------------------------------------------------------------------

BUNDLED = pa.schema(
    [("chunk", pa.string()), ("keys", pa.binary()), ("sizes", pa.binary()), ("hashes", pa.binary())]
)
COUNTED = pa.schema(
    [("slice", pa.int32()), ("chunk", pa.string()), ("hashes", pa.binary()), ("counts", pa.binary())]
)
ANSWER = pa.schema([("chunk", pa.string()), ("slice", pa.int32()), ("counts", pa.binary())])


@trimming
def _bundle(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sets as rows of bounded bundles."""
    task, number, held = TaskContext.get().partitionId(), 0, 0
    sets: dict[int, np.ndarray] = {}

    def row() -> pa.RecordBatch:
        values = [
            f"{task}-{number}",
            np.array(list(sets), dtype=np.int64).tobytes(),
            np.array([len(s) for s in sets.values()], dtype=np.int64).tobytes(),
            np.concatenate(list(sets.values())).tobytes(),
        ]
        return pa.RecordBatch.from_pylist([dict(zip(BUNDLED.names, values))], BUNDLED)

    for batch in batches:
        for shingles in shingle_sets(batch.column("text"), size):
            if len(shingles):
                sets[set_key(shingles)] = shingles
                held += len(shingles)
            if held >= BUNDLE:
                yield row()
                sets, number, held = {}, number + 1, 0
    if sets:
        yield row()


@trimming
def _count_bundle(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("hashes").to_pylist()):
            hashes, counts = np.unique(np.frombuffer(data, dtype=np.uint64), return_counts=True)
            at = cut(hashes, slices)
            for s in range(slices):
                if at[s] < at[s + 1]:
                    low = low_bits(hashes[at[s] : at[s + 1]], s, slices)
                    own = np.minimum(counts[at[s] : at[s + 1]], 255).astype(np.uint8)
                    row = {"slice": s, "chunk": chunk, "hashes": planes(low), "counts": own.tobytes()}
                    yield pa.RecordBatch.from_pylist([row], COUNTED)


def _total(rows: pa.Table) -> pa.Table:
    """For each bundle of a slice, in how many sets each of its hashes is; 255 stands for more."""
    found = rows.to_pylist()
    parts = [from_planes(r["hashes"]) for r in found]
    counts = np.concatenate([np.frombuffer(r["counts"], dtype=np.uint8) for r in found])
    known, at = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.minimum(np.bincount(at, weights=counts), 255).astype(np.uint8)[at]
    out, start = [], 0
    for r, part in zip(found, parts):
        own = total[start : start + len(part)].tobytes()
        out.append({"chunk": r["chunk"], "slice": r["slice"], "counts": own})
        start += len(part)
    return pa.Table.from_pylist(out, ANSWER)


def _window(bundles: pa.Table, answers: pa.Table, similar: tuple[int, int]) -> pa.Table:
    """The pivots of each set's window that another set holds too, as (pivot, key)."""
    pivots, keys = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if bundles.num_rows and answers.num_rows:
        b = bundles.to_pylist()[0]
        hashes = np.frombuffer(b["hashes"], dtype=np.uint64)
        counts = b"".join(a["counts"] for a in sorted(answers.to_pylist(), key=lambda a: a["slice"]))
        known, at = np.unique(hashes, return_inverse=True)
        held = np.frombuffer(counts, dtype=np.uint8)[at]
        sizes = np.frombuffer(b["sizes"], dtype=np.int64)
        start = 0
        for key, size, most in zip(np.frombuffer(b["keys"], np.int64), sizes, missable(sizes, similar) + 1):
            own, own_held = hashes[start : start + size], held[start : start + size]
            start += size
            if np.count_nonzero(own_held == 1) < most:
                window = np.lexsort((own, own_held))[:most]
                window = window[own_held[window] > 1]
                pivots.append(own[window])
                keys.append(np.full(len(window), key))
    return pa.table({"pivot": np.concatenate(pivots).view(np.int64), "key": np.concatenate(keys)})


# --- cells --------------------------------------------------------------------------------------

SETS = "key long, n long, shingles binary"
LINKS = "a long, b long"


@trimming
def _unbundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in batch.to_pylist():
            sizes = np.frombuffer(b["sizes"], dtype=np.int64)
            ends = np.cumsum(sizes) * 8
            parts = [b["hashes"][e - 8 * n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
            keys = pa.array(np.frombuffer(b["keys"], dtype=np.int64))
            arrays = [keys, pa.array(sizes), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "n", "shingles"])


class Joined:
    """Which members of a block are joined: the smallest member of each one's component."""

    def __init__(self, count: int):
        self.root = np.arange(count)

    def join(self, i: int, j: int) -> bool:
        a, b = sorted((self.root[i], self.root[j]))
        if a != b:
            self.root[self.root == b] = a
        return a != b

    def all_one(self, members: np.ndarray) -> bool:
        return bool((self.root[members] == self.root[members[0]]).all())


class Members:
    """Sets of a block, with the sizes of intersections of one set with others."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        known, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(flat, np.cumsum(self.sizes)[:-1])
        self.mark = np.zeros(len(known), dtype=bool)

    def common(self, one: int, others: np.ndarray) -> np.ndarray:
        self.mark[self.sets[one]] = True
        flat = self.mark[np.concatenate([self.sets[i] for i in others])]
        self.mark[self.sets[one]] = False
        sizes = self.sizes[others]
        return np.add.reduceat(flat, np.cumsum(sizes) - sizes, dtype=np.int64)

    def union(self, one: int, others: np.ndarray, common: np.ndarray) -> np.ndarray:
        return self.sizes[one] + self.sizes[others] - common


def linked(common: np.ndarray, union: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    return similar[1] * common >= similar[0] * union


def part_names(sets: list[np.ndarray], similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The names of the parts of each set, and which set each belongs to.

    Linked sets x and y differ in at most D = (of - share) / share * min(|x|, |y|) shingles. Cut the space of
    hashes into D + 1 parts: in one part at least both hold the same shingles, or none. Sets of similar sizes
    use the same cut: a size class ends where linked sets cannot reach beyond the next class, so a set has
    parts for its own class and for the one below. Linked sets have a name in common.
    """
    share, of = similar
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    # ends[c]: the first size beyond class c.
    ends = [2]
    while ends[-1] <= sizes.max(initial=1):
        ends.append(max(ends[-1] + 1, ends[-1] * of // share + 1))
    kind = np.searchsorted(np.array(ends), sizes, side="right")
    names, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for level in np.unique(np.concatenate([kind, kind - 1])):
        if level < 0:
            continue
        some = np.flatnonzero((kind == level) | (kind == level + 1))
        count = (of - share) * (ends[level] - 1) // share + 1
        flat = _mixed(np.concatenate([sets[i] for i in some]))
        slot = np.repeat(np.arange(len(some)) * count, sizes[some])
        slot += (_mixed(flat + STEP) % np.uint64(count)).astype(np.int64)
        sums = np.zeros(len(some) * count, dtype=np.uint64)
        np.add.at(sums, slot, flat)
        part = np.tile(np.arange(count, dtype=np.uint64), len(some))
        names.append(_mixed(sums + part * MIX + np.uint64(int(level) * int(STEP) % 2**64)))
        owners.append(np.repeat(some, count))
    return np.concatenate(names), np.concatenate(owners)


class Parts:
    """Which sets may link at all: those with an equal part.

    Sets with an equal part form a group; a set's partners are the members of its groups. Without a common
    part there is no link, so nothing is lost.
    """

    def __init__(self, sets: list[np.ndarray], similar: tuple[int, int]):
        names, owner = part_names(sets, similar)
        _, group, held = np.unique(names, return_inverse=True, return_counts=True)
        kept = held[group] > 1
        group, owner = group[kept], owner[kept]
        by_group, by_owner = np.argsort(group, kind="stable"), np.argsort(owner, kind="stable")
        self.members, self.groups = owner[by_group], group[by_owner]
        self.group_at = np.searchsorted(group[by_group], np.arange(len(held) + 1))
        self.owner_at = np.searchsorted(owner[by_owner], np.arange(len(sets) + 1))

    def partners(self, some: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The wanted sets, by a mask, that share a group with one of some sets."""
        own = [self.groups[self.owner_at[i] : self.owner_at[i + 1]] for i in some]
        own = np.unique(np.concatenate(own)) if len(own) > 1 else own[0]
        found = [self.members[self.group_at[g] : self.group_at[g + 1]] for g in own]
        if not found:
            return np.zeros(0, dtype=np.int64)
        found = np.unique(np.concatenate(found))
        return found[wanted[found]]


def join_block(sets: list[np.ndarray], similar: tuple[int, int] = SIMILAR) -> list[tuple[int, int]]:
    """Links that join all linked members of a block: a spanning forest, by recursion over pivots.

    A pivot looks at its partners only, and the boundary of its near part at the partners of that.
    """
    tau = 1 - similar[0] / similar[1] + 1e-9
    members, joined, parts = Members(sets), Joined(len(sets)), Parts(sets, similar)
    links: list[tuple[int, int]] = []
    rest = np.ones(len(sets), dtype=bool)
    for pivot in range(len(sets)):
        if not rest[pivot]:
            continue
        rest[pivot] = False
        others = parts.partners(np.array([pivot]), rest)
        if not len(others):
            continue
        common = members.common(pivot, others)
        union = members.union(pivot, others, common)
        near = linked(common, union, similar)
        if not near.any():
            continue
        inner, inner_distance = others[near], (1 - common / union)[near]
        for i in inner[joined.root[inner] != joined.root[pivot]]:
            if joined.join(pivot, i):
                links.append((pivot, i))
        rest[inner] = False
        outer = parts.partners(inner, rest)
        if not len(outer):
            continue
        common = members.common(pivot, outer)
        distance = 1 - common / members.union(pivot, outer, common)
        for z in np.flatnonzero(distance <= 2 * tau):
            if joined.root[outer[z]] != joined.root[pivot]:
                window = inner[np.abs(inner_distance - distance[z]) <= tau]
                if len(window):
                    both = members.common(outer[z], window)
                    hit = linked(both, members.union(outer[z], window, both), similar)
                    if hit.any():
                        joined.join(outer[z], pivot)
                        links.append((outer[z], window[hit.argmax()]))
    return links


def _runs(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of sorted partitions, group by group."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[g] for g in group)
            if own != at and held:
                yield at, held
                held = []
            at = own
            held.append(row)
    if held:
        yield at, held


def _as_links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _set(row: dict) -> np.ndarray:
    return np.frombuffer(row["shingles"], dtype=np.uint64)


@trimming
def _join_blocks(batches: Iterator[pa.RecordBatch], similar: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int]] = []
    for _, rows in _runs(batches, ["cell", "block"]):
        rows = list({r["key"]: r for r in rows}.values())
        if len(rows) > 1:
            links = join_block([_set(r) for r in rows], similar)
            found += [(rows[a]["key"], rows[b]["key"]) for a, b in links]
        if len(found) >= 10_000:
            yield _as_links(found)
            found = []
    yield _as_links(found)


@trimming
def _meet_blocks(batches: Iterator[pa.RecordBatch], similar: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Each of a block's outsiders against each member of another block of the cell."""
    for _, rows in _runs(batches, ["cell", "outside", "block"]):
        outside = [r for r in rows if r["asks"]]
        inside = [r for r in rows if not r["asks"]]
        if not outside or not inside:
            continue
        both = outside + inside
        sets = [_set(r) for r in both]
        members, joined, parts = Members(sets), Joined(len(both)), Parts(sets, similar)
        roots = np.array([r["root"] for r in both])
        asked = np.arange(len(both)) >= len(outside)
        found = []
        for i in range(len(outside)):
            others = parts.partners(np.array([i]), asked)
            others = others[roots[others] != roots[i]]
            if len(others):
                common = members.common(i, others)
                for j in others[linked(common, members.union(i, others, common), similar)]:
                    if joined.join(i, j):
                        found.append((both[i]["key"], both[j]["key"]))
        yield _as_links(found)


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


NAMED = pa.schema([("cell", pa.int64()), ("name", pa.int64()), ("key", pa.int64()), ("n", pa.int64())])


@trimming
def _name_parts(batches: Iterator[pa.RecordBatch], similar: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """The names of each set's parts in its cell."""
    for batch in batches:
        if batch.num_rows:
            sets = [np.frombuffer(b, dtype=np.uint64) for b in batch.column("shingles").to_pylist()]
            names, owner = part_names(sets, similar)
            cell, key, n = (batch.column(c).to_numpy()[owner] for c in ("cell", "key", "n"))
            names = _mixed(names + _mixed(cell.view(np.uint64)))
            arrays = [pa.array(x) for x in (cell, names.view(np.int64), key, n)]
            yield pa.RecordBatch.from_arrays(arrays, schema=NAMED)


@trimming
def _check_pairs(batches: Iterator[pa.RecordBatch], similar: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """The pairs of sets that link."""
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            x, y = (np.frombuffer(r[c], dtype=np.uint64) for c in ("one", "other"))
            common = len(np.intersect1d(x, y, assume_unique=True))
            if linked(common, len(x) + len(y) - common, similar):
                found.append((r["a"], r["b"]))
        yield _as_links(found)


def _rooted_by(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of sets with the smallest key of the component that the links give."""
    roots = components(links).withColumnRenamed("node", "key")
    return rows.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))


def _divided(named: DataFrame) -> DataFrame:
    """The parts that sets of several components hold, with the smallest root of each."""
    several = named.groupBy("name").agg(F.min("root").alias("least"), F.max("root").alias("_most"))
    several = written(several.filter("least <> _most").select("name", "least"))
    return named.join(several, "name")


def _likely_links(sets: DataFrame, divided: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links among one pair of each component: with the component it shares most parts with.

    Of a part's components the one with the smallest root is the centre, and the others pair with it.
    """
    each = divided.groupBy("name", "least", "root").agg(F.min("key").alias("b"))
    centre = each.filter("root = least").select("name", F.col("b").alias("a"))
    met = each.filter("root <> least").join(centre, "name")
    pairs = met.groupBy("least", "root").agg(F.count("*").alias("parts"), F.min(F.struct("a", "b")).alias("pair"))
    best = pairs.groupBy("root").agg(F.max_by("pair", F.struct("parts", "pair")).alias("pair"))
    best = written(best.select("pair.a", "pair.b"))
    one = sets.select(F.col("key").alias("a"), F.col("shingles").alias("one"))
    other = sets.select(F.col("key").alias("b"), F.col("shingles").alias("other"))
    both = best.join(one, "a").join(other, "b")
    return both.mapInArrow(partial(_check_pairs, similar=similar), LINKS)


def _join_cells(
    sets: DataFrame, cells: DataFrame, similar: tuple[int, int], by_parts: bool = True
) -> DataFrame:
    """Links (a, b) that join all linked sets of each cell. A set may be in several cells."""
    placed = sets.join(cells.withColumnsRenamed({"node": "key", "root": "cell"}), "key")
    placed = written(placed)
    weights = placed.groupBy("cell").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    large = written(weights.filter("blocks > 1"))
    blocked = placed.join(large, "cell", "left").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.coalesce("blocks", F.lit(1)))
    )
    group = ["cell", "block"]
    dealt = blocked.drop("blocks").repartition(_tasks(sets), *group).sortWithinPartitions(*group)
    links = written(dealt.mapInArrow(partial(_join_blocks, similar=similar), LINKS))
    if large.isEmpty():
        return links
    known = blocked.filter("blocks is not null")
    if not by_parts:
        return links.unionAll(_join_across_blocks(written(_rooted_by(known, links)), similar))
    named = known.select("cell", "key", "n", "shingles").mapInArrow(
        partial(_name_parts, similar=similar), "cell long, name long, key long, n long"
    )
    named = written(named)
    likely = _likely_links(known, _divided(written(_rooted_by(named, links))), similar)
    links = written(links.unionAll(likely))
    known = written(_rooted_by(known, links))
    regions = written(_divided(known.select("cell", "key", "root").join(named, ["cell", "key"])))
    # The shingles that either way compares: per cell, all sets of its regions, or outsiders and blocks.
    fine = regions.groupBy("cell").agg(F.sum("n").alias("by_parts"))
    coarse = _outsiders(known).groupBy("cell").agg(F.sum("n").alias("asking"))
    total = known.groupBy("cell", "blocks").agg(F.sum("n").alias("total"))
    costs = total.join(coarse, "cell").join(fine, "cell")
    by_blocks = F.ceil(F.col("asking") / BLOCK) * F.col("total") + F.col("blocks") * F.col("asking")
    costs = written(costs.select("cell", (F.col("by_parts") <= by_blocks).alias("fine")))
    regions = regions.join(costs.filter("fine"), "cell")
    regions = written(regions.select(F.col("key").alias("node"), F.col("name").alias("root")).distinct())
    found = _join_cells(known.select("key", "n", "shingles"), regions, similar, by_parts=False)
    whole = known.join(costs.filter("not fine").select("cell"), "cell", "left_semi")
    return links.unionAll(found).unionAll(_join_across_blocks(whole, similar))


def _outsiders(known: DataFrame) -> DataFrame:
    """The sets outside of their cell's largest component."""
    count = known.groupBy("cell", "root").count()
    largest = count.groupBy("cell").agg(F.max(F.struct("count", "root"))["root"].alias("main"))
    return known.join(written(largest), "cell").filter("root <> main").drop("main")


def _join_across_blocks(known: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links of what lies outside of the largest component of a cell: it meets every block."""
    asking = _outsiders(known)
    weights = asking.groupBy("cell").agg(F.ceil(F.sum("n") / BLOCK).alias("outsides"))
    weights = written(weights)
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = asking.join(weights, "cell").withColumn("outside", F.pmod(F.xxhash64("key"), "outsides"))
    asking = asking.withColumn("block", everywhere("blocks")).withColumn("asks", F.lit(True))
    asked = known.join(weights, "cell").withColumn("outside", everywhere("outsides"))
    columns = ["cell", "outside", "block", "asks", "key", "root", "shingles"]
    met = asking.select(columns).unionByName(asked.withColumn("asks", F.lit(False)).select(columns))
    group = ["cell", "outside", "block"]
    dealt = met.repartition(_tasks(known), *group).sortWithinPartitions(*group)
    return dealt.mapInArrow(partial(_meet_blocks, similar=similar), LINKS)


def set_links(docs: DataFrame, profile: DataFrame, size: int, similar: tuple[int, int]) -> DataFrame:
    """Links between keys of different sets that join every two linked sets."""
    total = profile.agg(F.sum("n_shingles")).first()[0] or 0
    slices = max(_tasks(docs), -(-total // SLICE))
    posted = docs.select("text").mapInArrow(
        partial(_post, size=size, slices=slices),
        "slice int, chunk string, hashes binary, owners binary, keys binary, sizes binary",
    )
    alone = posted.groupBy("slice").applyInArrow(
        _count_alone, "chunk string, alone binary, keys binary, sizes binary"
    )
    linkable = partial(_linkable, similar=similar)
    keys = alone.groupBy("chunk").applyInArrow(lambda rows: linkable(rows), "key long").distinct()
    # One document for each set that goes on.
    first = profile.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    wanted = written(first.join(keys, "key", "left_semi").select("doc_id"))
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"])
    chosen = docs.select("doc_id", "text").join(wanted, same, "left_semi").select("text")
    bundles = written(
        chosen.mapInArrow(
            partial(_bundle, size=size), "chunk string, keys binary, sizes binary, hashes binary"
        )
    )
    counted = bundles.mapInArrow(
        partial(_count_bundle, slices=slices), "slice int, chunk string, hashes binary, counts binary"
    )
    answers = counted.groupBy("slice").applyInArrow(_total, "chunk string, slice int, counts binary")
    window = partial(_window, similar=similar)
    regions = written(
        bundles.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(lambda a, b: window(a, b), "pivot long, key long")
    )
    # A region is a star around its first key.
    centres = regions.groupBy("pivot").agg(F.min("key").alias("a"), F.max("key").alias("_last"))
    centres = written(centres.filter("a <> _last").select("pivot", "a"))
    stars = regions.join(centres, "pivot").filter("key <> a").select("a", F.col("key").alias("b"))
    cells = written(components(stars.distinct()))
    return _join_cells(bundles.mapInArrow(_unbundle, SETS), cells, similar)


def _rooted(docs: DataFrame, sets: DataFrame, first, size: int, similar: tuple[int, int]) -> DataFrame:
    """Rows of (key, first, root), one per set of shingles, with an aggregate of its rows as ``first``."""
    roots = components(set_links(docs, sets, size, similar))
    found = sets.groupBy("key").agg(first.alias("first"))
    rooted = found.join(roots.withColumnRenamed("node", "key"), "key", "left")
    return written(rooted.withColumn("root", F.coalesce("root", "key")))


def jaccard_components(
    docs: DataFrame, size: int = SIZE, similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """Rows of (doc_id, n_shingles, component_id), one per document.

    Two documents link if similar[1] * intersection >= similar[0] * union.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    profile = written(
        docs.mapInArrow(partial(_profile, size=size), "doc_id long, n_shingles long, key long")
    )
    sets = profile.filter("key is not null")
    rooted = _rooted(docs, sets, F.min("doc_id"), size, similar)
    least = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    mapped = written(rooted.join(least, "root").select("key", "component_id"))
    return profile.join(mapped, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(
    docs: DataFrame, size: int = SIZE, similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """The documents with all their columns, one row per component: that with the smallest doc_id.

    A NULL doc_id comes last. Rows with one doc_id and different texts are told apart by their texts;
    between those of one component the smallest key of their shingles decides. Of documents without
    shingles, which link with nothing, one row per doc_id and text stays.
    """
    id_ = F.col("doc_id").cast("long")
    known = [F.isnull(id_).alias("_none"), F.coalesce(id_, F.lit(0)).alias("_id")]
    known.append(F.xxhash64("text").alias("_text"))
    narrow = docs.select(id_.alias("doc_id"), "text")
    profile = written(
        narrow.select(*known, "text").mapInArrow(
            partial(_profile, size=size), "_none boolean, _id long, _text long, n_shingles long, key long"
        )
    )
    sets = profile.filter("key is not null")
    first = F.min(F.struct("_none", "_id", "key", "_text"))
    sets = sets.withColumn("doc_id", F.when(~F.col("_none"), F.col("_id")))
    rooted = _rooted(narrow, sets, first, size, similar)
    place = ["_none", "_id", "_text"]
    stay = rooted.groupBy("root").agg(F.min("first").alias("first")).select([f"first.{c}" for c in place])
    stay = written(stay.unionAll(profile.filter("key is null").select(place).distinct()))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), *known)
    kept = rows.join(stay, place, "left_semi")
    copies = W.partitionBy(place).orderBy("_text")
    return kept.withColumn("_n", F.row_number().over(copies)).filter("_n = 1").select("_row.*")
