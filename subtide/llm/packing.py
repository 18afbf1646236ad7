"""Token ids of documents, packed into sequences of one length by best-fit decreasing.

A document's ids are cut into pieces of at most ``length`` ids, in order and without loss. The pieces
of a chunk are placed longest first, each into the fullest open sequence that still has room, and
into a new one if none has. Room is looked up in a segment tree over capacities: its leaves count the
open sequences with that much room left, and a descent finds the smallest sufficient room in
logarithmic time.

Each row is one sequence: ``input_ids`` and ``position_ids`` as little-endian 16- or 32-bit integers
(``length`` of each, padded), ``cu_seqlens`` with the cumulative segment lengths from 0, and for each
segment its ``doc_ids`` and ``doc_offsets`` (the place of its first id in its document). Positions
restart at 0 with each segment. ``write_matrices`` writes the rows as binary matrices, one set of files
per task, and ``read_matrices`` reads them back.

Scale: no shuffle. Each task packs its documents in chunks of about ``CHUNK_IDS`` ids, which bounds
its memory; a chunk leaves a few sequences short of full, less than one in a thousand. The
vocabulary is read on the driver and sent once; it does not grow with the data.

Defined cases: a text that is NULL or empty has no ids and no segment. Texts of any length are split.
Repeated rows are packed as often as they appear. A NULL doc_id stays NULL in ``doc_ids``. Special
tokens written out in a text are ordinary text. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from subtide.llm.common import opened, record_batches
from subtide.sources import written
from subtide.sources.scratch import scratch_root

# Where the public rank files lie.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
LENGTH = 2048
CHUNK_IDS = 4_000_000
OUT_ROWS = 200

# Fixed value: the pattern of the public rank files, which splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PACKED = (
    "input_ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<long>, doc_offsets array<int>"
)
PACKED_SCHEMA = pa.schema(
    [
        ("input_ids", pa.binary()),
        ("position_ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_offsets", pa.list_(pa.int32())),
    ]
)


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def encoding(ranks: bytes) -> tiktoken.Encoding:
    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


class Room:
    """Open sequences by the room they have left."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = {}

    def add(self, room: int, sequence: int) -> None:
        self.open.setdefault(room, []).append(sequence)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.counts[node] += by
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove the sequence with the least room of at least ``size``: (room, sequence)."""
        node = self.leaves + size
        if not self.counts[node]:
            # Up to the first ancestor with a filled right sibling, then down to its first leaf.
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.counts[node]:
                    node += 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """The positions of ``sizes`` in each sequence. Sizes lie between 1 and ``length``."""
    room = Room(length)
    sequences: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = room.take(sizes[i])
        left, sequence = found or (length, len(sequences))
        if found is None:
            sequences.append([])
        sequences[sequence].append(i)
        if left > sizes[i]:
            room.add(left - sizes[i], sequence)
    return sequences


def _pack(pieces: list[tuple], length: int, pad: int, kind: str) -> Iterator[pa.RecordBatch]:
    rows = []
    for sequence in best_fit_decreasing([len(p[2]) for p in pieces], length):
        ids = np.full(length, pad, dtype=kind)
        positions = np.zeros(length, dtype="<u4" if length > 65536 else "<u2")
        ends = [0]
        for i in sequence:
            start, end = ends[-1], ends[-1] + len(pieces[i][2])
            ids[start:end] = pieces[i][2]
            positions[start:end] = np.arange(end - start)
            ends.append(end)
        values = [ids.tobytes(), positions.tobytes(), ends]
        values += [[pieces[i][0] for i in sequence], [pieces[i][1] for i in sequence]]
        rows.append(dict(zip(PACKED_SCHEMA.names, values)))
        if len(rows) == OUT_ROWS:
            yield pa.RecordBatch.from_pylist(rows, PACKED_SCHEMA)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, PACKED_SCHEMA)


def _tokenize_and_pack(
    batches: Iterator[pa.RecordBatch], ranks, length: int, pad: int, kind: str, chunk: int
) -> Iterator[pa.RecordBatch]:
    encode = encoding(ranks.value).encode_ordinary
    pieces: list[tuple] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            ids = np.array(encode(text), dtype=kind)
            pieces += [(doc_id, at, ids[at : at + length]) for at in range(0, len(ids), length)]
            held += len(ids)
            if held >= chunk:
                yield from _pack(pieces, length, pad, kind)
                pieces, held = [], 0
    yield from _pack(pieces, length, pad, kind)


def pack(docs: DataFrame, ranks_path: str, length: int = LENGTH, chunk: int = CHUNK_IDS) -> DataFrame:
    """One row per sequence of ``length`` ids. The first id that the vocabulary leaves free pads."""
    ranks = read_ranks(ranks_path)
    pad = encoding(ranks).n_vocab
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = "<u2" if pad < 65536 else "<u4"
    read = docs.select(F.col("doc_id").cast("long"), "text")
    packing = partial(_tokenize_and_pack, ranks=sent, length=length, pad=pad, kind=kind, chunk=chunk)
    return read.mapInArrow(packing, PACKED)


SHARDS = "file string, sequences long"
SHARD_SCHEMA = pa.schema([("file", pa.string()), ("sequences", pa.int64())])

# The matrices of a shard, by the ending of their files.
IDS, POSITIONS, SEGMENTS = "ids.bin", "positions.bin", "segments.bin"


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Ids and positions row by row; per row its number of segments, their ends, ids and offsets."""
    store, root = opened(folder)
    store.create_dir(root, recursive=True)
    name, count, files = uuid.uuid4().hex, 0, []
    for batch in batches:
        if not files:
            files = [store.open_output_stream(f"{root}/{name}.{e}") for e in (IDS, POSITIONS, SEGMENTS)]
        for r in batch.to_pylist():
            files[0].write(r["input_ids"])
            files[1].write(r["position_ids"])
            known = [d is not None for d in r["doc_ids"]]
            numbers = [len(known), *r["cu_seqlens"][1:], *(d or 0 for d in r["doc_ids"])]
            files[2].write(np.array([*numbers, *known, *r["doc_offsets"]], dtype="<i8").tobytes())
            count += 1
    for file in files:
        file.close()
    if count:
        row = {"file": f"{folder}/{name}", "sequences": count}
        yield pa.RecordBatch.from_pylist([row], SHARD_SCHEMA)


def write_matrices(packed: DataFrame, folder: str | None = None) -> DataFrame:
    """Write packed rows as binary matrices; return the written table of shards that count."""
    folder = folder or f"{scratch_root(packed.sparkSession)}/packed-{uuid.uuid4().hex}"
    return written(packed.mapInArrow(partial(_write, folder=folder), SHARDS))


def _sequences(shard: dict) -> Iterator[dict]:
    sources = []
    for ending in (IDS, POSITIONS, SEGMENTS):
        store, path = opened(f"{shard['file']}.{ending}")
        sources.append((store.open_input_stream(path), store.get_file_info(path).size))
    width = [size // shard["sequences"] for _, size in sources[:2]]
    for _ in range(shard["sequences"]):
        values = [bytes(file.read(w)) for (file, _), w in zip(sources, width)]
        n = int(np.frombuffer(sources[2][0].read(8), dtype="<i8")[0])
        ends, keys, known, offsets = np.frombuffer(sources[2][0].read(32 * n), "<i8").reshape(4, n).tolist()
        keys = [k if ok else None for k, ok in zip(keys, known)]
        yield dict(zip(PACKED_SCHEMA.names, [*values, [0, *ends], keys, offsets]))
    for file, _ in sources:
        file.close()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for shard in batch.to_pylist() for row in _sequences(shard))
    yield from record_batches(rows, PACKED_SCHEMA, OUT_ROWS)


def read_matrices(shards: DataFrame) -> DataFrame:
    """The packed rows of the shards."""
    return shards.mapInArrow(_read, PACKED)


def packed_matrices(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Pack, write the binary matrices and return what they hold. Calling it runs the write."""
    return read_matrices(write_matrices(pack(docs, ranks_path)))
