"""Judge URLs by host and path rules kept in sorted digest arrays.

``build`` turns a table of rules into shard files: 64-bit xxhash keys of ``host + path`` in ascending
order, and beside them the full rule strings. Spark range-partitions and sorts the rules by key, and
each task writes one shard, so neither the driver nor a task ever holds all rules. The table of
shards (path, first and last key, sizes) says which files count.

``judge`` probes every URL. A rule fits its host and all subdomains, on paths that start with its
path, so the candidates are (suffix of the host) x (prefix of the path). Only prefix lengths that
occur among the rules are tried. A task memory-maps a shard, finds the keys of a whole batch by
vectorised binary search, and compares the stored string, so a collision of keys never decides.

Rules of one shard are probed where the URLs lie. With more shards a candidate's key goes to the one shard
whose range of keys holds it, or nowhere; Spark's rebalancing splits the keys of a hot domain over several
tasks. A task works through its keys in the order of the shards and has one shard open at a time; off a local
file system it copies that shard to an unlinked temporary file first. Only (row, shard, key) are shuffled:
the stored strings found come back to their URL's row and are confirmed there.

The longest ``host + path`` wins, then the longer host. Without a rule the verdict is ``default``.

Defined cases: a URL that is NULL or has no ``://`` has an empty host and path and meets no rule. Only
A-Z are lower-cased. Equal rules are kept once; if one rule is both allowed and blocked, block wins.
No rules at all gives the default for every URL. A rule without a verdict blocks. Pages with one page_id are
rows of their own. Extra columns are ignored.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from subtide.llm.common import lower_ascii, opened, record_batches
from subtide.sources import written
from subtide.sources.scratch import scratch_root

# Rules per shard file: about 8 bytes of key and 50 of text each.
SHARD_RULES = 4_000_000

KEYED = pa.schema(
    [("host", pa.string()), ("path", pa.string()), ("verdict", pa.string()), ("key", pa.int64())]
)
SHARD = pa.schema(
    [
        ("file", pa.string()),
        ("rules", pa.int64()),
        ("first", pa.int64()),
        ("last", pa.int64()),
        ("lengths", pa.list_(pa.int32())),
    ]
)
TRIED = pa.schema([("row", pa.int64()), ("shard", pa.int32()), ("key", pa.int64())])
HIT = pa.schema(
    [("row", pa.int64()), ("on_host", pa.string()), ("on_path", pa.string()), ("says", pa.string())]
)
JUDGED = "page_id long, host string, path string, rule string, verdict string"


def digest(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}\0{path}".encode()) - 2**63


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = map(digest, batch.column("host").to_pylist(), batch.column("path").to_pylist())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], schema=KEYED)


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One file: number of rules, sorted keys, ends of the texts, texts."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    rules = pa.Table.from_batches(held)
    parts = [rules[c].cast(pa.large_string()) for c in ("host", "path", "verdict")]
    joined = pc.binary_join_element_wise(*parts, pa.scalar("\0", pa.large_string()))
    texts = pa.concat_arrays(joined.chunks)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    keys = rules["key"].to_numpy()
    store, root = opened(folder)
    store.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}.keys"
    with store.open_output_stream(f"{root}/{name}") as out:
        out.write(np.array([len(keys)], np.int64).tobytes())
        out.write(keys.astype(np.int64).tobytes())
        out.write((bounds[1:] - bounds[0]).tobytes())
        out.write(texts.buffers()[2][int(bounds[0]) : int(bounds[-1])])
    found = {
        "file": f"{folder}/{name}",
        "rules": len(keys),
        "first": int(keys[0]),
        "last": int(keys[-1]),
        "lengths": sorted(pc.unique(pc.utf8_length(rules["path"])).to_pylist()),
    }
    yield pa.RecordBatch.from_pylist([found], SHARD)


def build(rules: DataFrame, shard_rules: int = SHARD_RULES) -> DataFrame:
    """Write the shards of rules (host, path, verdict); return the table of shards."""
    spark = rules.sparkSession
    unique = rules.groupBy(
        lower_ascii(F.coalesce("host", F.lit(""))).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
    ).agg(F.coalesce(F.max("verdict"), F.lit("block")).alias("verdict"))
    keyed = written(
        unique.mapInArrow(_with_keys, "host string, path string, verdict string, key long")
    )
    shards = max(1, -(-keyed.count() // shard_rules))
    dealt = keyed.repartitionByRange(shards, "key").sortWithinPartitions("key", "host", "path")
    write = partial(_write_shard, folder=f"{scratch_root(spark)}/urls-{uuid.uuid4().hex}")
    stored = "file string, rules long, first long, last long, lengths array<int>"
    return written(dealt.mapInArrow(write, stored))


class Shard:
    """A memory-mapped shard file."""

    def __init__(self, uri: str):
        store, path = opened(uri)
        if isinstance(store, fs.LocalFileSystem):
            mapped = np.memmap(path, dtype=np.uint8, mode="r")
        else:
            with tempfile.NamedTemporaryFile() as copy:  # the map keeps the unlinked file
                with store.open_input_stream(path) as source:
                    while block := source.read(1 << 24):
                        copy.write(block)
                copy.flush()
                mapped = np.memmap(copy.name, dtype=np.uint8, mode="r")
        rules = int(mapped[:8].view(np.int64)[0])
        numbers = mapped[8 : 8 + 16 * rules].view(np.int64)
        self.keys, self.ends = numbers[:rules], numbers[rules:]
        self.texts = mapped[8 + 16 * rules :]

    def rule(self, at: int) -> list[str]:
        start = int(self.ends[at - 1]) if at else 0
        return bytes(self.texts[start : int(self.ends[at])]).decode().split("\0")

    def find(self, keys: np.ndarray) -> Iterator[tuple[int, list[str]]]:
        """Each position in ``keys`` with a stored rule of that key; there may be several."""
        first = np.searchsorted(self.keys, keys, side="left")
        last = np.searchsorted(self.keys, keys, side="right")
        for i in np.flatnonzero(first < last):
            for at in range(first[i], last[i]):
                yield int(i), self.rule(at)


def suffixes(host: str) -> list[str]:
    """The host and its parent domains, longest first."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[tuple[str, str]]:
    """Host and path of each rule that would fit."""
    if host:
        starts = [path[:n] for n in lengths if n <= len(path)]
        for domain in suffixes(host):
            for start in starts:
                yield domain, start


def _probe(
    batches: Iterator[pa.RecordBatch], files: list[str], lengths: list[int], default: str
) -> Iterator[pa.RecordBatch]:
    shards = [Shard(f) for f in files]
    for batch in batches:
        urls = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())
        tried = [(row, *c) for row, (h, p) in enumerate(urls) for c in candidates(h, p, lengths)]
        keys = np.array([digest(d, p) for _, d, p in tried], dtype=np.int64)
        best: dict[int, tuple[int, int, str, str]] = {}
        for shard in shards:
            for i, (host, path, verdict) in shard.find(keys):
                row, domain, start = tried[i]
                if (host, path) == (domain, start):
                    fits = (len(host) + len(path), len(host), host + path, verdict)
                    best[row] = max(best.get(row, fits), fits)
        none = (0, 0, None, default)
        found = [best.get(row, none) for row in range(batch.num_rows)]
        columns = [*batch.columns, pa.array([f[2] for f in found], pa.string())]
        columns.append(pa.array([f[3] for f in found], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "rule", "verdict"])


def _tries(
    batches: Iterator[pa.RecordBatch], firsts: list[int], lasts: list[int], lengths: list[int]
) -> Iterator[pa.RecordBatch]:
    """The keys that each URL asks for, with the shard whose range holds them."""
    first, last = np.array(firsts, np.int64), np.array(lasts, np.int64)
    for batch in batches:
        urls = zip(*(batch.column(c).to_pylist() for c in ("row", "host", "path")))
        asked = [(row, digest(*c)) for row, host, path in urls for c in candidates(host, path, lengths)]
        rows, keys = np.array(asked, np.int64).reshape(-1, 2).T
        shard = np.searchsorted(first, keys, side="right") - 1
        held = (shard >= 0) & (keys <= last[shard])
        columns = [rows[held], shard[held].astype(np.int32), keys[held]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=TRIED)


def _hits(batches: Iterator[pa.RecordBatch], files: list[str]) -> Iterator[pa.RecordBatch]:
    """The stored rules of the keys asked for; keys come in the order of their shards."""

    def found() -> Iterator[dict]:
        at, shard = -1, None
        for batch in batches:
            rows, numbers, keys = (batch.column(c).to_numpy() for c in TRIED.names)
            for number in np.unique(numbers):
                if number != at:
                    at, shard = number, Shard(files[number])
                own = np.flatnonzero(numbers == number)
                for i, rule in shard.find(keys[own]):
                    yield dict(zip(HIT.names, (int(rows[own[i]]), *rule)))

    yield from record_batches(found(), HIT, 10_000)


def _judge_by_shard(parsed: DataFrame, shards: list, lengths: list[int], default: str) -> DataFrame:
    """Keys meet the shard that may hold them; what is found there goes back to the URL's row."""
    rows = written(parsed.withColumn("row", F.monotonically_increasing_id()))
    ranges = {"firsts": [s["first"] for s in shards], "lasts": [s["last"] for s in shards]}
    tried = rows.mapInArrow(partial(_tries, lengths=lengths, **ranges), "row long, shard int, key long")
    dealt = tried.hint("rebalance", "shard").sortWithinPartitions("shard")
    hits = dealt.mapInArrow(
        partial(_hits, files=[s["file"] for s in shards]),
        "row long, on_host string, on_path string, says string",
    )
    below = F.endswith("host", F.concat(F.lit("."), "on_host"))
    fits = ((F.col("host") == F.col("on_host")) | below) & F.startswith("path", F.col("on_path"))
    rule = F.concat("on_host", "on_path")
    rank = F.struct(F.length(rule), F.length("on_host"), rule.alias("rule"), F.col("says"))
    best = (
        rows.join(hits, "row", "left")
        .groupBy("row")
        .agg(
            *(F.first(c).alias(c) for c in ("page_id", "host", "path")),
            F.max(F.when(fits, rank)).alias("best"),
        )
    )
    verdict = F.coalesce("best.says", F.lit(default))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, shards: DataFrame, default: str = "allow") -> DataFrame:
    """Rows of (page_id, host, path, rule, verdict), one per page.

    The table of shards has one row per ``SHARD_RULES`` rules and comes to the driver.
    """
    found = shards.orderBy("first").collect()
    lengths = sorted({n for shard in found for n in shard["lengths"]})
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", "url").select(
        F.col("page_id").cast("long"), host.alias("host"), path.alias("path")
    )
    if len(found) > 1:
        return _judge_by_shard(parsed, found, lengths, default)
    probe = partial(_probe, files=[s["file"] for s in found], lengths=lengths, default=default)
    return parsed.mapInArrow(probe, JUDGED)
