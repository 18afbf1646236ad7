"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts of up to three bytes counts which byte follows. A byte s
after a context of total count n with d different followers costs, in bits,

    -log2(count(s) / (n + d))            if s has followed the context,
    -log2(d / (n + d)) + cost(s after the context without its first byte)   if not (escape),

and a context never seen costs nothing to leave. Without any context left a byte costs 8 bits. A text
starts after a line feed. The statistics are frozen after training, so the code length of a text is
the sum of its bytes' costs, exact for every text and every order of evaluation up to rounding. The
prediction is the language with the shortest code, the first by name if several are; its score is its
share of the probability, 2^-length over all languages' 2^-length.

For speed the costs of all byte strings of two, three and four bytes seen in training are tabled for
all languages at once. A string that no language has seen falls back to shorter ones by the escape
rule, in vectorised steps.

Training takes at most ``DOCS`` different rows per language, those first by hash, up to ``BYTES`` bytes, and
with more than ``LANGUAGES`` languages so much less of each that they do not take more together, but one row
of each at least: every language is learned. These bounds are parameters and bound the sample. All texts are predicted, whole, where they lie: no shuffle.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0; so is every text if
nothing was learned. A NULL doc_id counts as not held out. Repeated rows give repeated results, and are learned
from once. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from subtide.llm.common import trimming
from subtide.sources import written

DOCS = 400
BYTES = 1_000_000
LANGUAGES = 64

START = b"\n\n\n"
UNDETERMINED = "und"

GRAMS = "lang string, size int, grams binary, counts binary"
GRAM_SCHEMA = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())]
)


def codes(data: np.ndarray, size: int) -> np.ndarray:
    """The byte strings of ``size`` bytes that end at each byte after the first three, as numbers."""
    count = len(data) - 3
    out = np.zeros(count, dtype=np.uint32)
    for back in range(size - 1, -1, -1):
        out = out << np.uint32(8) | data[3 - back : 3 - back + count]
    return out


@trimming
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language of one task: the byte strings of one to four bytes and their counts."""
    held: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            data = np.frombuffer(START + text.encode(), dtype=np.uint8).astype(np.uint32)
            own = held.setdefault(lang, [])
            own.append(codes(data, 4))
    for lang, found in held.items():
        last = np.concatenate(found)
        for size in (1, 2, 3, 4):
            mask = np.uint32((1 << 8 * size) - 1)
            grams, counts = np.unique(last & mask, return_counts=True)
            row = {"lang": lang, "size": size, "grams": grams.tobytes(), "counts": counts.tobytes()}
            yield pa.RecordBatch.from_pylist([row], GRAM_SCHEMA)


def training_rows(docs: DataFrame, wanted: Column, most_docs: int, most_bytes: int, many_langs: int) -> DataFrame:
    """The bounded sample of labelled rows (lang, text)."""
    labelled = docs.filter(wanted & F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = labelled.withColumn("_h", F.xxhash64(F.col("doc_id"), F.col("text")))
    # One narrow row per different row, so that copies count once.
    narrow = hashed.groupBy("lang", "_h").agg(F.min(F.octet_length("text")).alias("_b"))
    counts = {r["lang"]: r["count"] for r in narrow.groupBy("lang").count().collect()}
    if not counts:
        return labelled.select("lang", "text").limit(0)
    part = min(1.0, many_langs / len(counts))
    most_docs, most_bytes = max(1, int(most_docs * part)), most_bytes * part
    # The first by hash lie below four times their share of the hash range, and sixteen rows more. That
    # leaves a few times most_docs narrow rows per language to order; texts are fetched for the first only.
    share = {lang: min(1.0, 4 * (most_docs + 4) / count) for lang, count in counts.items()}
    below = F.create_map(*[F.lit(x) for lang, of in share.items() for x in (lang, of)])
    place = (F.col("_h") / 2.0**64) + 0.5
    narrow = narrow.filter(place <= F.element_at(below, F.col("lang")))
    first = W.partitionBy("lang").orderBy("_h")
    ranked = narrow.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= most_docs)
    before = F.sum("_b").over(first.rowsBetween(W.unboundedPreceding, -1))
    ranked = ranked.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < most_bytes)
    chosen = written(ranked.select("lang", "_h"))
    sample = hashed.join(F.broadcast(chosen), ["lang", "_h"], "left_semi")  # most_docs of each language
    return sample.dropDuplicates(["lang", "_h"]).select("lang", "text")


class Model:
    """Frozen costs of all languages, as tables for vectorised lookup."""

    def __init__(self, counted: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]]):
        self.langs = sorted(counted)
        width = len(self.langs)
        seen = {
            size: np.unique(np.concatenate([counted[lang][size][0] for lang in self.langs]))
            if width
            else np.zeros(0, np.uint32)
            for size in (1, 2, 3, 4)
        }
        # cost[size]: of the last byte of a string after the bytes before it; escape[size]: of
        # leaving a context of that size, 0 where it has not been seen.
        self.grams, self.cost, self.escape = seen, {}, {}
        self.contexts = {n: np.unique(seen[n + 1] >> np.uint32(8)) for n in (0, 1, 2, 3)}
        below = np.full((256, width), 8.0, dtype=np.float64)
        for size in (1, 2, 3, 4):
            grams, contexts = seen[size], self.contexts[size - 1]
            cost = np.zeros((len(grams), width))
            escape = np.zeros((len(contexts), width))
            for column, lang in enumerate(self.langs):
                own, counts = counted[lang][size]
                count = np.zeros(len(grams))
                count[np.searchsorted(grams, own)] = counts
                at = np.searchsorted(contexts, grams >> np.uint32(8))
                total = np.bincount(at, weights=count, minlength=len(contexts))
                kinds = np.bincount(at, weights=count > 0, minlength=len(contexts))
                known = total > 0
                escape[known, column] = np.log2((total + kinds)[known] / kinds[known])
                lower = below[self._row(size - 1, grams)][:, column]
                hit = count > 0
                cost[hit, column] = np.log2((total + kinds)[at[hit]] / count[hit])
                cost[~hit, column] = escape[at[~hit], column] + lower[~hit]
            self.cost[size], self.escape[size - 1] = cost, escape
            below = cost
        self.escape_table = {n: np.vstack([e, np.zeros((1, width))]) for n, e in self.escape.items()}
        # Pairs of bytes as small numbers, so that four bytes index a dense table.
        pairs = np.unique(np.concatenate([seen[4] >> np.uint32(16), seen[4] & np.uint32(0xFFFF)]))
        self.pair = np.zeros(65536, dtype=np.uint32)
        self.pair[pairs] = np.arange(1, len(pairs) + 1)
        self.pairs = len(pairs) + 1
        self.place = np.zeros(self.pairs * self.pairs, dtype=np.int32)
        self.place[self._dense(seen[4])] = np.arange(1, len(seen[4]) + 1)
        self.four = np.vstack([np.zeros((1, width)), self.cost[4]])

    def _row(self, size: int, grams: np.ndarray) -> np.ndarray:
        """The rows of the last ``size`` bytes of strings whose shorter ends have all been seen."""
        if size == 0:
            return (grams & np.uint32(0xFF)).astype(np.int64)
        return np.searchsorted(self.grams[size], grams & np.uint32((1 << 8 * size) - 1))

    def _dense(self, four: np.ndarray) -> np.ndarray:
        high = self.pair[four >> np.uint32(16)].astype(np.int64)
        return high * self.pairs + self.pair[four & np.uint32(0xFFFF)]

    def _find(self, table: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Rows of ``values`` in a sorted table, the table's length where absent."""
        at = np.searchsorted(table, values)
        if not len(table):
            return at
        found = table[np.minimum(at, len(table) - 1)] == values
        return np.where(found, at, len(table))

    def byte_costs(self, data: np.ndarray) -> np.ndarray:
        """The cost of each byte after the first three, per language."""
        four = codes(data, 4)
        place = self.place[self._dense(four)]
        cost = self.four[place]
        new = np.flatnonzero(place == 0)
        if len(new):
            cost[new] = self._fallback(four[new], 4)
        return cost

    def _fallback(self, grams: np.ndarray, size: int) -> np.ndarray:
        """Strings of ``size`` bytes that no language has seen: escape, then one byte less."""
        if size == 0:
            return np.full((len(grams), len(self.langs)), 8.0)
        context = self._find(self.contexts[size - 1], grams >> np.uint32(8))
        cost = self.escape_table[size - 1][context]
        lower = grams & np.uint32((1 << 8 * (size - 1)) - 1) if size > 1 else grams
        if size == 1:
            return cost + self._fallback(lower, 0)
        at = self._find(self.grams[size - 1], lower)
        known = at < len(self.grams[size - 1])
        cost[known] += self.cost[size - 1][at[known]]
        if not known.all():
            cost[~known] += self._fallback(lower[~known], size - 1)
        return cost

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Code lengths in bits, one row per text and one column per language."""
        out = np.zeros((len(texts), len(self.langs)))
        parts = [text.encode() for text in texts]
        start = 0
        while start < len(parts):  # a bounded number of bytes at a time
            stop, size = start, 0
            while stop < len(parts) and (stop == start or size + len(parts[stop]) <= CHUNK):
                size += len(parts[stop])
                stop += 1
            out[start:stop] = self._lengths(parts[start:stop])
            start = stop
        return out

    def _lengths(self, parts: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(p) + 3 for p in parts])
        data = np.frombuffer(START.join([b"", *parts]), dtype=np.uint8).astype(np.uint32)
        totals = np.zeros((len(parts), len(self.langs)))
        owner = np.repeat(np.arange(len(parts)), [len(p) + 3 for p in parts])
        for low in range(0, len(data) - 3, CHUNK):
            some = data[low : low + CHUNK + 3]
            cost = self.byte_costs(some)
            own = owner[low + 3 : low + 3 + len(cost)]
            # The separators' own bytes belong to no text.
            inside = np.arange(low + 3, low + 3 + len(cost)) >= (ends - np.diff(ends, prepend=0))[own] + 3
            cost[~inside] = 0
            first = np.flatnonzero(np.diff(own, prepend=-1))
            totals[own[first]] += np.add.reduceat(cost, first, axis=0)
        return totals

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not texts:
            return []
        lengths = self.lengths(texts)
        best = lengths.argmin(axis=1)
        share = 1 / np.exp2(np.maximum(lengths.min(axis=1, keepdims=True) - lengths, -1000)).sum(axis=1)
        return [(self.langs[b], float(s)) for b, s in zip(best, share)]


# Bytes whose costs are computed at once.
CHUNK = 1 << 20


def train(
    docs: DataFrame,
    wanted: Column,
    most_docs: int = DOCS,
    most_bytes: int = BYTES,
    many_langs: int = LANGUAGES,
) -> Model:
    """Learn from the rows (doc_id, text, lang) that meet ``wanted``."""
    sample = training_rows(docs, wanted, most_docs, most_bytes, many_langs)
    merged: dict[str, dict[int, list]] = {}
    for row in sample.mapInArrow(_count, GRAMS).collect():
        grams = np.frombuffer(row["grams"], dtype=np.uint32)
        counts = np.frombuffer(row["counts"], dtype=np.int64)
        merged.setdefault(row["lang"], {}).setdefault(row["size"], []).append((grams, counts))
    counted: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
    for lang, sizes in merged.items():
        for size, found in sizes.items():
            grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([c for _, c in found]))
            counted.setdefault(lang, {})[size] = (grams, counts)
    return Model(counted)


@trimming
def _predict(batches: Iterator[pa.RecordBatch], model, letter: str, add) -> Iterator[pa.RecordBatch]:
    known: Model = model.value
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rows = [i for i, ok in enumerate(batch.column(letter).to_pylist()) if ok and known.langs]
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        for i, (lang, score) in zip(rows, known.predict([texts[i] for i in rows])):
            langs[i], scores[i] = lang, score
        yield add(batch, langs, scores)


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def held_out(fold: int = 2, folds: int = 4) -> Column:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def _with_prediction(batch: pa.RecordBatch, langs: list, scores: list) -> pa.RecordBatch:
    columns = [batch.column("doc_id"), batch.column("held_out")]
    columns += [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of (doc_id, held_out, lang_pred, score), one per document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training bounds
    read = docs.select("doc_id", held_out().alias("held_out"), "text", has_letter().alias("_letter"))
    return read.mapInArrow(
        partial(_predict, model=sent, letter="_letter", add=_with_prediction),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double",
    )


def _keep_known(batch: pa.RecordBatch, langs: list, scores: list, letter: str) -> pa.RecordBatch:
    # Not by the prediction: it is "und" for every text if nothing was learned.
    known = batch.column(letter)
    batch = batch.drop_columns([letter])
    if "lang" in batch.schema.names:
        own = batch.column("lang").to_pylist()
        told = [lang if old is None and lang != UNDETERMINED else old for old, lang in zip(own, langs)]
        at = batch.schema.get_field_index("lang")
        batch = batch.set_column(at, batch.schema.field(at), pa.array(told, batch.schema.field(at).type))
    return batch.filter(known)


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a letter, with all their columns: those alone can have a language.

    A ``lang`` that is NULL becomes the predicted one; others stay. An empty model says nothing about any text, so
    ``lang`` stays as it is. Extra columns may have any name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    letter = "_letter"
    while letter in docs.columns:
        letter += "_"
    read = docs.withColumn(letter, has_letter())
    add = partial(_keep_known, letter=letter)
    return read.mapInArrow(partial(_predict, model=sent, letter=letter, add=add), docs.schema)
