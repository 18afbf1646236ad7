"""Mix sources to target weights by capped water-filling, with Spark expressions only.

A source's target is its share of the budget by weight. A target above ``max_epochs`` times the
source's size is clamped there, and the excess goes to the other sources by weight until no target
is above its cap. In closed form every target is ``min(cap, level * weight)``: ordered by
``cap / weight``, the clamped sources are a prefix, and the level is what is left of the budget over
the weights that are left.

A source takes ``floor(target / size)`` whole repetitions of each document and a seeded sample of
documents for the rest: in the order of ``md5(seed : doc_id)`` those whose middle lies within the
remaining words. The taken words are then within half a document of the target, and reruns agree.

Scale: the texts are read once, to a written table of narrow rows. Sampling never sorts a source as
a whole. The first hex digits of the hash deal a source's documents into slots, sizes are summed per
slot before the shuffle, and only the one slot that holds the cut is ordered. The windows over
sources and slots see one row per source or slot, never documents.

Empty and repeated input: a NULL text has size 0 and takes 0 words. NULL is a source like any
other. Copies of a row are rows of their own. An empty table gives an empty result, and a corpus
without words has targets of 0. Columns that are not named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from subtide.llm.common import words
from subtide.sources import written

# Of the queries: weights of the sources in turn, and the seed of the sample.
WEIGHTS = [5, 2, 1]
SEED = 17

# Hex digits of the sampling hash that make a slot: 16 ** 4 slots per source.
SLOT_DIGITS = 4


def sizes(docs: DataFrame, seed: int, keep: list[str] | None = None) -> DataFrame:
    """Narrow rows: doc_id, source, size in words and the sampling hash."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(
        "doc_id",
        "source",
        *(keep or []),
        F.size(words("text")).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), doc_id)).alias("_hash"),
    )


def cyclic_weights(sources: DataFrame, cycle: list[int]) -> DataFrame:
    """Weights in turn over the sources by code point, NULL last."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int"))
    return sources.withColumn("weight", weight.cast("long"))


def targets(weighted: DataFrame, share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """Add ``target`` to rows of (source, source_size, weight). Weights are positive integers.

    Clamping the first k sources by ``cap / weight`` gives the level (budget - their caps) / (the
    other weights). Any other choice of clamped sources gives a lower one, so the largest is right.
    """
    everything = W.partitionBy()
    by_ratio = W.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, W.unboundedFollowing)
    clamped = F.coalesce(F.sum("_cap").over(before), F.lit(0))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (budget - clamped) / F.sum("weight").over(after)
    return (
        weighted.withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("weight")))
        .drop("_cap", "_level")
    )


def repetitions(rows: DataFrame, sized: DataFrame, targeted: DataFrame) -> DataFrame:
    """Add target, source_size and ``copies``, the times a document is taken, to ``rows``.

    ``rows`` have the columns of ``sizes``, and may have more. The other inputs must be written
    tables: they are read more than once.
    """
    slot = F.substring("_hash", 1, SLOT_DIGITS)
    plan = (
        targeted.withColumn("_whole", F.floor(F.try_divide(F.col("target"), F.col("source_size"))))
        .withColumn("_whole", F.coalesce(F.col("_whole"), F.lit(0)))
        .withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
        .drop("weight")
    )
    by_slot = W.partitionBy("source").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    slots = sized.groupBy("source", slot.alias("_slot")).agg(F.sum("size").alias("_in_slot"))
    slots = slots.withColumn("_before", F.coalesce(F.sum("_in_slot").over(by_slot), F.lit(0)))
    same = F.col("s.source").eqNullSafe(F.col("p.source"))
    cut = (F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_in_slot"))
    cuts = slots.alias("s").join(plan.alias("p"), same & cut).select("s.source", "_slot", "_before")
    plan = plan.alias("p").join(cuts.alias("s"), same, "left")
    plan = written(plan.select("p.*", "_slot", F.coalesce("_before", F.lit(0)).alias("_before")))

    rows = rows.alias("s").join(plan.alias("p"), same)
    rows = rows.select("s.*", *[f"p.{c}" for c in plan.columns if c != "source"])
    beside = rows.filter(~slot.eqNullSafe(F.col("_slot")))
    more = F.coalesce(slot < F.col("_slot"), F.lit(False))
    inside = rows.filter(slot == F.col("_slot"))
    order = W.partitionBy("source").orderBy("_hash", "size").rowsBetween(W.unboundedPreceding, -1)
    middle = F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("size") / 2
    taken = beside.withColumn("_more", more).unionByName(
        inside.withColumn("_more", middle <= F.col("_rest"))
    )
    return taken.withColumn("copies", F.col("_whole") + F.col("_more").cast("long")).drop(
        "_hash", "_whole", "_rest", "_slot", "_before", "_more"
    )


def mix(
    docs: DataFrame,
    cycle: list[int],
    share: float = 1.0,
    max_epochs: int = 3,
    seed: int = 0,
) -> DataFrame:
    """Rows of (doc_id, source, size, source_size, target, copies, taken), one per document.

    ``cycle`` holds the weights of the sources by code point, repeating.
    """
    sized = written(sizes(docs, seed))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targeted = written(targets(cyclic_weights(totals, cycle), share, max_epochs))
    taken = repetitions(sized, sized, targeted)
    return taken.withColumn("taken", F.col("size") * F.col("copies"))


def repeated(
    docs: DataFrame, cycle: list[int], share: float = 1.0, max_epochs: int = 3, seed: int = 0
) -> DataFrame:
    """The documents with all their columns, each as often as the mix takes it."""
    sized = written(sizes(docs, seed))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targeted = written(targets(cyclic_weights(totals, cycle), share, max_epochs))
    whole = docs.withColumn("_row", F.struct(*docs.columns))
    taken = repetitions(sizes(whole, seed, ["_row"]), sized, targeted).filter("copies > 0")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return taken.select("_row", each.alias("_copy")).select("_row.*")
