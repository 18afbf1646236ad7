"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last keep the columns
of documents. Between stages the result is written as Parquet and read again.

1. language identification: documents without a recognisable language (no letter, no text) go
2. near duplicates: of each component under 5-word shingles with a Jaccard similarity of 0.8 or
   more, the document with the smallest doc_id stays
3. decontamination: documents that hold a benchmark item, with up to 5 % edits, go
4. mixing: each document as often as its source's target asks for
5. packing: token ids in sequences of one length, written as binary matrices and read back
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from subtide.llm import decontaminate, jaccard, langid, mixing, packing
from subtide.llm.common import ready, table
from subtide.sources import written

# SQL cannot express the stages; tests compare each with a plain version.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return langid.recognised(docs, langid.train(docs, F.lit(True)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return jaccard.one_of_each(docs, size=5, similar=(80, 100))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(ready(spark), sf_dir, "benchmark"), short=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.repeated(docs, mixing.WEIGHTS, max_epochs=3, seed=mixing.SEED)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.packed_matrices(docs, packing.RANKS)


STAGES = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_contaminated", drop_contaminated),
    ("mix_sources", mix_sources),
    ("pack_tokens", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
