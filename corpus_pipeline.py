"""From raw documents to packed token sequences, stage by stage.

Each stage works on all that the one before it kept, and its result is
written as Parquet in the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetally.llm import contamination, langid, packing, simhash, surrogates
from stagetally.llm.common import stored, table, written

#: Documents whose best language has less of the decoding weight are ambiguous.
LEAST_SCORE = 0.5
#: Near duplicates are what the registered fingerprint query links.
SHINGLE_WORDS, MOST_BITS = 4, 4
SURROGATE_KEY = "corpus pipeline"
TOKENS = 2048


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters or between languages go."""
    model = langid.train(docs.where(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id"))), "text", "lang")
    found = langid.identified(docs, "text", model)
    return found.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= LEAST_SCORE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles link at 4 or fewer bits: the first in the table."""
    numbered = docs.withColumn("__uid", F.monotonically_increasing_id())
    prints = stored(simhash.fingerprints(numbered, "__uid", "text", words=SHINGLE_WORDS))
    groups = simhash.near_components(prints, ["f0"], radius=MOST_BITS, count=3)
    later = groups.where("key <> component").select(F.col("key").alias("__uid"))
    return numbered.join(later, "__uid", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = contamination.with_hits(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.where(F.size(contamination.HITS) == 0).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates and lengths counted anew."""
    found = surrogates.with_surrogates(docs, "text", SURROGATE_KEY).select(docs.columns)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 2048."""
    return packing.packed_documents(docs, "doc_id", "text", TOKENS).withColumnRenamed("key", "doc_id")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing_stage),
]

#: No stage but the last could be SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
