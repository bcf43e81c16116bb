"""The queries of the corpus operators: whole tables in, full results out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import contamination, langid, neighbours, oracles, packing, pages, ranking, repeats, retrieval, secrets, sharding
from . import simhash, sources, surrogates
from .common import stored, table

#: The key of the registered query; users bring their own, and keep it.
SURROGATE_KEY = "registered query"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    prints = stored(simhash.fingerprints(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return simhash.near_components(prints, ["f0"], radius=4, count=3).select(
        F.col("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every vector whose id is divisible by 20."""
    return neighbours.nearest(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding", lambda key: key % 20 == 0, k=20
    )


def op3_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = pages.main_texts(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return found.select(
        F.col("page").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, packed into sequences of at most 2048."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed(
        "key", "doc_id"
    )


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text unit that an earlier document, or the same one, holds already."""
    return repeats.repeated_units(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("rank").alias("doc_id"),
        "start",
        "end",
        F.col("first_rank").alias("first_doc_id"),
        "first_start",
    )


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All places that repeat an earlier paragraph, line or longer sentence, merged, and where the first copy begins."""
    return repeats.repeated_passages(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("rank").alias("doc_id"), "start", "end", F.col("first_rank").alias("first_doc_id"), "first_start"
    )


def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.with_hits(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select("doc_id", F.explode(contamination.HITS).alias("hit")).select("doc_id", "hit.*")


def op7_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents moved from 12 shards by hash to 16 of equal bytes."""
    text = F.col("text")
    docs = stored(
        table(spark, sf_dir, "documents").select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            sharding.old_layout(F.col("doc_id"), 12).alias("old_shard"),
        )
    )
    return sharding.resharded(docs, "old_shard", "size", lambda total: sharding.even_capacities(total, 16)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced, and where it was."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = surrogates.with_surrogates(docs, "text", SURROGATE_KEY)
    spans = F.transform(surrogates.ENTITIES, lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string")))
    return found.select(
        "doc_id",
        "text",
        F.size(surrogates.ENTITIES).alias("n_entities"),
        F.array_join(spans, ",").alias("entities"),
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        F.col("key").alias("doc_id"),
        *(secrets.count_of(F.col("base"), p.kind).alias(f"n_{p.kind}") for p in secrets.PATTERNS),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("all")).alias("spans"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out, and whether another one is near."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id"))), "text", "lang")
    return langid.identified(docs, "text", model).select(
        "doc_id",
        langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
        F.col("__lead").alias("lead"),
        (F.col("__lead") < langid.LEAST_LEAD).alias("ambiguous"),
    )


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return ranking.ranked(docs, "doc_id", "text", items, "item_id", "text", k=10).withColumnRenamed("key", "doc_id")


def op12_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in windows of at most 1024, next to their lexical neighbours."""
    return retrieval.packed_with_neighbours(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed(
        "key", "doc_id"
    )


def op13_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every source of a language differs from the other sources and from the language."""
    return sources.divergence(table(spark, sf_dir, "documents"), "lang", "source", "text")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_neighbours": op2_neighbours,
    "op3_pages": op3_pages,
    "op4_packing": op4_packing,
    "op5_passages": op5_passages,
    "op5_repeats": op5_repeats,
    "op6_contamination": op6_contamination,
    "op7_resharding": op7_resharding,
    "op8_surrogates": op8_surrogates,
    "op9_secrets": op9_secrets,
    "op10_language": op10_language,
    "op11_ranking": op11_ranking,
    "op12_retrieval": op12_retrieval,
    "op13_sources": op13_sources,
}
ORACLES: dict[str, str] = {"op11_ranking": oracles.RANKING, "op13_sources": oracles.SOURCES}
