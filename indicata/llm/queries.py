"""One query per operator: ``opN_<name>(spark, sf_dir)`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
LLM_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    LLM_REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, similarity 0.85."""
    from indicata.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 13 words, contaminated from a twentieth of the words."""
    from indicata.llm.decontaminate import benchmark_hits

    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, share=20)
    return hits.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 words."""
    from indicata.llm.substring_dedup import without_repeats

    kept = without_repeats(table(spark, sf_dir, "documents"), size=20)
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 in turn, 150 % of all words, documents at most twice."""
    from indicata.llm.source_mix import weighted_mix

    mix = weighted_mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=(3, 2), repeats=2)
    return mix.select("doc_id", "source", "size", "source_size", "target", "taken")


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from indicata.llm.license_scan import license_scan

    return license_scan(table(spark, sf_dir, "documents")).drop("tag", "places")


@query
def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as records of archives of 1000 ids each, against a replica in which records are damaged by a rule of
    their url's md5: of 128 each, one has a byte changed, one is lost, one has lost its last byte."""
    from indicata.llm.fixity import audit, digest, warc_records, with_offsets

    pages = table(spark, sf_dir, "pages")
    rule = F.conv(F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 2), 16, 10).cast("int") % 128
    torn = (F.when(F.col("rule") == 0, F.overlay("record", F.lit("#"), 1, 1))
            .when(F.col("rule") == 2, F.substring("record", F.lit(1), F.char_length("record") - 1))
            .otherwise(F.col("record")))
    records = warc_records(pages, per_archive=1000).withColumn("rule", rule).withColumn("torn", torn)
    narrow = records.select("page_id", "archive", "rule", "length", digest(F.col("record")).alias("digest"),
                            F.octet_length("torn").cast("long").alias("torn_length"), digest(F.col("torn")).alias("torn_digest"))
    placed = with_offsets(narrow, tie="digest")
    replica = placed.filter("rule <> 1").select("archive", "offset", F.col("torn_length").alias("length"),
                                                F.col("torn_digest").alias("digest"), "page_id")
    return audit(placed.select("archive", "offset", "length", "digest", "page_id"), replica)


@query
def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with the next one's last reply."""
    from indicata.llm.preference import preference_rows, swapped_reply_pairs

    return preference_rows(*swapped_reply_pairs(table(spark, sf_dir, "conversations")))


@query
def op6_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from indicata.llm.syncmers import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents")).drop("anchors", "edited_anchors")


def fold(modulus: int):
    """crc32 of the id as text, modulo ``modulus``."""
    return lambda doc_id: F.crc32(doc_id.cast("string").cast("binary")) % modulus


def _marked(scores: DataFrame, held_out) -> DataFrame:
    return scores.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held out: remainder 0 of 5."""
    from indicata.llm import quality_knn as knn

    docs, part = table(spark, sf_dir, "documents"), fold(5)
    model = knn.fit(docs, table(spark, sf_dir, "labels"), "quality", lambda i: part(i) != 0)
    return _marked(knn.with_scores(docs.select("doc_id", "text"), model), lambda i: part(i) == 0)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held out: remainder 2 of 4."""
    from indicata.llm import toxicity

    docs, part = table(spark, sf_dir, "documents"), fold(4)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", lambda i: part(i) != 2)
    return _marked(toxicity.toxicity_scores(docs, model), lambda i: part(i) == 2)


@query
def op11_distribution_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against references counted over all documents, by language."""
    from indicata.llm.distribution_rules import judged

    return judged(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations after the contract's damage, repaired."""
    from indicata.llm.turn_repair import damaged, repaired

    conversations = table(spark, sf_dir, "conversations")
    return repaired(damaged(conversations), ids=conversations)[0]


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    from indicata.llm.reversed_search import top_documents

    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)
