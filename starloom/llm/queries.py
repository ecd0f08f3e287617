"""The registered queries of this folder, ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (cross_polytope, decontaminate, entropy_mix, fill_in_middle, katz, lexical_search, minhash_join,
                          ngram_jaccard, secret_scan, sharding, substring_dedup, toxicity, warc_revisit)
from starloom.llm.common import table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under a model of those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return katz.score(docs, held)


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th embedding."""
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.place(docs).select("doc_id", "shard")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of held-out rows are not learned."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        toxicity.threshold(model, F.col("lang")).alias("lang_threshold"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, those that repeated windows cover, and the digest of the rest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).drop("kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in every document."""
    return secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit of the crawl that the pages make, resolved."""
    return warc_revisit.resolve(warc_revisit.captures(table(spark, sf_dir, "pages")))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target of every document's source and the words the mix takes of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return entropy_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's fill-in-the-middle text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle.transform(docs, texts=False)


def op12_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document, and whether it is the one kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_jaccard, op2_katz, op3_cross_polytope, op4_sharding, op5_toxicity, op6_substring_dedup,
                            op7_decontamination, op8_secret_scan, op9_warc_revisit, op10_source_mix, op11_fill_in_middle,
                            op12_minhash_join, op13_lexical_search)}
