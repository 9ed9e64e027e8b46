"""Registered queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import pii
from sluice.llm.common import table
from sluice.llm.html_extract import extract
from sluice.llm.jaccard_join import components_sql, similar_components
from sluice.llm.lexical import build, search, search_sql
from sluice.llm.licenses import scan, scan_sql, summary
from sluice.llm.merkle import manifest_of_documents, manifest_sql
from sluice.llm.mixing import mix
from sluice.llm.packing import pack
from sluice.llm.quality import classify
from sluice.llm.suffix_dedup import remove_repeats, remove_repeats_sql
from sluice.llm.syncmers import edit_fingerprints
from sluice.llm.url_rules import judge, mine
from sluice.llm.vptree import nearest, nearest_sql

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))


def op2_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *pii.counts(F.col("base")),
                        F.sha2(pii.as_string(F.col("base")), 256).alias("base_sha256"),
                        pii.as_string(F.col("spans")).alias("spans"))


def op4_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op5_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select("doc_id", *summary(F.col("found")))


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "quality_key.*")


def op8_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels name the page of the same number; bad: low quality or toxic."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    mined = mine(pages.select("page_id", "url").join(labels, "page_id").select("url", "bad"))
    return judge(pages, mined, URL_RULES)


def op10_subset_sum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target",
                        (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_of_documents(table(spark, sf_dir, "documents"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search(build(docs), docs, table(spark, sf_dir, "benchmark"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_syncmer_fingerprints": op2_syncmer_fingerprints,
    "op3_pii": op3_pii,
    "op4_vantage_point_trees": op4_vantage_point_trees,
    "op5_sum_of_squares_packing": op5_sum_of_squares_packing,
    "op6_license_scan": op6_license_scan,
    "op7_importance_resampling": op7_importance_resampling,
    "op8_wrapper_extraction": op8_wrapper_extraction,
    "op9_url_rules": op9_url_rules,
    "op10_subset_sum_mixing": op10_subset_sum_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": components_sql(),
    "op4_vantage_point_trees": nearest_sql(),
    "op6_license_scan": scan_sql(),
    "op11_merkle_manifest": manifest_sql(),
    "op12_ranked_lexical_search": search_sql(),
    "op13_suffix_array_dedup": remove_repeats_sql(),
}
