"""The registered queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized, new_folder
from tidewharf.llm import (
    collocations, contamination, divergence, fim, jaccard, languages, licenses, mixing, quality_model, simhash, statements, tokens,
    urls, warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.assigned(table(spark, folder, "documents"), schedule=mixing.CURRICULUM)
    return mixing.by_position(
        rows.select("doc_id", "size", "source_size", "target", "taken", "first_position", "last_position")
    )


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"), templates=licenses.TEMPLATES + licenses.whole_texts())
    return found.select("doc_id", "license", "coverage", "matched_words", "first_word", "last_word", "matched_text")


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(table(spark, folder, "documents"), "doc_id")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.measured(table(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = languages.train(languages.learned_from(docs))
    found = languages.identify(docs, model, "doc_id")
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score", "spans")


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return jaccard.link_components(docs, words=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write(table(spark, folder, "pages"), new_folder(spark, "warc"))
    return warc.checked(materialized(warc.read(archives))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality_model.train(docs, quality_model.learnable(labels), "quality")
    scored = quality_model.score(docs, model, "doc_id")
    return scored.select(
        "doc_id", quality_model.held_out().alias("held_out"), "score",
        (F.col("score") >= quality_model.CUT).cast("int").alias("predicted"),
    )


def op11_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = fim.transform(table(spark, folder, "documents"), "doc_id")
    return cut.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    found = collocations.collocations(table(spark, folder, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_simhash": op11_simhash,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_collocations": op13_collocations,
}
LLM_STATEMENTS: dict[str, str] = {
    "op1_mixing": statements.MIXING,
    "op7_jaccard_join": statements.JACCARD,
    "op9_warc": statements.WARC,
    "op8_decontamination": statements.DECONTAMINATION,
    "op12_fill_in_middle": statements.FILL_IN_MIDDLE,
    "op13_collocations": statements.COLLOCATIONS,
}
