"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from usagelens.llm import (
    byte_bpe, chat, decontaminate, filter_audit, host_rules, html_template, importance, license_dice, separator_scan,
    token_shards, url_model,
)
from usagelens.llm.minhash_dedup import near_duplicates
from usagelens.llm.oracles import OP2, OP3, OP5, OP11, OP12, OP13, url_model_sql
from usagelens.llm.shared import shared_path, table
from usagelens.llm.substring_dedup import remove_repeats

END_OF_DOCUMENT = 50256  # <|endoftext|> of byte_bpe_50k


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.quality(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc.doc_id", *[f"counts.{c}" for c in host_rules.COUNTS],
                         "base_failed", "host_n", "host_failed", "kept")


def op4_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def op5_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_dice.scan(table(spark, sf_dir, "documents"))


def op6_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "flat-tokens")
    separator_scan.write_flat(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                              END_OF_DOCUMENT, header=True)
    return separator_scan.count_tokens(spark, path, END_OF_DOCUMENT, header=True).select("doc_id", "n_tokens")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


URL_RULES = [url_model.Rule("net", "/", "block"), url_model.Rule("example.net", "/en/", "allow"),
             url_model.Rule("example.com", "/de/", "block"), url_model.Rule("org", "/fr/", "allow")]


def op9_url_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-shards")
    token_shards.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_shards.digests(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed",
                       F.when(F.col("kept").isNull(), F.col("words_sha256")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_chat_render": op2_chat_render,
    "op3_host_rules": op3_host_rules,
    "op4_html_template": op4_html_template,
    "op5_license_dice": op5_license_dice,
    "op6_separator_scan": op6_separator_scan,
    "op7_decontaminate": op7_decontaminate,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_url_model": op9_url_model,
    "op10_token_shards": op10_token_shards,
    "op11_importance": op11_importance,
    "op12_filter_audit": op12_filter_audit,
    "op13_substring_dedup": op13_substring_dedup,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_chat_render": OP2,
    "op3_host_rules": OP3,
    "op5_license_dice": OP5,
    "op9_url_model": url_model_sql(URL_RULES),
    "op11_importance": OP11,
    "op12_filter_audit": OP12,
    "op13_substring_dedup": OP13,
}
