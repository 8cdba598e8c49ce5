"""The registered queries of this folder, one for each operator, and their SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (centroid_clusters, circulant_minhash, collocations, decontaminate, elias_fano, host_reputation,
               jaccard_join, license_scan, mil_quality, one_permutation, quotation_chat, sp_viterbi, store,
               substring_dedup)
from .statements import STATEMENTS

SQL: dict[str, str] = STATEMENTS
#: Held out: one fifth of the ids.
FOLD = "crc32(cast(doc_id as string)) % 5 = 0"
KEPT = 0.3
END_ID = 2
RULES = (host_reputation.Rule("block", "net", "/"), host_reputation.Rule("allow", "example.net", "/en/"),
         host_reputation.Rule("block", "example.com", "/de/"), host_reputation.Rule("allow", "org", "/fr/"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    store.ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, laid out as files: ``<id / 1000>/<id / 25>/``, every 25th one directory up; documents that
    speak of a licence are the licence files."""
    named = F.concat(F.when(F.col("text").rlike("(?i)licen[sc]e"), F.lit("LICENSE.")).otherwise(F.lit("doc.")), "doc_id")
    files = _table(spark, sf_dir, "documents").select(
        F.concat(F.floor(F.col("doc_id") / 1000), F.lit("/"),
                 F.when(F.col("doc_id") % 25 != 0, F.concat(F.floor(F.col("doc_id") / 25), F.lit("/"))).otherwise(F.lit("")),
                 named).alias("path"), "text")
    found = license_scan.scan(files)
    return found.select(F.regexp_extract("path", r"(-?\d+)$", 1).cast("long").alias("doc_id"), "path", "own_license",
                        F.round("score", 6).alias("score"), "license", "origin")


def op2_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(f"not ({FOLD})").select("doc_id", "quality")
    model = mil_quality.train(documents, labels)
    return mil_quality.score(documents.select("doc_id", "text"), model).select(
        "doc_id", F.expr(FOLD).alias("held_out"), "score", (F.col("score") >= KEPT).cast("int").alias("predicted"))


def op3_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    path = store.new_path(spark, "tokens")
    elias_fano.write_tokens(_table(spark, sf_dir, "documents"), path, definition, END_ID)
    return elias_fano.read_tokens(spark, path)


def op4_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_permutation.fingerprints(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the passages that copy a benchmark item; documents without one have no row."""
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_sp_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sp_viterbi.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return sp_viterbi.encode_pieces(_table(spark, sf_dir, "documents").select("doc_id", "text"), pieces)


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is good if the label of its id has quality 1 and is not toxic."""
    outcomes = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.expr("cast(quality = 1 and toxic = 0 as int)").alias("good"))
    return host_reputation.judge(_table(spark, sf_dir, "pages"), outcomes, RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_documents(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def op10_quotation_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation_chat.reply_ordered(_table(spark, sf_dir, "conversations"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.inertia_report(_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_mil_quality, op3_elias_fano, op4_one_permutation, op5_decontaminate, op6_sp_viterbi,
        op7_host_reputation, op8_jaccard_join, op9_substring_dedup, op10_quotation_chat,
        op11_centroid_clusters, op12_collocations, op13_circulant_minhash)}
