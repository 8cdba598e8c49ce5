"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read back by the next."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from procurelens.llm import decontaminate, jaccard_join, mil_quality, queries, sp_viterbi, store, substring_dedup  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches ``queries.KEPT``; labels of the held-out fold are not learnt."""
    store.ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"not ({queries.FOLD})").select("doc_id", "quality")
    model = mil_quality.train(docs, labels)
    name = "quality_score" + "_" * sum(n.startswith("quality_score") for n in docs.columns)
    return mil_quality.score(docs, model, name).where(F.col(name) >= queries.KEPT).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of linked documents."""
    store.ship(spark)
    return jaccard_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words of repeated 35-word windows; one that loses all its words goes."""
    store.ship(spark)
    kept = substring_dedup.without_repeats(docs, keep=docs.columns).where("n_removed = 0 or n_removed < n_words")
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("others.text"))
    new = {"text": text, "n_chars": F.when(cut, F.char_length("kept_text").cast("long")).otherwise(F.col("others.n_chars"))}
    return kept.select([new.get(name, F.col(f"others.`{name}`")).alias(name) for name in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that copies a benchmark item."""
    store.ship(spark)
    leaks = decontaminate.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = store.saved(leaks.select("doc_id").distinct(), "leaks")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's pieces in place of its text."""
    store.ship(spark)
    return sp_viterbi.encode_pieces(docs, sp_viterbi.Pieces.load(public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("piece_ids", piece_ids),
]

#: A learnt classifier is no SQL statement; the tests compare the stages with plain versions, the first with the labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
