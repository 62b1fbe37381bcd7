"""The corpus pipeline: five stages over the documents table, each calling one of the operators of callpulse.llm.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written as Parquet and reread as the next stage's docs. All but the last keep the
columns of documents, extra ones included.

Rows without doc_id or with a null text pass or go by the rules of each
operator: a null text has no language and goes in the first stage; a row without
doc_id is no duplicate of anything and stays. Exact repeats of a row share a
doc_id, count as one document, and stay or go together. An empty table gives
empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.llm.bpe import encode_texts
from callpulse.llm.decontaminate import leaks
from callpulse.llm.language_id import DIMENSIONS, free_name, predict, train
from callpulse.llm.minhash import near_duplicates
from callpulse.llm.queries import tokenizer_path
from callpulse.llm.suffix_dedup import strip_repeated_bytes
from callpulse.llm.workspace import Workspace, owned

#: not expressible in SQL (trained language profiles, tokenizer); tested against a brute-force version
ORACLE_SQL = None


def _written(spark: SparkSession, rows: DataFrame, mine: list[Workspace]) -> DataFrame:
    """The rows in a table of their own; the tables that led to them go. The stage's result needs nothing else."""
    table = Workspace(spark, "decisions").table(rows, "gone")
    for work in mine:
        work.drop()
    return table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a recognisable language (no letter) go; a missing lang is filled in.

    If there was no row to learn from, texts with a letter stay and a missing lang stays missing.
    """
    pred, score = free_name("lang", docs.columns), free_name("score", docs.columns)
    # one language without a name stands for those that could not be learned
    found = predict(docs, train(docs) or {"": np.zeros(DIMENSIONS)}, (pred, score)).where(F.col(pred) != "und")
    return found.withColumn("lang", F.coalesce("lang", F.nullif(F.col(pred), F.lit("")))).select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest doc_id."""
    with owned() as mine:
        groups = near_duplicates(docs)
    gone = _written(spark, groups.where("not kept").select(F.col("doc_id").alias("__gone")).distinct(), mine)
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that occur earlier in the corpus are taken out of the texts."""
    return strip_repeated_bytes(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    with owned() as mine:
        found = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = _written(spark, found.select(F.col("doc_id").alias("__gone")).distinct(), mine)
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text, with digests of the ids and of the decoded text."""
    return encode_texts(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each result but the last is written and reread.

    A stage's own tables go when its result has been written, and so does the result before it.
    """
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        with owned() as mine:
            docs = work.table(stage(spark, docs, sf_dir), name)
        for w in mine:
            w.drop()
        if k:
            work.delete(STAGES[k - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
