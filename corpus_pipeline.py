"""A training-data pipeline over ``documents``: each stage applies one operator to all that the stage before kept.

A stage is a function of (spark, docs, sf_dir); what it returns is written as
Parquet and read again as the next one's docs. Each decision takes effect: rows go,
or texts lose lines. All but the last return the columns of ``documents``.

Rows that agree in all columns stay as many as they are; decisions are by doc_id, so
rows of one id stay or go together, but for the quality stage, where each row's text
is scored. A null id names no document: such rows are scored, lose repeated lines and
are found by the benchmark search, but are nobody's near duplicate, and a hit in one
takes all of them. Null texts are empty. Other columns of docs are dropped, whatever
their names. Empty tables give empty tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.llm import queries as Q
from recordloom.llm.decontaminate import decontaminate
from recordloom.llm.line_dedup import line_dedup
from recordloom.llm.mixing import mix
from recordloom.llm.ngram_join import ngram_jaccard_join
from recordloom.llm.quality import score, train
from recordloom.session import delete, delete_at_end, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _shaped(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of label 0 go."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, extra=tuple(COLUMNS)).where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of later copies of repeated runs go, and so do documents that were nothing else."""
    out = line_dedup(_shaped(docs))
    emptied = (F.size("removed") > 0) & (F.length(F.trim(F.regexp_replace("kept_text", r"\s+", ""))) == 0)
    return out.where(~F.coalesce(emptied, F.lit(False))).withColumn("text", F.col("kept_text")).withColumn("n_chars", F.coalesce(F.length("kept_text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    groups = ngram_jaccard_join(docs).where("doc_id IS NOT NULL AND component_id != doc_id").select("doc_id").distinct()
    return _shaped(docs).join(groups, "doc_id", "left_anti").select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    hits = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("hit")).distinct()
    return _shaped(docs).join(hits, F.col("doc_id").eqNullSafe(F.col("hit")), "left_anti").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest mixed to the target weights: documents' columns with domain, tokens and epoch."""
    return mix(Q.with_domain(_shaped(docs)), Q.WEIGHTS, F.col("total") * Q.SHARE, Q.EPOCHS)


STAGES = [("quality", quality), ("line dedup", lines), ("n-gram join", near_duplicates), ("decontamination", benchmark), ("mixing", mixture)]
#: Learned models and hashed retrieval have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``. A stage's table goes when the next one is written, the last one with the session."""
    root = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    delete_at_end(spark, root)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        if k:
            delete(spark, f"{root}/{k - 1}")
    return docs
