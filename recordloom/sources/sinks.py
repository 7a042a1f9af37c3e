"""Writers: records, provenance, gated and incremental outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..session import _path, cut, delete


def write_records(records: DataFrame, path: str) -> None:
    """One JSON object a line, UTF-8 as it is."""
    records.select(F.to_json(F.struct(*records.columns)).alias("value")).write.mode("overwrite").text(path)


def write_provenance(docs: DataFrame, path: str) -> None:
    """doc_id, sha256, n_chars, and whether the text drifted from its declared hash; rows that the table has already aren't written again."""
    rows = docs.select("doc_id", F.sha2("text", 256).alias("sha256"), F.length("text").alias("n_chars"), (F.col("declared") != F.sha2("text", 256)).alias("drifted"))
    done = _table(rows, path)
    rows = rows.alias("a").join(done.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.sha256").eqNullSafe(F.col("b.sha256"))), "left_anti")
    rows.write.mode("append").parquet(path)


def write_checked(df: DataFrame, path: str) -> None:
    """Writes beside the target, reads back, and only then takes the old table's place; a table that didn't come back equal is refused and the old one stays."""
    spark = df.sparkSession
    df = cut(df)  # computed once
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(beside)
    both = df.withColumn("__n", F.lit(1)).union(spark.read.parquet(beside).select(*df.columns).withColumn("__n", F.lit(-1)))
    if not both.groupBy(*df.columns).agg(F.sum("__n").alias("__n")).where("__n != 0").isEmpty():
        delete(spark, beside)
        raise ValueError(f"{path} doesn't read back as it was written")
    delete(spark, path)
    fs, source = _path(spark, beside)
    if not fs.rename(source, _path(spark, path)[1]):
        raise OSError(f"{beside} holds the table, but couldn't be renamed to {path}")


def _table(like: DataFrame, path: str) -> DataFrame:
    """The table at a path, or an empty one."""
    try:
        return like.sparkSession.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return like.limit(0)


def output_states(expected: DataFrame, present: DataFrame) -> DataFrame:
    """(path, hash) on both sides -> path, state: new, orphan, stale or current."""
    e, p = expected.select("path", F.col("hash").alias("e")), present.select("path", F.col("hash").alias("p"))
    return e.join(p, "path", "full_outer").select("path", F.when(F.col("p").isNull(), "new").when(F.col("e").isNull(), "orphan").when(F.col("e") != F.col("p"), "stale").otherwise("current").alias("state"))


def unfinished(todo: DataFrame, done: DataFrame, key: str, redo: bool = False) -> DataFrame:
    """What still has to be done; everything with redo."""
    return todo if redo else todo.join(done.select(key).distinct(), key, "left_anti")


def write_once(df: DataFrame, path: str, key: str, redo: bool = False) -> None:
    """A snapshot kept once: appends the rows whose key the table lacks; with redo it is written anew."""
    if redo:
        df.write.mode("overwrite").parquet(path)
        return
    unfinished(df, _table(df, path), key).write.mode("append").parquet(path)
