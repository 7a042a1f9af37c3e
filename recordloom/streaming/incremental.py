"""Arriving files through the same operators: a file stream whose batches skip what is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.sinks import unfinished


def follow(spark: SparkSession, source: str, schema: StructType, key: str, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Reads new Parquet files of a folder, applies ``work`` to rows whose key the target lacks, and appends.

    A batch that is run again after a failure finds its keys in the target and adds
    nothing, so each key is written once.
    """

    def each(batch: DataFrame, _: int) -> None:
        try:
            done = spark.read.parquet(target).select(key)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            done = batch.select(key).limit(0)
        work(unfinished(batch.dropDuplicates([key]), done, key)).write.mode("append").parquet(target)

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
