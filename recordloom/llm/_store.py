"""Materialising intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut, delete, shared_dir, tidy  # noqa: F401  cut is for the operators


#: After so many tables what their making has left behind is collected.
TIDY = 8


class Stash:
    """Parquet tables in the shared folder that live as long as the ``with`` block."""

    def __init__(self, spark: SparkSession):
        self.spark, self.saved = spark, 0
        self.root = f"{shared_dir(spark).rstrip('/')}/stash-{uuid.uuid4().hex}"

    def __enter__(self) -> "Stash":
        return self

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.saved += 1
        if self.saved % TIDY == 0:
            tidy(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        delete(self.spark, f"{self.root}/{name}")

    def __exit__(self, *exc) -> None:
        delete(self.spark, self.root)
        tidy(self.spark)


def pieces(spark: SparkSession, per_core: int = 1) -> int:
    """A partition count that follows the session's setting (the cluster sizes it to its data)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * per_core)


def first_by_hash(rows: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The n rows with the smallest hash of ``columns`` (all rows if fewer); a threshold first leaves few to order, however many partitions there are."""
    count = rows.count()
    hashed = rows.withColumn("__h", F.xxhash64(*columns))
    if count > 4 * n:
        hashed = hashed.where(F.col("__h") < F.lit(int(-(1 << 63) + (2 * n / count) * 2.0**64)))
    return hashed.orderBy("__h", *columns).limit(n).drop("__h")


def most(counted: DataFrame) -> tuple[int, int]:
    """The greatest c and the sum of c; zeros for an empty table."""
    got = counted.agg(F.max("c"), F.sum("c")).first()
    return got[0] or 0, got[1] or 0


def hot_join(big: DataFrame, small: DataFrame, keys: list[str], greatest: tuple[int, int] | None = None) -> DataFrame:
    """big joined with small, which has one row and in c the number of big's rows for each key.

    Keys with more than a thousandth of the rows (and more than a thousand), so at
    most a thousand keys, are broadcast: none of them gathers its rows in one task.
    Both sides are read twice then and so should be saved.
    """
    top, total = greatest or most(small)
    limit = max(1000, total // 1000)
    if top <= limit:
        return big.join(small, keys)
    hot = F.broadcast(small.where(F.col("c") > limit))
    rest = big.join(F.broadcast(small.where(F.col("c") > limit).select(*keys)), keys, "left_anti").join(small.where(F.col("c") <= limit), keys)
    return big.join(hot, keys).unionByName(rest)
