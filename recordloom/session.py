"""Session defaults, and reading the tables of a folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(name: str = "recordloom", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``; a temporary one only on a plain local master without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="recordloom-")
    sc.setCheckpointDir(folder)
    return folder


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def tidy(spark: SparkSession) -> bool:
    """Has the driver's JVM collect its garbage: the files of finished shuffles and broadcasts go with the objects that stand for them, and the heap shrinks.

    What its compilers and buffers have freed goes back to the system too, where the
    JVM can do that (HotSpot on Linux); the C library would keep it. Whether it did is
    returned.
    """
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    try:
        kind = jvm.java.lang.Class.forName
        names = ["javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"]
        types, args = _array(spark, jvm.java.lang.Class, len(names)), _array(spark, jvm.java.lang.Object, len(names))
        for k, name in enumerate(names):
            types[k] = kind(name)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # through the interface: the server's class isn't open to callers
        kind("javax.management.MBeanServerConnection").getMethod("invoke", types).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
        return True
    except Py4JError:
        return False


def _array(spark: SparkSession, kind, n: int):
    return spark.sparkContext._gateway.new_array(kind, n)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Marks a folder to go when the session's JVM ends, whether it is there already or not."""
    fs, p = _path(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage: a table in the shared folder, computed once and removed when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Dealt anew only if a scan has fewer partitions than the session has cores: a large table is left where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
