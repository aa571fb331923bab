"""Cutting lineage with tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Row groups are small, so that a task which writes long values buffers little.
ROW_GROUP_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, a local master (tests) gets a local
    folder once; on a cluster that is an error, as executors don't share local folders."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        where = spark.sparkContext.getCheckpointDir()
    if not where:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quern-checkpoint-"))
        where = spark.sparkContext.getCheckpointDir()
    return where


def _path(spark: SparkSession, where: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_at_end(spark: SparkSession, where: str) -> None:
    """Have a folder deleted when the application ends."""
    files, target = _path(spark, where)
    files.deleteOnExit(target)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Unlike ``checkpoint()`` the plan runs once and the files are columnar. They outlive lost
    executors and go by ``discard``, or when the application ends.
    """
    spark = df.sparkSession
    where = f"{shared_dir(spark)}/quern/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(where)
    delete_at_end(spark, where)
    table = spark.read.schema(df.schema).parquet(where)
    table._quern_table = where
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that ``materialize`` wrote and that no plan reads any more."""
    for table in tables:
        if where := getattr(table, "_quern_table", None):
            files, target = _path(table.sparkSession, where)
            files.delete(target, True)


def reclaim(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries now. Its cleaner does so when the
    driver's JVM collects garbage, which a driver with little to do puts off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
