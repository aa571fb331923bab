"""Versioned snapshots of a table: each write is a new folder, and a numbered commit makes it current."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quern.functions import logs

#: Names that start with an underscore are hidden from Spark's readers.
LOG = "_commits"


def current(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The current snapshot, or an empty table of ``schema``."""
    body = logs.latest(spark, f"{root}/{LOG}")[1]
    return spark.read.parquet(f"{root}/{body['version']}") if body else spark.createDataFrame([], schema)


def publish(df: DataFrame, root: str) -> str:
    """Write ``df`` as a new snapshot and make it current; earlier ones stay, and so do the commits that
    named them. Of two writers the one that commits last is current. Returns the snapshot's name."""
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{root}/{version}")
    while not logs.commit(spark, f"{root}/{LOG}", logs.latest(spark, f"{root}/{LOG}")[0] + 1, {"version": version}):
        pass
    return version


def write_csv(df: DataFrame, path: str) -> None:
    """One folder of CSV parts with a header."""
    df.write.mode("errorifexists").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    """One folder of JSON lines; nested reports keep their shape."""
    df.write.mode("errorifexists").json(path)
