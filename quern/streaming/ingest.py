"""An extension: incremental ingest of inventory files with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.sources import keyed

INVENTORY = "rel_path string, sha256 string, size_bytes bigint"


def merge_batch(batch: DataFrame, root: str) -> None:
    """Put one micro-batch of seen files into the inventory at ``root``: a commit that rewrites the buckets
    it touches. Files that it doesn't hold stay as they are.

    A file seen twice in a batch counts once, with the digest that is largest. Merging a batch again
    gives the same files, so a restart may repeat it.
    """
    seen = batch.groupBy("rel_path").agg(F.max(F.struct("sha256", "size_bytes")).alias("f")).select("rel_path", "f.*")
    keyed.upsert(seen, root, "rel_path")


def ingest(spark: SparkSession, source: str, root: str, checkpoint: str):
    """A query that merges inventory rows (Parquet files in ``source``) as they arrive."""
    stream = spark.readStream.schema(INVENTORY).parquet(source)
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: merge_batch(df, root)).start()


def event_rates(events: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by kind and hour; rows later than the watermark are dropped. Works on streams and tables."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
