"""Running totals and neighbours over a whole table's order without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quern.functions.storage import materialize


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted into ranges, with ``_range``. Written once, so that all that reads it sees the
    same ranges, and nothing stays cached."""
    return materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")


def running_totals(df: DataFrame, order: list[str], sums: list[str]) -> DataFrame:
    """``df`` with ``<name>_before`` for each of ``sums``: the total over the rows that come before.

    A range sums its own rows, and the totals of earlier ranges (one row each) are added. Order keys
    must be unique.
    """
    ranged = _ranged(df, order)
    here = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    heads = totals.select("_range", *[F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}") for s in sums])
    inside = ranged.select("*", *[F.coalesce(F.sum(s).over(here), F.lit(0)).alias(f"{s}_here") for s in sums])
    both = inside.join(F.broadcast(heads), "_range")
    return both.select(*df.columns, *[(F.col(f"{s}_here") + F.col(f"_{s}")).alias(f"{s}_before") for s in sums])


def numbered(df: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """``df`` with ``name``: 1, 2, ... in the order of unique keys."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, ["_one"])
    return counted.select(*df.columns, (F.col("_one_before") + 1).alias(name))


def with_previous(df: DataFrame, order: str, column: str, name: str) -> DataFrame:
    """``df`` with ``name``: ``column`` of the row before in the order of a unique key, null for the
    first. A range's first row takes the last one of the range before."""
    ranged = _ranged(df, [order])
    lasts = ranged.groupBy("_range").agg(F.max_by(column, order).alias("_last"))
    lasts = lasts.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_last"))
    here = F.lag(F.struct(column)).over(Window.partitionBy("_range").orderBy(order))
    both = ranged.withColumn("_here", here).join(F.broadcast(lasts), "_range")
    return both.select(*df.columns, F.when(F.col("_here").isNull(), F.col("_last")).otherwise(F.col(f"_here.{column}")).alias(name))
