"""The map from identifiers to pseudonyms, which stays inside the controlled zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.functions.keys import pseudonym
from quern.sources import keyed

SCHEMA = "identifier string, pseudonym string"


def read(spark: SparkSession, root: str) -> DataFrame:
    """(identifier, pseudonym) of the map at ``root``; empty where there is none. Reading writes nothing."""
    return keyed.read(spark, root, SCHEMA).select("identifier", "pseudonym")


def update(ids: DataFrame, root: str, identifier: str, salt: str) -> int:
    """Put the pseudonyms of all identifiers into the map; null identifiers have none. Identifiers that it
    holds keep when they were first seen. Returns the commit's number."""
    real = ids.select(F.col(identifier).cast("string").alias("identifier")).filter("identifier is not null").distinct()
    return keyed.upsert(real.withColumn("pseudonym", pseudonym(F.col("identifier"), salt)), root, "identifier")
