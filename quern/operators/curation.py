"""Curation: accept or reject rows with every reason recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.storage import materialize


def with_first_copy(rows: DataFrame, digest: str, name: str) -> DataFrame:
    """``first_copy``: the smallest ``name`` with the same digest, and ``copies``, how many there are.

    An aggregate and a join of two tables, so that Spark can split a digest with very many copies.
    """
    firsts = materialize(rows.groupBy(digest).agg(F.min(name).alias("first_copy"), F.count("*").alias("copies")), "firsts")
    return rows.join(firsts, digest, "left")


def reasons(*checks: tuple[Column, Column | str]) -> Column:
    """The messages of the checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(hit, F.lit(text) if isinstance(text, str) else text) for hit, text in checks]))


def decide(rows: DataFrame, rejecting: Column, warning: Column) -> DataFrame:
    """``decision``, ``reasons`` and ``warnings``; any reason rejects, warnings never do."""
    return rows.withColumn("reasons", rejecting).withColumn("warnings", warning).withColumn("decision", F.when(F.size("reasons") > 0, "rejected").otherwise("accepted"))


def to_process(current: DataFrame, previous: DataFrame, key: str, digest: str = "sha256", force: bool = False) -> DataFrame:
    """``action``: skipped where the digest is that of the previous run, else processed.

    As the skip sees one row alone, decisions that rest on other rows can grow stale; ``force``
    processes all.
    """
    old = previous.select(F.col(key), F.col(digest).alias("old_digest"))
    same = F.coalesce(F.col("old_digest") == F.col(digest), F.lit(False)) & F.lit(not force)
    return current.join(old, key, "left").withColumn("action", F.when(same, "skipped").otherwise("processed")).drop("old_digest")


def state(decided: DataFrame) -> DataFrame:
    """Counts by decision and by reason kind (the part before a colon); 'all' counts rows."""
    all_rows = decided.groupBy("decision").agg(F.count("*").alias("n")).select("decision", F.lit("all").alias("reason"), "n")
    kinds = decided.select("decision", F.explode("reasons").alias("r")).groupBy("decision", F.substring_index("r", ":", 1).alias("reason")).agg(F.count("*").alias("n"))
    return all_rows.unionByName(kinds)
