"""Label store: wide labels to long rows with provenance, look-up, distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

TAXONOMY_SCHEMA = "code string, display_name string, category string, description string, source_column string"


def unpivot_labels(wide: DataFrame, taxonomy: DataFrame, keys: list[str], annotator: str, source_file: str) -> DataFrame:
    """One row for each annotation and term: annotation_id, keys, label_code, value and provenance.

    The id is a hash of the natural key, so loading again gives the same rows. A term whose column
    ``wide`` lacks has no rows.
    """
    columns = [r["source_column"] for r in taxonomy.select("source_column").collect() if r["source_column"] in wide.columns]
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("source_column"), F.col(c).cast("int").alias("value")) for c in columns]))
    identity = F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(source_file), F.lit(annotator)), 256)
    long = wide.select(F.substring(identity, 1, 16).alias("annotation_id"), *keys, cells.alias("cell")).select("annotation_id", *keys, "cell.*")
    named = long.join(taxonomy.select("source_column", F.col("code").alias("label_code")), "source_column")
    return named.select("annotation_id", *keys, "label_code", "value", F.lit(annotator).alias("annotator"), F.lit(source_file).alias("source_file"))


def invalid_values(long: DataFrame) -> DataFrame:
    """Rows whose value isn't 0 or 1; a load must have none."""
    return long.filter(~F.coalesce(F.col("value").isin(0, 1), F.lit(False)))


def lookup(long: DataFrame, taxonomy: DataFrame, keys: list[str], main_category: str) -> DataFrame:
    """One row for each annotation: labels as a map, positive codes, those of the main category, and
    whether there is none of it."""
    known = long.join(taxonomy.select(F.col("code").alias("label_code"), "category"), "label_code")
    on = F.col("value") == 1
    grouped = known.groupBy("annotation_id", *keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label_code", "value")))).alias("labels"),
        F.array_sort(F.collect_list(F.when(on, F.col("label_code")))).alias("positive"),
        F.array_sort(F.collect_list(F.when(on & (F.col("category") == main_category), F.col("label_code")))).alias("main_positive"),
    )
    return grouped.withColumn("none_of_main", F.size("main_positive") == 0)


def distribution(long: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Positives and totals of every code of the taxonomy; a code without labels has 0 and 0."""
    counts = long.groupBy(F.col("label_code").alias("code")).agg(F.sum("value").alias("positives"), F.count("*").alias("total"))
    joined = taxonomy.select("code", "category").join(counts, "code", "left")
    return joined.select("code", "category", F.coalesce("positives", F.lit(0)).cast("long").alias("positives"), F.coalesce("total", F.lit(0)).alias("total"))


def upsert(known: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``known`` with the rows of ``new`` in place of those of the same keys, and the others added."""
    return known.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
