"""Inventory: classify paths, merge scans into a snapshot, reconcile checksums, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def classify(path: Column, root: str, variants: list[str], attachment: str) -> dict[str, Column]:
    """kind, group_id, variant and item_no of ``root/group/variant/number[attachment].ext``.

    Any other path is metadata, with nulls. A stem that ends in ``attachment`` is an attachment.
    """
    parts = F.split(path, "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    fits = (F.size(parts) == 4) & (F.get(parts, F.lit(0)) == root) & F.get(parts, F.lit(2)).isin(variants)
    attached = stem.contains(attachment)
    number = F.replace(stem, F.lit(attachment), F.lit(""))
    return {
        "kind": F.when(~fits, "metadata").when(attached, "attachment").otherwise("item"),
        "group_id": F.when(fits, F.get(parts, F.lit(1))),
        "variant": F.when(fits, F.get(parts, F.lit(2))),
        "item_no": F.when(fits, number.try_cast("long")),
    }


def merge_scan(known: DataFrame, seen: DataFrame, key: str = "rel_path") -> DataFrame:
    """Every path of either side with ``action``: new, unchanged, updated or missing.

    A path counts as unchanged if its digest and size are; one that is gone stays as missing, with
    its last digest. One full outer join; nothing is deleted.
    """
    old = known.select(key, F.col("sha256").alias("old_sha"), F.col("size_bytes").alias("old_size"))
    both = seen.select(key, "sha256", "size_bytes").join(old, key, "full_outer")
    action = (
        F.when(F.col("old_sha").isNull(), "new")
        .when(F.col("sha256").isNull(), "missing")
        .when((F.col("sha256") == F.col("old_sha")) & (F.col("size_bytes") == F.col("old_size")), "unchanged")
        .otherwise("updated")
    )
    return both.select(key, action.alias("action"), F.coalesce("sha256", "old_sha").alias("sha256"), F.coalesce("size_bytes", "old_size").alias("size_bytes"))


def reconcile(listed: DataFrame, found: DataFrame, key: str = "rel_path", digest: str = "sha256") -> DataFrame:
    """Listed against found digests: verified, mismatched, missing or extra for each path."""
    both = listed.select(key, F.col(digest).alias("listed")).join(found.select(key, F.col(digest).alias("found")), key, "full_outer")
    status = F.when(F.col("listed").isNull(), "extra").when(F.col("found").isNull(), "missing").when(F.col("listed") == F.col("found"), "verified").otherwise("mismatched")
    return both.select(key, status.alias("status"))


def census(rows: DataFrame, group: str, variant: str, variants: list[str]) -> DataFrame:
    """Rows of each group by variant; a variant that a group lacks is 0."""
    return rows.groupBy(group).agg(*[F.count_if(F.col(variant) == v).alias(f"n_{v}") for v in variants])


def directory_summary(files: DataFrame, folder: Column) -> DataFrame:
    """Files and bytes by folder: a cheap fingerprint of a directory."""
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"), F.sum("size_bytes").alias("bytes"))
