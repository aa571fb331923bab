"""Fingerprints of file trees that add up, and differences that look only where something changed.

A folder's digest is the sum, modulo 2^256, of the SHA-256 of its files' entries (path below the root
and state). Sums need no order and no list of paths: tasks add what they see, and Spark adds the sums.
Each file counts for every folder above it, so the sum of a folder stands for all that it holds.
An empty tree has the digest of nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.digests import LANES, lanes, summed, total
from quern.functions.storage import materialize

#: The folder that holds all.
TOP = ""


def entry(path: Column, *state: Column) -> Column:
    """The digest of one file: its path and what it should be told by."""
    return F.sha2(F.concat_ws("\n", path, *[F.coalesce(s.cast("string"), F.lit("")) for s in state]), 256)


def _entries(files: DataFrame, state: list[str], path: str) -> DataFrame:
    slim = files.select(F.col(path).alias("path"), F.coalesce(F.col("size_bytes"), F.lit(0)).alias("size"), entry(F.col(path), *[F.col(s) for s in state]).alias("_entry"))
    return slim.select("path", "size", *lanes(F.col("_entry")))


def fingerprint(files: DataFrame, state: list[str], path: str = "rel_path") -> DataFrame:
    """One row: ``n_files``, ``bytes`` and ``digest`` of all files."""
    totals = _entries(files, state, path).agg(F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), *summed())
    return totals.select("n_files", "bytes", total().alias("digest"))


def folders(files: DataFrame, state: list[str], path: str = "rel_path") -> DataFrame:
    """(``folder``, ``parent``, ``depth``, ``n_files``, ``bytes``, ``digest``, ``own``) of the top and every
    folder below: ``digest`` over all files inside, ``own`` over those that stand in it directly."""
    parts = F.split("path", "/")
    depth = F.size(parts) - 1
    above = F.transform(F.sequence(F.lit(0), depth), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    spread = _entries(files, state, path).select("path", "size", *[f"lane{k}" for k in range(LANES)], depth.alias("deepest"), F.posexplode(above).alias("depth", "folder"))
    direct = F.col("deepest") == F.col("depth")
    own = [F.sum(F.when(direct, F.col(f"lane{k}")).otherwise(0)).alias(f"own{k}") for k in range(LANES)]
    totals = spread.groupBy("folder", "depth").agg(F.count("*").alias("n_files"), F.sum("size").alias("bytes"), *summed(), *own)
    both = totals.withColumn("digest", total()).drop(*[f"lane{k}" for k in range(LANES)]).withColumnsRenamed({f"own{k}": f"lane{k}" for k in range(LANES)})
    parent = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == 1, TOP).otherwise(F.regexp_extract("folder", "^(.*)/[^/]*$", 1))
    return both.select("folder", parent.alias("parent"), "depth", "n_files", "bytes", "digest", total().alias("own"))


def changed_folders(before: DataFrame, after: DataFrame) -> DataFrame:
    """(``folder``, ``direct``) of what ``folders`` gave at two times: folders that hold a change, and
    whether it stands in them directly. From the top down: below a folder with an equal digest nothing
    is looked at."""
    state = F.struct("n_files", "digest", "own")
    a, b = (t.select("folder", "parent", "depth", state.alias(n)) for t, n in ((before, "a"), (after, "b")))
    level = 0
    front = before.sparkSession.createDataFrame([(TOP,)], "front string")
    found = None
    while True:
        here = lambda t: t.filter(F.col("depth") == level).join(front, F.coalesce("parent", F.lit(TOP)) == F.col("front"), "left_semi").drop("parent", "depth")  # noqa: B023,E731
        both = here(a).join(here(b), "folder", "full_outer")
        differs = ~F.col("a").eqNullSafe(F.col("b"))
        none = F.lit("0" * 64)  # a folder that isn't there has no files of its own
        direct = F.coalesce("a.own", none) != F.coalesce("b.own", none)
        now = materialize(both.filter(differs).select("folder", direct.alias("direct")), "changed-folders")
        found = now if found is None else found.union(now)
        if now.isEmpty():
            return found
        front, level = now.select(F.col("folder").alias("front")), level + 1


def changes(before: DataFrame, after: DataFrame, state: list[str], path: str = "rel_path") -> DataFrame:
    """(``path``, ``change``): created, deleted or modified in ``state``, from files of changed folders alone."""
    touched = materialize(changed_folders(materialize(folders(before, state, path), "folders"), materialize(folders(after, state, path), "folders")), "touched").filter("direct").select("folder")
    own = F.regexp_extract(F.col(path), "^(.*)/[^/]*$", 1)
    here = lambda t, n: t.select(path, F.struct(*state).alias(n), own.alias("folder")).join(touched, "folder", "left_semi").select(path, n)
    change = F.when(F.col("a").isNull(), "created").when(F.col("b").isNull(), "deleted").when(~F.col("a").eqNullSafe(F.col("b")), "modified")
    return here(before, "a").join(here(after, "b"), path, "full_outer").select(path, change.alias("change")).filter("change is not null")
