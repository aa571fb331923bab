"""Paths inside or above others, by intervals over the sorted tree of paths.

In the order of paths whose separator sorts before every other letter, all that lies inside a folder
stands in one stretch right behind it. So what is inside a folder is a range of places, and a range is
matched with places over slices of the order, however deep or wide the tree is. Null paths match nothing,
and a slash at a path's end doesn't count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.ordered import running_totals
from quern.functions.storage import materialize

#: The separator as a letter that sorts first; what sorts behind all inside a folder.
FIRST, BEHIND = "\x01", "\x02"


def sort_key(path: Column) -> Column:
    """The path with its separators first in order; a slash at its end doesn't count."""
    return F.replace(F.rtrim(path, F.lit("/")), F.lit("/"), F.lit(FIRST))


def ends(key: Column) -> tuple[Column, Column]:
    """The stretch [from, to) of all that lies inside."""
    return F.concat(key, F.lit(FIRST)), F.concat(key, F.lit(BEHIND))


def numbered_tree(paths: DataFrame) -> DataFrame:
    """(``path``, ``low``, ``high``) of distinct paths: places in the tree's order, such that p lies inside q
    just where q.low < p.low <= q.high. Places are counted over ranges, none in one task."""
    keyed = paths.select("path", sort_key(F.col("path")).alias("key")).filter("path is not null").distinct()
    marks = keyed.select("path", "key", F.lit(1).cast("long").alias("one"), F.lit(0).alias("closing")).union(
        keyed.select("path", ends(F.col("key"))[1], F.lit(0).cast("long"), F.lit(1))
    )
    counted = running_totals(marks, ["key", "closing", "path"], ["one"])
    return counted.groupBy("path").agg(
        (F.min(F.when(F.col("closing") == 0, F.col("one_before"))) + 1).alias("low"),
        F.max(F.when(F.col("closing") == 1, F.col("one_before"))).alias("high"),
    )


def newest_touching(runs: DataFrame, targets: DataFrame) -> DataFrame:
    """(``target``, ``seq``, ``run_id``): for each target (with ``before_seq``) the newest earlier run whose
    ``changed`` path is the target, lies inside it, or holds it. A run's row whose ``coarse`` is true
    stands for changes that weren't listed: it counts for what it holds alone.

    What lies inside a target is a range of places, cut at slices of the order; what holds it are the
    folders above, of which it has few. So no row of ``runs`` is copied in either direction.
    """
    coarse = F.col("coarse") if "coarse" in runs.columns else F.lit(False)
    own = runs.select("seq", "run_id", "changed", coarse.alias("coarse"))
    tree = materialize(numbered_tree(own.select(F.col("changed").alias("path")).union(targets.select("target"))), "path-tree")
    places = tree.agg(F.max("low").alias("n")).first()["n"] or 0
    width = max(1, int(places**0.5))
    low, high = F.col("low"), F.col("high")
    at = own.filter(~F.col("coarse")).join(tree, F.col("changed") == F.col("path")).select("seq", "run_id", low.alias("place"), F.floor(low / width).alias("slice"))
    to = targets.join(tree, F.col("target") == F.col("path"))
    ranges = to.select("target", "before_seq", "low", "high", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))).alias("slice"))
    inside = ranges.join(at, "slice").filter("place between low and high")
    above = targets.select("target", "before_seq", F.explode(folders_above(F.col("target"))).alias("changed")).join(own, "changed")
    hits = inside.select("target", "before_seq", "seq", "run_id").union(above.select("target", "before_seq", "seq", "run_id")).filter("seq < before_seq")
    newest = hits.groupBy("target").agg(F.max(F.struct("seq", "run_id")).alias("m"))
    return newest.select("target", "m.run_id", "m.seq")


def folders_above(path: Column) -> Column:
    """The path and every folder that holds it."""
    parts = F.split(F.rtrim(path, F.lit("/")), "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
