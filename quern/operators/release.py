"""Releases: stratified group split, index, statistics, immutable snapshot, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quern.functions.keys import ratio, shuffle_key
from quern.operators import identifiers

SPLITS = ("train", "validation", "test")


def strata(labels: DataFrame, group: str, flag: Column, other: Column | None = None) -> DataFrame:
    """Items, positive items and whether there is any, for each group."""
    more = [F.max(other.cast("int")).alias("any_other")] if other is not None else []
    return labels.groupBy(group).agg(F.count("*").alias("n_items"), F.count_if(flag).alias("n_positive"), F.max(flag.cast("int")).alias("any_positive"), *more)


def stratified_split(groups: DataFrame, group: str, stratum: str, seed: int, train: float = 0.70, validation: float = 0.15) -> DataFrame:
    """(group, stratum, split): every group in one split, the ratios held within each stratum.

    Groups stand in the order of a keyed hash, so the split is the same for any input order and any
    run with the seed. The first round(n * train) are train, up to round(n * (train + validation))
    validation, the rest test, with halves rounded to even; a lone group is train.
    """
    placed = places(groups, group, stratum, seed)
    at, n = F.col("_at"), F.col("_total").cast("double")
    first, second = F.bround(n * train), F.bround(n * (train + validation))
    return placed.select(group, stratum, F.when(at <= first, "train").when(at <= second, "validation").otherwise("test").alias("split"))


def places(groups: DataFrame, group: str, stratum: str, seed: int) -> DataFrame:
    """(group, stratum, _at, _total): each group's place in its stratum by a keyed hash, and how many
    groups the stratum has. Places are counted over slices of the hash's range."""
    keyed = groups.select(group, stratum).withColumn("_key", shuffle_key(seed, F.col(stratum), F.col(group))).withColumn("_slice", F.substring("_key", 1, 2))
    slices = keyed.groupBy(stratum, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(stratum).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    heads = slices.select(stratum, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"), F.sum("_n").over(Window.partitionBy(stratum)).alias("_total"))
    place = F.row_number().over(Window.partitionBy(stratum, "_slice").orderBy("_key", group))
    placed = keyed.withColumn("_place", place).join(heads, [stratum, "_slice"])
    return placed.select(group, stratum, (F.col("_place") + F.col("_ahead")).alias("_at"), "_total")


def overlaps(assignment: DataFrame, group: str) -> DataFrame:
    """Groups in more than one split; a release must have none."""
    return assignment.groupBy(group).agg(F.count_distinct("split").alias("n_splits")).filter("n_splits > 1")


def index(files: DataFrame, decisions: DataFrame, labels: DataFrame, assignment: DataFrame, tokens: DataFrame, group: str, item: str) -> DataFrame:
    """Accepted files that aren't missing, with split, pseudonymous path and labels (null where an
    item has none)."""
    accepted = files.filter("status <> 'missing'").join(decisions.filter("decision = 'accepted'").select("rel_path"), "rel_path", "left_semi")
    named = accepted.join(tokens, group).join(assignment.select(group, "split"), group)
    path = F.concat_ws("/", "pseudonym", "variant", F.concat(F.col(item).cast("string"), F.lit(".txt")))
    joined = named.join(labels, item, "left")
    rest = [c for c in labels.columns if c != item]
    return joined.select(F.col("pseudonym").alias("patient"), "split", "variant", item, path.alias("path"), "sha256", *rest)


def select(rows: DataFrame, text: str | None = None, text_columns: tuple[str, ...] = (), **wanted: object) -> DataFrame:
    """Rows of an index that meet the conditions that are given: ``column=value``, ``column=[values]``, and
    ``text`` anywhere in one of ``text_columns`` (any case). A condition that is None isn't made. Equalities
    reach the files' reader."""
    for column, value in wanted.items():
        if value is not None:
            rows = rows.filter(F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(column) == value)
    if text is not None and text_columns:
        found = [F.contains(F.lower(F.col(c).cast("string")), F.lit(text.lower())) for c in text_columns]
        rows = rows.filter(F.coalesce(F.greatest(*found) if len(found) > 1 else found[0], F.lit(False)))
    return rows


def split_statistics(rows: DataFrame, assignment: DataFrame, groups: DataFrame, group: str, positive: Column) -> DataFrame:
    """Groups of each split (from the assignment) and items, positives and rate (from the index);
    all three splits always appear, a rate without items is 0."""
    names = rows.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    by_group = assignment.select(group, "split").join(groups.select(group, "any_positive"), group).groupBy("split").agg(F.count("*").alias("n_groups"), F.sum("any_positive").alias("n_positive_groups"))
    by_item = rows.groupBy("split").agg(F.count("*").alias("n_items"), F.count_if(positive).alias("n_positive"))
    both = names.join(by_group, "split", "left").join(by_item, "split", "left").na.fill(0)
    return both.withColumn("rate", ratio(F.col("n_positive"), F.col("n_items")))


def write_release(rows: DataFrame, assignment: DataFrame, path: str, force: bool = False) -> None:
    """Write index (by split) and splits; an existing release isn't overwritten without ``force``."""
    mode = "overwrite" if force else "errorifexists"
    rows.write.mode(mode).partitionBy("split").parquet(f"{path}/index")
    assignment.write.mode(mode).parquet(f"{path}/splits")


def verify(recorded: DataFrame, current: DataFrame, key: str = "path", digest: str = "sha256") -> DataFrame:
    """(key, issue): referenced items that are missing or whose content changed."""
    now = current.select(key, F.col(digest).alias("now"))
    joined = recorded.select(key, F.col(digest).alias("then")).join(now, key, "left")
    issue = F.when(F.col("now").isNull(), "missing").when(F.col("now") != F.col("then"), "content-changed")
    return joined.select(key, issue.alias("issue")).filter("issue is not null")


def leaked_ids(rows: DataFrame, columns: list[str], ids: DataFrame, identifier: str) -> DataFrame:
    """(column, identifier, n_rows): real identifiers that stand in a column between word boundaries,
    whatever punctuation they hold."""
    return identifiers.find(rows, columns, ids, identifier)


def restrict_train(rows: DataFrame, chosen: DataFrame, group: str) -> DataFrame:
    """Train rows of the chosen groups alone; the other splits are untouched."""
    train = rows.filter("split = 'train'").join(chosen.select(group).distinct(), group, "left_semi")
    return train.unionByName(rows.filter("split <> 'train'").select(*train.columns))


def references(index: DataFrame, curated: DataFrame, tokens: DataFrame) -> DataFrame:
    """(path, issue) of index rows whose file isn't what was recorded.

    A path starts with a pseudonym; ``tokens`` (identifier, pseudonym) gives the real folder of
    ``curated`` (rel_path, sha256). Issues: unresolvable-pseudonym, missing, content-changed.
    """
    parts = index.select("path", "sha256", F.substring_index("path", "/", 1).alias("pseudonym"), F.expr("substring(path, instr(path, '/') + 1)").alias("rest"))
    named = parts.join(tokens.select("pseudonym", F.col("identifier").cast("string").alias("identifier")), "pseudonym", "left").withColumn("rel_path", F.concat_ws("/", "identifier", "rest"))
    joined = named.join(curated.select("rel_path", F.col("sha256").alias("now")), "rel_path", "left")
    issue = F.when(F.col("identifier").isNull(), "unresolvable-pseudonym").when(F.col("now").isNull(), "missing").when(F.col("now") != F.col("sha256"), "content-changed")
    return joined.select("path", issue.alias("issue")).filter("issue is not null")
