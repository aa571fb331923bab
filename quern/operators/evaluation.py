"""Error analysis of (group, item, label, score) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quern.functions.keys import ratio
from quern.functions.ordered import running_totals
from quern.operators.metrics import auroc_of, by_score, confusion, with_rates, wins

#: Points of the threshold grid and the step between them (fixed values: i * 0.025, not i / 40).
GRID_POINTS, GRID_STEP = 41, 0.025


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a side of a one-to-one join must have none."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def checked_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join that keeps the row count: duplicate keys on the right side raise an error."""
    if not duplicate_keys(right, keys).isEmpty():
        raise ValueError(f"the right side repeats keys {keys}")
    return left.join(right, keys, "left")


def subtype_recall(rows: DataFrame, subtypes: list[str], threshold: float, min_support: int = 2) -> DataFrame:
    """(subtype, support, detected, recall, measurable) for every subtype; recall is null without
    support, and measurable from ``min_support`` on."""
    sums = rows.agg(*[F.count_if(F.col(s) == 1).alias(f"{s}_n") for s in subtypes], *[F.count_if((F.col(s) == 1) & (F.col("score") >= threshold)).alias(f"{s}_d") for s in subtypes])
    long = sums.select(F.explode(F.array(*[F.struct(F.lit(s).alias("subtype"), F.col(f"{s}_n").alias("support"), F.col(f"{s}_d").alias("detected")) for s in subtypes])).alias("r")).select("r.*")
    return long.select("*", ratio(F.col("detected"), F.col("support"), None).alias("recall"), (F.col("support") >= min_support).alias("measurable"))


def hardest_cases(rows: DataFrame, threshold: float, n: int, group: str, item: str) -> DataFrame:
    """(kind, place, group, item, score): misses of the lowest and false alarms of the highest score,
    ``n`` of each; ties by group and item."""
    missed = rows.filter((F.col("label") == 1) & (F.col("score") < threshold)).orderBy("score", group, item).limit(n)
    alarms = rows.filter((F.col("label") == 0) & (F.col("score") >= threshold)).orderBy(F.desc("score"), group, item).limit(n)
    numbered = lambda df, kind, by: df.select(F.lit(kind).alias("kind"), F.row_number().over(Window.orderBy(*by)).cast("long").alias("place"), group, item, "score")
    return numbered(missed, "false_negative", ["score", group, item]).unionByName(numbered(alarms, "false_positive", [F.desc("score"), group, item]))


def group_contributions(rows: DataFrame, threshold: float, group: str) -> DataFrame:
    """For each group: items, positives, detected, detection rate (null without positives), exact
    median score, and its share of all positives."""
    pos = F.col("label") == 1
    per = rows.groupBy(group).agg(F.count("*").alias("n_items"), F.count_if(pos).alias("n_positive"), F.count_if(pos & (F.col("score") >= threshold)).alias("detected"), F.median("score").alias("median_score"))
    total = rows.agg(F.count_if(pos).alias("all_positive"))
    return per.crossJoin(F.broadcast(total)).select(group, "n_items", "n_positive", "detected", ratio(F.col("detected"), F.col("n_positive"), None).alias("detection_rate"), "median_score", ratio(F.col("n_positive"), F.col("all_positive")).alias("share_of_positives"))


def leave_one_group_out(rows: DataFrame, group: str) -> DataFrame:
    """(group, auroc_without, delta): the AUROC of the rows outside each group (null if a class is
    absent), and its change. Sorted by the size of the change, the largest first and nulls last, ties
    by group.

    Closed form: from all won pairs take those of the group's positives with all negatives and of
    all positives with the group's negatives, and give back those within the group.
    """
    cells = rows.groupBy(group, F.col("score").cast("double").alias("score")).agg(F.count_if(F.col("label") == 1).alias("gp"), F.count_if(F.col("label") == 0).alias("gn"))
    totals = running_totals(by_score(rows), ["score"], ["pos", "neg"])
    all_counts = by_score(rows).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    inside = Window.partitionBy(group).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("gn").over(inside), F.lit(0))
    joined = cells.withColumn("gn_before", own).join(totals, "score").crossJoin(F.broadcast(all_counts))
    parts = joined.groupBy(group).agg(
        F.sum("gp").alias("gp"),
        F.sum("gn").alias("gn"),
        F.sum(wins(F.col("gp"), F.col("neg"), F.col("neg_before"))).alias("ours"),
        F.sum(F.col("gn") * (2 * (F.col("P") - F.col("pos_before") - F.col("pos")) + F.col("pos"))).alias("theirs"),
        F.sum(wins(F.col("gp"), F.col("gn"), F.col("gn_before"))).alias("within"),
    )
    whole = totals.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum(wins(F.col("pos"), F.col("neg"), F.col("neg_before"))).alias("W"))
    out = parts.crossJoin(F.broadcast(whole))
    without = auroc_of(F.col("W") - F.col("ours") - F.col("theirs") + F.col("within"), F.col("P") - F.col("gp"), F.col("N") - F.col("gn"), None)
    full = auroc_of(F.col("W"), F.col("P"), F.col("N"), None)
    return out.select(group, without.alias("auroc_without"), (without - full).alias("delta")).orderBy(F.abs("delta").desc_nulls_last(), group)


def aggregate_groups(rows: DataFrame, group: str, rule: str = "max", top_k: int = 3) -> DataFrame:
    """(group, label, score): the group's largest score, or the mean of its ``top_k`` largest; its
    label is its largest label.

    The rank filter stands alone, so Spark cuts each task's groups to ``top_k`` rows before the
    shuffle and a large group is never one task's sort.
    """
    if rule == "max":
        return rows.groupBy(group).agg(F.max("label").alias("label"), F.max("score").alias("score"))
    if rule != "topk":
        raise ValueError(f"unknown rule {rule!r}")
    best = Window.partitionBy(group).orderBy(F.desc("score"))
    kept = rows.select(group, "score").withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= top_k)
    means = kept.groupBy(group).agg(F.avg("score").alias("score"))
    return rows.groupBy(group).agg(F.max("label").alias("label")).join(means, group).select(group, "label", "score")


def granularity(groups: DataFrame) -> DataFrame:
    """Comparable pairs of group rows and the AUROC step that one of them makes (null without any)."""
    counts = groups.agg(F.count_if(F.col("label") == 1).alias("n_pos"), F.count_if(F.col("label") == 0).alias("n_neg"))
    pairs = F.col("n_pos") * F.col("n_neg")
    return counts.select("n_pos", "n_neg", pairs.alias("comparable_pairs"), ratio(F.lit(1), pairs, None).alias("auroc_granularity"))


def threshold_sweep(rows: DataFrame) -> DataFrame:
    """Counts and rates at each threshold of the grid.

    A row falls in the cell of the highest threshold that it reaches; the counts of a threshold are
    sums over the cells from it on, so rows are read once and not once for each threshold.
    """
    grid = rows.sparkSession.range(GRID_POINTS).select(F.col("id").alias("cell"), (F.col("id") * F.lit(GRID_STEP)).alias("threshold"))
    guess = F.floor(F.col("score") / GRID_STEP)
    up = F.when((guess + 1) * F.lit(GRID_STEP) <= F.col("score"), guess + 1).when(guess * F.lit(GRID_STEP) > F.col("score"), guess - 1).otherwise(guess)
    cells = rows.groupBy(F.least(F.greatest(up, F.lit(-1)), F.lit(GRID_POINTS - 1)).cast("long").alias("cell")).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    all_counts = cells.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("P"), F.coalesce(F.sum("neg"), F.lit(0)).alias("N"))
    reached = grid.alias("g").join(F.broadcast(cells).alias("c"), F.col("c.cell") >= F.col("g.cell"), "left").groupBy("g.cell", "threshold").agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"), F.coalesce(F.sum("neg"), F.lit(0)).alias("fp"))
    counts = reached.crossJoin(F.broadcast(all_counts)).select("threshold", "tp", "fp", (F.col("N") - F.col("fp")).alias("tn"), (F.col("P") - F.col("tp")).alias("fn"))
    return with_rates(counts)


def operating_point(rows: DataFrame, target_recall: float = 0.90) -> DataFrame:
    """The strictest grid point whose recall, unrounded, reaches the target; no row if none does."""
    return threshold_sweep(rows).filter(F.col("recall") >= target_recall).orderBy(F.desc("threshold")).limit(1)


def slice_report(rows: DataFrame, threshold: float) -> DataFrame:
    """Confusion counts and rates at the run's threshold."""
    return with_rates(confusion(rows, threshold))


def report(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, metric, value): one-row results of several analyses as one long table."""
    parts = []
    for name, df in sections.items():
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns])).alias("cell")
        parts.append(df.select(cells).select(F.lit(name).alias("section"), "cell.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
