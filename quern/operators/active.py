"""Active learning: uncertainty, pools, selection, and paired statistics of arms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.keys import shuffle_key
from quern.functions.ordered import numbered
from quern.operators.release import places

CLIP = 1e-12
#: Two-sided 95 % t values for 1 to 9 degrees of freedom, the value beyond, and the factor of the
#: minimum detectable effect (fixed values).
T_CRITICAL = (12.706, 4.303, 3.182, 2.776, 2.571, 2.447, 2.365, 2.306, 2.262)
T_BEYOND, MDE_FACTOR = 1.96, 2.9


def entropy(p: Column) -> Column:
    """Binary entropy in bits; p is clipped away from 0 and 1."""
    q = F.least(F.greatest(p.cast("double"), F.lit(CLIP)), F.lit(1 - CLIP))
    return -(q * F.log2(q) + (1 - q) * F.log2(1 - q))


def group_uncertainty(rows: DataFrame, group: str, score: str, rule: str = "mean") -> DataFrame:
    """(group, uncertainty): the mean or the maximum entropy of a group's items."""
    if rule not in ("mean", "max"):
        raise ValueError(f"unknown rule {rule!r}")
    gather = F.avg if rule == "mean" else F.max
    return rows.groupBy(group).agg(gather(entropy(F.col(score))).alias("uncertainty"))


def stratified_pool(groups: DataFrame, group: str, flag: str, fraction: float, seed: int) -> DataFrame:
    """(group, flag, pool): of each flag value the first round(n * fraction) groups, in a keyed
    shuffle, are labelled and the rest unlabelled."""
    placed = places(groups, group, flag, seed)
    return placed.select(group, flag, F.when(F.col("_at") <= F.bround(F.col("_total").cast("double") * fraction), "labelled").otherwise("unlabelled").alias("pool"))


def ranking(uncertainty: DataFrame, group: str) -> DataFrame:
    """``uncertainty`` (group, uncertainty) with ``rank``, the most uncertain first, ties by group."""
    ordered = uncertainty.withColumn("_least", -F.col("uncertainty"))
    return numbered(ordered, ["_least", group], "rank").drop("_least")


def select_uncertain(ranking: DataFrame, pool: DataFrame, group: str, budget: int) -> DataFrame:
    """The ``budget`` most uncertain groups of the pool (all, if it has fewer); ties by group."""
    return ranking.join(pool.select(group), group, "left_semi").orderBy(F.desc("uncertainty"), group).limit(budget).select(group)


def select_random(pool: DataFrame, group: str, budget: int, seed: int) -> DataFrame:
    """``budget`` groups of the pool in a keyed shuffle."""
    return pool.select(group).orderBy(shuffle_key(seed, F.col(group)), group).limit(budget)


def arm_summary(results: DataFrame, arm: str, metric: str) -> DataFrame:
    """n, mean, sample standard deviation (null for one), minimum and maximum by arm."""
    m = F.col(metric)
    return results.groupBy(arm).agg(F.count("*").alias("n_seeds"), F.avg(m).alias("mean"), F.stddev_samp(m).alias("std"), F.min(m).alias("min"), F.max(m).alias("max"))


def paired_deltas(results: DataFrame, seed: str, arm: str, metric: str, first: str, second: str) -> DataFrame:
    """(seed, delta) of two arms, for seeds that have both."""
    by = results.groupBy(seed).agg(F.avg(F.when(F.col(arm) == first, F.col(metric))).alias("a"), F.avg(F.when(F.col(arm) == second, F.col(metric))).alias("b"))
    return by.filter("a is not null and b is not null").select(seed, (F.col("a") - F.col("b")).alias("delta"))


def paired_statistics(deltas: DataFrame) -> DataFrame:
    """One row: pairs, mean, deviation, interval, significance, detectable effect, wins and losses.

    With fewer than two pairs there is no interval and no significance.
    """
    s = deltas.agg(F.count("delta").alias("n_pairs"), F.avg("delta").alias("mean_delta"), F.stddev_samp("delta").alias("std_delta"), F.count_if(F.col("delta") > 0).alias("wins"), F.count_if(F.col("delta") < 0).alias("losses"), F.count_if(F.col("delta") == 0).alias("ties"))
    t = F.coalesce(F.get(F.array(*map(F.lit, T_CRITICAL)), (F.col("n_pairs") - 2).cast("int")), F.lit(T_BEYOND))
    error = F.when(F.col("n_pairs") >= 2, F.col("std_delta") / F.sqrt("n_pairs"))
    margin = t * error
    return s.select(
        "n_pairs",
        "mean_delta",
        F.when(F.col("n_pairs") >= 2, F.col("std_delta")).alias("std_delta"),
        (F.col("mean_delta") - margin).alias("ci_low"),
        (F.col("mean_delta") + margin).alias("ci_high"),
        F.coalesce(F.abs("mean_delta") > margin, F.lit(False)).alias("significant"),
        (MDE_FACTOR * error).alias("minimum_detectable_effect"),
        "wins",
        "losses",
        "ties",
    )
