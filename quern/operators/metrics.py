"""Ranking and classification metrics over (label, score) rows.

Rows are summed by distinct score first; ranks and threshold counts are then running totals over
the distinct scores, so no task sorts the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quern.functions.keys import draw, ratio
from quern.functions.ordered import numbered, running_totals


def by_score(rows: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, pos, neg) for each distinct score."""
    return rows.groupBy(F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def wins(pos: Column, neg: Column, neg_before: Column) -> Column:
    """Twice the number of (positive, negative) pairs that the positives of one score win, ties half."""
    return pos * (2 * neg_before + neg)


def auroc_of(twice_wins: Column, n_pos: Column, n_neg: Column, absent: float | None = 0.5) -> Column:
    return F.when((n_pos == 0) | (n_neg == 0), F.lit(absent).cast("double")).otherwise(twice_wins.cast("double") / (2.0 * n_pos * n_neg))


def auroc(rows: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row (n_pos, n_neg, auroc): Mann-Whitney with average ranks; 0.5 when a class is absent."""
    totals = running_totals(by_score(rows, label, score), ["score"], ["neg"])
    zero = lambda c: F.coalesce(c, F.lit(0))
    summed = totals.agg(zero(F.sum("pos")).alias("n_pos"), zero(F.sum("neg")).alias("n_neg"), zero(F.sum(wins(F.col("pos"), F.col("neg"), F.col("neg_before")))).alias("w"))
    return summed.select("n_pos", "n_neg", auroc_of(F.col("w"), F.col("n_pos"), F.col("n_neg")).alias("auroc"))


def auroc_by(rows: DataFrame, by: str, label: str = "label", score: str = "score") -> DataFrame:
    """(``by``, n_pos, n_neg, auroc) for each value of ``by``. Running totals go through all values in one
    order, and what stood before a value's first score is taken off."""
    cells = rows.groupBy(by, F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    totals = running_totals(cells, [by, "score"], ["neg"])
    w = F.sum(wins(F.col("pos"), F.col("neg"), F.col("neg_before"))) - 2 * F.sum("pos") * F.min("neg_before")
    summed = totals.groupBy(by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), w.alias("w"))
    return summed.select(by, "n_pos", "n_neg", auroc_of(F.col("w"), F.col("n_pos"), F.col("n_neg")).alias("auroc"))


def confusion(rows: DataFrame, threshold: float | Column, by: list[str] | None = None, label: str = "label", score: str = "score") -> DataFrame:
    """tp, fp, tn, fn at ``score >= threshold``, for the table or for each of ``by``."""
    at = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    yes, pos = F.col(score) >= at, F.col(label) == 1
    return rows.groupBy(*(by or [])).agg(F.count_if(yes & pos).alias("tp"), F.count_if(yes & ~pos).alias("fp"), F.count_if(~yes & ~pos).alias("tn"), F.count_if(~yes & pos).alias("fn"))


def with_rates(counts: DataFrame) -> DataFrame:
    """Counts with n, prevalence, accuracy, precision, recall, specificity, balanced accuracy and F1;
    a rate over nothing is 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    rated = counts.select(
        "*",
        n.alias("n"),
        ratio(tp + fn, n).alias("prevalence"),
        ratio(tp + tn, n).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tn, tn + fp).alias("specificity"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
    return rated.withColumn("balanced_accuracy", (F.col("recall") + F.col("specificity")) / 2)


def trivial_baseline(rows: DataFrame, label: str = "label") -> DataFrame:
    """The majority guess: 1 for all if more than half are positive, else 0; its AUROC is 0.5."""
    guess = rows.agg(F.avg(F.col(label).cast("double")).alias("share"))
    scored = rows.crossJoin(F.broadcast(guess)).select(F.col(label).alias("label"), F.when(F.col("share") > 0.5, 1.0).otherwise(0.0).alias("score"))
    return with_rates(confusion(scored, 0.5)).withColumn("auroc", F.lit(0.5))


def best_threshold(rows: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row (threshold, f1): the candidate with the highest F1, the lowest of equals.

    Candidates are the distinct scores, 0 and 1. What a threshold leaves below it is a running
    total, so no threshold needs a pass of its own.
    """
    spark = rows.sparkSession
    edges = spark.createDataFrame([(0.0, 0, 0), (1.0, 0, 0)], "score double, pos bigint, neg bigint")
    points = by_score(rows, label, score).unionByName(edges).groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    total = points.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    at = running_totals(points, ["score"], ["pos", "neg"]).crossJoin(F.broadcast(total))
    tp, fp = F.col("n_pos") - F.col("pos_before"), F.col("n_neg") - F.col("neg_before")
    f1 = ratio(2 * tp, tp + fp + F.col("n_pos"))
    best = at.select("score", f1.alias("f1")).agg(F.max(F.struct("f1", (-F.col("score")).alias("least"))).alias("b"))
    return best.select((-F.col("b.least")).alias("threshold"), F.col("b.f1").alias("f1"))


def bootstrap_auroc(rows: DataFrame, group: str, resamples: int, seed: int, label: str = "label", score: str = "score") -> DataFrame:
    """(resample, auroc) by drawing whole groups with replacement; draws with one class are left out.

    A draw is a hash of the seed, the resample and the place, and a group's weight is how often it was
    drawn. A group's weights in all resamples are one vector, so a cell (group, score) is one row. Cells
    are dealt to ranges of scores; a range adds vectors as it goes through its scores, and gives what its
    positives win over its own negatives, and its totals. The negatives of earlier ranges are then added.
    """
    spark = rows.sparkSession
    groups = rows.select(group).distinct()
    ranked = numbered(groups, [group], "rank").withColumn("rank", F.col("rank") - 1)
    n = ranked.count()
    draws = spark.range(resamples * n).select(F.floor(F.col("id") / n).alias("resample"), (F.col("id") % n).alias("place"))
    picked = draws.withColumn("rank", draw(n, seed, F.col("resample"), F.col("place"))).groupBy("rank", "resample").agg(F.count("*").cast("int").alias("weight"))
    vectors = picked.groupBy("rank").agg(F.collect_list(F.struct("resample", "weight")).alias("drawn")).join(ranked, "rank")
    sums = rows.groupBy(group, F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    cells = sums.join(vectors.select(group, "drawn"), group).select("score", "pos", "neg", F.transform("drawn", lambda d: d["resample"]).alias("at"), F.transform("drawn", lambda d: d["weight"]).alias("times"))
    in_order = cells.repartitionByRange("score").sortWithinPartitions("score")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, neg, here_pos, here_neg, won = (np.zeros(resamples, dtype=np.int64) for _ in range(5))
        now, first = None, None

        def close() -> None:
            """Put the present score's vectors to the range's."""
            won[:] += here_pos * (2 * neg + here_neg)
            pos[:] += here_pos
            neg[:] += here_neg
            here_pos[:], here_neg[:] = 0, 0

        for batch in batches:
            at, times = batch.column(3), batch.column(4)
            ends, flat, weight = at.offsets.to_numpy(), at.values.to_numpy(), times.values.to_numpy()
            for k, (s, p, m) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if s != now:
                    close()
                    now, first = s, s if first is None else first
                places, w = flat[ends[k] : ends[k + 1]], weight[ends[k] : ends[k + 1]]
                here_pos[places] += p * w
                here_neg[places] += m * w
        if first is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array([first]), *(pa.array([v.tolist()], pa.list_(pa.int64())) for v in (pos, neg, won))], names=["first", "pos", "neg", "won"])

    ranges = in_order.mapInArrow(add, "first double, pos array<long>, neg array<long>, won array<long>")
    each = ranges.select("first", F.posexplode(F.arrays_zip("pos", "neg", "won")).alias("resample", "v")).select("first", "resample", "v.*")
    before = Window.partitionBy("resample").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    whole = each.withColumn("w", F.col("won") + 2 * F.col("pos") * F.coalesce(F.sum("neg").over(before), F.lit(0)))
    per = whole.groupBy(F.col("resample").cast("long").alias("resample")).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("w").alias("w"))
    return per.filter("n_pos > 0 and n_neg > 0").select("resample", auroc_of(F.col("w"), F.col("n_pos"), F.col("n_neg")).alias("auroc"))


def interval(values: DataFrame, column: str, alpha: float = 0.05) -> DataFrame:
    """(n_resamples, ci_low, ci_high, undefined): percentiles with linear interpolation; [0, 1] and
    undefined where no value is left."""
    found = values.agg(F.count("*").alias("n_resamples"), F.percentile(column, F.lit(alpha / 2)).alias("lo"), F.percentile(column, F.lit(1 - alpha / 2)).alias("hi"))
    return found.select("n_resamples", F.coalesce("lo", F.lit(0.0)).alias("ci_low"), F.coalesce("hi", F.lit(1.0)).alias("ci_high"), (F.col("n_resamples") == 0).alias("undefined"))
