"""Quality gates: orphans, agreement, counts, plausibility, and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ERROR, WARNING = "ERROR", "WARNING"
FINDING = ["check", "severity", "issue", "key"]


def finding(rows: DataFrame, check: str, severity: str, issue: str | Column, key: Column) -> DataFrame:
    """Rows as findings: (check, severity, issue, key)."""
    return rows.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), (F.lit(issue) if isinstance(issue, str) else issue).alias("issue"), key.cast("string").alias("key"))


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def count_mismatches(census: DataFrame, group: str, first: str, second: str) -> DataFrame:
    """Groups whose two variants have different counts: a warning each."""
    return finding(census.filter(F.col(first) != F.col(second)), "slice-counts", WARNING, "window-count-mismatch", F.col(group))


def orphans(items: DataFrame, labels: DataFrame, attachments: DataFrame, key: str, issues: tuple[str, str, str] = ("label-without-image", "image-without-label", "mask-without-slice")) -> DataFrame:
    """Labels without an item, items without a label, attachments without an item; ``issues`` names them."""
    return (
        finding(unmatched(labels, items, [key]), "orphans", ERROR, issues[0], F.col(key))
        .unionByName(finding(unmatched(items, labels, [key]), "orphans", ERROR, issues[1], F.col(key)))
        .unionByName(finding(unmatched(attachments, items, [key]), "orphans", ERROR, issues[2], F.col(key)))
    )


def agreement(attachments: DataFrame, positives: DataFrame, key: str, issues: tuple[str, str] = ("mask-but-no-hemorrhage-label", "hemorrhage-label-but-no-mask")) -> DataFrame:
    """Attachments without a positive label, and positive labels without an attachment; ``issues`` names them."""
    return finding(unmatched(attachments, positives, [key]), "mask-label-agreement", ERROR, issues[0], F.col(key)).unionByName(
        finding(unmatched(positives, attachments, [key]), "mask-label-agreement", ERROR, issues[1], F.col(key))
    )


def coverage(items: DataFrame, profiles: DataFrame, key: str, issues: tuple[str, str] = ("images-without-demographics", "demographics-without-images")) -> DataFrame:
    """Groups without a profile, and profiles without a group; ``issues`` names them."""
    return finding(unmatched(items, profiles, [key]), "demographics", ERROR, issues[0], F.col(key)).unionByName(
        finding(unmatched(profiles, items, [key]), "demographics", ERROR, issues[1], F.col(key))
    )


def plausibility(profiles: DataFrame, key: str, age: str, low: float = 0, high: float = 120, infant: float = 1, issues: tuple[str, str] = ("implausible-age", "paediatric-age-under-1-year")) -> DataFrame:
    """Ages that are null, negative or too high are errors; those under ``infant`` are warnings."""
    value = F.col(age)
    bad = value.isNull() | F.isnan(value) | (value < low) | (value > high)
    return finding(profiles.filter(bad), "demographics", ERROR, issues[0], F.col(key)).unionByName(
        finding(profiles.filter(~bad & (value < infant)), "demographics", WARNING, issues[1], F.col(key))
    )


def unexpected_values(profiles: DataFrame, column: str, allowed: list[str], issue: str = "unexpected-gender-value") -> DataFrame:
    """Values outside the domain, each once; nulls are not judged."""
    rows = profiles.select(column).distinct().filter(~F.col(column).isin(allowed))
    return finding(rows, "demographics", ERROR, issue, F.col(column))


def summary_disagreements(items: DataFrame, summary: DataFrame, group: str, terms: list[str]) -> DataFrame:
    """(group, term, item_value, summary_value) where a group's maximum over items differs from its
    summary, over groups that both have; blanks count as 0."""
    long = lambda df: df.unpivot([group], terms, "term", "value")
    most = long(items.groupBy(group).agg(*[F.coalesce(F.max(t), F.lit(0)).cast("int").alias(t) for t in terms])).withColumnRenamed("value", "item_value")
    said = long(summary.select(group, *[F.coalesce(F.nanvl(F.col(t).cast("double"), F.lit(0.0)), F.lit(0.0)).cast("int").alias(t) for t in terms])).withColumnRenamed("value", "summary_value")
    return most.join(said, [group, "term"]).filter("item_value <> summary_value")


def report(findings: DataFrame, checks: list[str]) -> DataFrame:
    """(check, errors, warnings, result) for every check: FAIL with an error, else WARN with a
    warning, else PASS."""
    names = findings.sparkSession.createDataFrame([(c,) for c in checks], "check string")
    counts = findings.groupBy("check").agg(F.count_if(F.col("severity") == ERROR).alias("errors"), F.count_if(F.col("severity") == WARNING).alias("warnings"))
    both = F.broadcast(names).join(counts, "check", "left").select("check", F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("warnings", F.lit(0)).alias("warnings"))
    return both.withColumn("result", F.when(F.col("errors") > 0, "FAIL").when(F.col("warnings") > 0, "WARN").otherwise("PASS"))


def passes(findings: DataFrame) -> bool:
    """A gate passes without errors; warnings never fail it."""
    return findings.filter(F.col("severity") == ERROR).isEmpty()
