"""Published releases: written once with metadata, card and checksums, then read-only; verified later."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.operators.release import leaked_ids, references, write_release
from quern.sources.readers import checksums, files

CHECKSUMS = "CHECKSUMS.txt"


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _fs(spark, path)
    out = fs.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def card(metadata: dict, statistics: list[dict], issues: list[str]) -> str:
    """A short description: version, a table of the splits, and what is known to be wrong."""
    lines = [f"# Release {metadata['version']}", ""]
    if statistics:
        names = list(statistics[0])
        lines += ["| " + " | ".join(names) + " |", "|" + "-|" * len(names)]
        lines += ["| " + " | ".join(str(row[n]) for n in names) + " |" for row in statistics]
    lines += ["", "Known issues:", "", *[f"- {i}" for i in issues or ["none"]]]
    return "\n".join(lines) + "\n"


def publish(index: DataFrame, splits: DataFrame, statistics: DataFrame, metadata: dict, path: str, issues: list[str] | None = None) -> None:
    """Write index (by split), splits, metadata and card below ``path``, then the checksums of all of
    them, and make every file read-only. An existing release is never overwritten.

    ``statistics`` has one row for each split. Checksums are worked out by Spark over the files.
    """
    spark = index.sparkSession
    fs, target = _fs(spark, path)
    if fs.exists(target):
        raise FileExistsError(f"release {path} exists; releases are immutable")
    write_release(index, splits, path)
    stats = [r.asDict() for r in statistics.collect()]
    _put(spark, f"{path}/metadata.json", json.dumps({**metadata, "statistics": stats}, indent=2, default=str))
    _put(spark, f"{path}/card.md", card(metadata, stats, issues or []))
    own = files(spark, path).filter("rel_path not like '%/.%' and rel_path not like '.%'")
    _put(spark, f"{path}/{CHECKSUMS}", "".join(f"{r.sha256} {r.rel_path}\n" for r in own.orderBy("rel_path").toLocalIterator()))
    read_only = spark.sparkContext._jvm.org.apache.hadoop.fs.permission.FsPermission("444")
    found = fs.listFiles(target, True)
    while found.hasNext():
        fs.setPermission(found.next().getPath(), read_only)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The index of a release, with its split."""
    return spark.read.parquet(f"{path}/index")


def verify(spark: SparkSession, path: str, curated: DataFrame, tokens: DataFrame) -> DataFrame:
    """(part, name, issue) of what is wrong with a release; no rows if it is whole.

    ``release_files``: the checksum list is missing, or files are missing or modified.
    ``references``: see ``release.references``; ``curated`` has rel_path and sha256, ``tokens`` has
    identifier and pseudonym. ``privacy``: real identifiers that stand as words in the index.
    """
    fs, target = _fs(spark, f"{path}/{CHECKSUMS}")
    schema = "part string, name string, issue string"
    if not fs.exists(target):
        return spark.createDataFrame([("release_files", CHECKSUMS, "missing")], schema)
    now = files(spark, path).select("rel_path", F.col("sha256").alias("now"))
    listed = checksums(spark, f"{path}/{CHECKSUMS}").join(now, "rel_path", "left")
    issue = F.when(F.col("now").isNull(), "missing").when(F.col("now") != F.col("sha256"), "modified")
    own = listed.select(F.lit("release_files").alias("part"), F.col("rel_path").alias("name"), issue.alias("issue")).filter("issue is not null")
    index = read(spark, path)
    refs = references(index, curated, tokens).select(F.lit("references").alias("part"), F.col("path").alias("name"), "issue")
    text = [c for c, _ in index.dtypes]
    leaks = leaked_ids(index, text, tokens, "identifier").select(F.lit("privacy").alias("part"), F.col("identifier").alias("name"), F.lit("real-id-in-index").alias("issue")).distinct()
    return own.union(refs).union(leaks)
