"""Readers: file inventories, checksum lists, wide label tables, logs, releases, runs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

_CHANGED = "struct<count: bigint, names: array<string>>"
_PLACE = "path: string, kind: string, n_files: bigint, bytes: bigint, sha256: string"
AUDIT_SCHEMA = f"""seq bigint, run_id string, command string, argv array<string>, actor string, ts_start string, ts_end string,
duration_s double, code_version string, git_commit string, config_sha256 string, inputs array<struct<{_PLACE}>>,
outputs array<struct<{_PLACE}, created: {_CHANGED}, deleted: {_CHANGED}, modified: {_CHANGED}>>, exit_code int, status string, error string, prev_hash string, record_hash string"""


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(rel_path, sha256, size_bytes, mtime) of every file below ``path``."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    base = path.rstrip("/").split(":", 1)[-1].lstrip("/")
    return raw.select(F.substring_index("path", f"{base}/", -1).alias("rel_path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(rel_path, sha256) of a list with a digest, a space and a path on each line; blank lines are left out."""
    text = spark.read.text(path).filter(F.trim("value") != "")
    return text.select(F.trim(F.regexp_extract("value", r"^\S+ +(.*)$", 1)).alias("rel_path"), F.regexp_extract("value", r"^(\S+)", 1).alias("sha256"))


def wide_labels(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV with a header and a declared schema, columns in its order; a byte-order mark that leads
    the header is no part of a name, and names are trimmed."""
    raw = spark.read.csv(path, header=True, schema=schema, enforceSchema=True)
    return raw.toDF(*[c.lstrip("\ufeff").strip() for c in raw.columns])


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose quoted headers may hold line breaks: white space in names becomes one space."""
    raw = spark.read.csv(path, header=True, multiLine=True)
    return raw.toDF(*[" ".join(c.split()) for c in raw.columns])


def line_marks(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(``file``, ``block``, ``lines``, ``blank``, ``bad``) of each split of JSON lines: how many lines begin
    in it, how many are blank, and which (from 0) aren't records of ``schema``."""
    raw = spark.read.option("pathGlobFilter", "*.json*").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    parsed = F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    blank = F.trim("value") == ""
    marked = raw.select("file", "block", blank.alias("blank"), (~blank & parsed["_bad"].isNotNull()).alias("bad"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lines, blanks, wrong = None, 0, 0, []

        def put() -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*now, lines, blanks, wrong), types)], names=["file", "block", "lines", "blank", "bad"])

        for batch in batches:
            for file, block, empty, bad in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and now != (file, block):
                    yield put()
                    lines, blanks, wrong = 0, 0, []
                now = (file, block)
                wrong += [lines] if bad else []
                lines, blanks = lines + 1, blanks + empty
        if now is not None:
            yield put()

    return marked.mapInArrow(run, "file string, block long, lines long, blank long, bad array<long>")


def bad_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(``file``, ``line``) of every line that isn't a record, numbered from 1 with blank lines counted.
    Splits count their own lines, and the sums before them (one row for each split) are added."""
    marks = line_marks(spark, path, schema)
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return marks.withColumn("before", before).select("file", "before", F.explode("bad").alias("at")).select("file", (F.col("before") + F.col("at") + 1).alias("line"))


def audit_log(spark: SparkSession, path: str) -> DataFrame:
    """An append-only log of JSON lines, blank lines left out. A line that isn't a record fails the
    read with the first such file and line."""
    first = bad_lines(spark, path, AUDIT_SCHEMA).agg(F.min(F.struct("file", "line")).alias("f")).first()["f"]
    if first:
        raise ValueError(f"{first['file']}: line {first['line']} is not a record")
    return spark.read.schema(AUDIT_SCHEMA).option("mode", "FAILFAST").option("pathGlobFilter", "*.json*").json(path)


def releases(spark: SparkSession, root: str) -> DataFrame:
    """The metadata of every release below ``root``, by version."""
    return spark.read.option("multiLine", True).json(f"{root}/*/metadata.json").orderBy("version")


def run(spark: SparkSession, folder: str) -> DataFrame:
    """A run's predictions with the threshold of its own record."""
    record = spark.read.option("multiLine", True).json(f"{folder}/run.json").select("run_id", "dataset_version", F.col("selected_threshold").alias("threshold"))
    return spark.read.parquet(f"{folder}/predictions").crossJoin(F.broadcast(record))


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The largest run id below ``root``; a column of ids is aggregated, not listed."""
    ids = spark.read.option("multiLine", True).json(f"{root}/*/run.json").select("run_id")
    return ids.agg(F.max("run_id")).first()[0]


def attachments(inventory: DataFrame, number: Column) -> DataFrame:
    """Attachment rows by numeric item."""
    return inventory.filter("kind = 'attachment'").orderBy(number.cast("long"))
