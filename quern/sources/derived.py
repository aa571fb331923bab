"""Releases that share what they have in common: parts are stored once, by what they hold.

A release is a commit that names its parts: for each split and bucket of paths the digest of its rows.
A part lies in a folder of that digest, so a release that derives from another refers to the parts that
didn't change, and writes the others alone. Digests add up over rows (see ``functions.digests``), so none
needs a sorted list. Releases are never overwritten; parts never change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.functions import digests, logs
from quern.functions.storage import discard, materialize
from quern.operators import audit, release

#: Buckets of a split.
BUCKETS = 16
SPLITS = release.SPLITS


def _with_parts(index: DataFrame, key: str, buckets: int) -> DataFrame:
    """``index`` with ``_bucket`` and the numbers of each row's digest."""
    bucket = F.pmod(F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")
    row = digests.row_digest(*[F.col(c) for c in sorted(index.columns)])
    return index.withColumn("_bucket", F.coalesce(bucket, F.lit(0))).select("*", *digests.lanes(row))


def part_digests(index: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """(``split``, ``bucket``, ``n_rows``, ``digest``) of the parts of ``index``."""
    totals = _with_parts(index, key, buckets).groupBy("split", "_bucket").agg(F.count("*").alias("n_rows"), *digests.summed())
    return totals.select("split", F.col("_bucket").alias("bucket"), "n_rows", digests.total().alias("digest"))


def _place(root: str, digest: str) -> str:
    return f"{root}/parts/digest={digest}"


def _release_path(root: str, version: str) -> str:
    return f"{root}/releases/{version}.json"


def publish(index: DataFrame, root: str, version: str, key: str = "path", derived_from: str | None = None, about: dict | None = None, buckets: int = BUCKETS) -> dict:
    """Write the parts of ``index`` (with ``split``) that aren't stored yet, and the release that names all.

    The parts' names (splits times buckets) are all that the driver holds. An existing version raises.
    """
    spark, where = index.sparkSession, _release_path(root, version)
    if logs.exists(spark, where):
        raise FileExistsError(f"release {version} exists; releases are immutable")
    held = materialize(index, "release")
    parts = [r.asDict() for r in part_digests(held, key, buckets).orderBy("split", "bucket").collect()]
    for p in parts:
        p["new"] = not logs.exists(spark, f"{_place(root, p['digest'])}/_SUCCESS")
    names = spark.createDataFrame([(p["split"], p["bucket"], p["digest"]) for p in parts if p["new"]], "split string, _bucket int, digest string")
    if any(p["new"] for p in parts):
        rows = _with_parts(held, key, buckets).drop(*[f"lane{k}" for k in range(digests.LANES)]).join(F.broadcast(names), ["split", "_bucket"])
        rows.drop("_bucket").repartition("digest").write.partitionBy("digest").mode("append").parquet(f"{root}/parts")
        for p in parts:
            if p["new"]:  # whole from here on
                logs.replace_text(spark, f"{_place(root, p['digest'])}/_SUCCESS", "")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields)
    body = {"version": version, "derived_from": derived_from, "key": key, "buckets": buckets, "columns": index.columns, "schema": schema, "parts": parts, "about": about or {}}
    if not logs.create_text(spark, where, logs.as_json(body)):
        raise FileExistsError(f"release {version} exists; releases are immutable")
    discard(held)
    return body


def describe(spark: SparkSession, root: str, version: str) -> dict:
    """What a release names; one that doesn't exist raises."""
    text = logs.read_text(spark, _release_path(root, version))
    if text is None:
        raise FileNotFoundError(f"no release {version} in {root}")
    return logs.from_json(text)


def read(spark: SparkSession, root: str, version: str, split: str | None = None) -> DataFrame:
    """The rows of a release, or of one of its splits."""
    body = describe(spark, root, version)
    places = [_place(root, p["digest"]) for p in body["parts"] if split is None or p["split"] == split]
    schema = body["schema"]
    return (spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)).select(*body["columns"])


def derive(spark: SparkSession, root: str, parent: str, version: str, chosen: DataFrame, group: str, about: dict | None = None) -> dict:
    """A release with the parent's train rows of the chosen groups alone; its other splits are the parent's
    own parts."""
    body = describe(spark, root, parent)
    rows = release.restrict_train(read(spark, root, parent), chosen, group).select(*body["columns"])
    return publish(rows, root, version, body["key"], parent, about, body["buckets"])


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(``version``, ``derived_from``, ``split``, ``bucket``, ``digest``, ``n_rows``) of every part of every release."""
    raw = spark.read.schema("version string, derived_from string, parts array<struct<split: string, bucket: int, digest: string, n_rows: bigint>>").option("multiLine", True).json(f"{root}/releases")
    return raw.select("version", "derived_from", F.explode_outer("parts").alias("p")).select("version", "derived_from", "p.*")


def ancestors(spark: SparkSession, root: str, version: str) -> DataFrame:
    """(``node``, ``level``): the release, what it derives from, and so on."""
    edges = versions(spark, root).filter("derived_from is not null").select(F.col("version").alias("child"), F.col("derived_from").alias("parent")).distinct()
    return audit.trace(spark.createDataFrame([(version,)], "node string"), edges)


def verify(spark: SparkSession, root: str, version: str) -> DataFrame:
    """(``version``, ``split``, ``bucket``, ``issue``) of a release and all that it derives from: parts that are
    ``missing``, that hold other rows than their name says (``modified``), and parts of validation and
    test that differ from the parent's (``not-inherited``)."""
    line = [r["node"] for r in ancestors(spark, root, version).orderBy("level").collect()]
    found, schema = [], "version string, split string, bucket int, issue string"
    for name in line:
        body = describe(spark, root, name)
        gone = [p for p in body["parts"] if not logs.exists(spark, _place(root, p["digest"]))]
        found.append(spark.createDataFrame([(name, p["split"], p["bucket"], "missing") for p in gone], schema))
        here = [p for p in body["parts"] if p not in gone]
        named = spark.createDataFrame([(p["split"], p["bucket"], p["digest"]) for p in here], "split string, bucket int, digest string")
        if here:
            rows = spark.read.schema(body["schema"]).parquet(*[_place(root, p["digest"]) for p in here]).select(*body["columns"])
            now = part_digests(rows, body["key"], body["buckets"]).select("split", "bucket", F.col("digest").alias("now"))
            changed = named.join(now, ["split", "bucket"], "left").filter(~F.col("digest").eqNullSafe(F.col("now")))
            found.append(changed.select(F.lit(name).alias("version"), "split", "bucket", F.lit("modified").alias("issue")))
        if body["derived_from"]:
            own, above = ({(p["split"], p["bucket"]): p["digest"] for p in b["parts"] if p["split"] != SPLITS[0]} for b in (body, describe(spark, root, body["derived_from"])))
            found.append(spark.createDataFrame([(name, *k, "not-inherited") for k in sorted(own.keys() | above.keys()) if own.get(k) != above.get(k)], schema))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
