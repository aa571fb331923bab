"""A table with keys in which batches of rows are put, replaced and removed, each batch as a whole.

Rows stand in buckets by a hash of the key. A batch rewrites the buckets that it touches and commits
the new list of buckets; files are never changed, so readers keep what they read. Two batches at a time
lose nothing: the one whose commit came second takes over the other's buckets, and works out anew only
those that both touched. ``first_seen`` and ``last_seen`` are the stamps of the batches that first and last
held a key; a key that is put again keeps its first.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.functions import logs
from quern.functions.storage import discard, materialize

#: Buckets of a new table.
BUCKETS = 16
LOG = "_commits"
MARKS = ("first_seen", "last_seen")


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, root: str, body: dict, only: set[str] | None = None) -> DataFrame | None:
    """The rows of a commit's buckets (or of some of them)."""
    places = sorted(p for b, p in body.get("parts", {}).items() if only is None or b in only)
    if not places:
        return None
    return spark.read.schema(body["schema"]).parquet(*[f"{root}/{p}" for p in places])


def read(spark: SparkSession, root: str, schema: str, number: int | None = None) -> DataFrame:
    """The table as of a commit (the newest by default); before the first, no rows of ``schema``."""
    body = logs.latest(spark, f"{root}/{LOG}")[1] if number is None else logs.read_commit(spark, f"{root}/{LOG}", number)
    if body is None:
        raise ValueError(f"{root} has no commit {number}")
    found = _stored(spark, root, body)
    return spark.createDataFrame([], f"{schema}, first_seen string, last_seen string") if found is None else found


def history(spark: SparkSession, root: str) -> DataFrame:
    """(``number``, ``run``, ``buckets``) of every commit, with how many buckets it rewrote."""
    log = f"{root}/{LOG}"
    rows = [(n, body["run"], len(body["rewritten"])) for n in logs.numbers(spark, log) if (body := logs.read_commit(spark, log, n))]
    return spark.createDataFrame(rows, "number long, run string, buckets int")


def _merged(old: DataFrame | None, batch: DataFrame, key: str, columns: list[str], stamp: str) -> DataFrame:
    """Old rows under the batch's. A row of the batch marked as gone removes its key."""
    marked = batch.select(F.struct(*columns).alias("new"), F.col(key).alias("_key"), F.col("_gone"))
    if old is None:
        old = batch.sparkSession.createDataFrame([], batch.select(*columns).schema).select("*", F.lit("").alias("first_seen"), F.lit("").alias("last_seen"))
    known = old.select(F.struct(*columns).alias("old"), F.col(key).alias("_old_key"), *MARKS)
    both = known.join(marked, F.col("_key").eqNullSafe(F.col("_old_key")), "full_outer")
    row = F.coalesce("new", "old")
    kept = both.filter(~F.coalesce("_gone", F.lit(False)))
    return kept.select(row.alias("r"), F.coalesce("first_seen", F.lit(stamp)).alias("first_seen"), F.when(F.col("new").isNotNull(), F.lit(stamp)).otherwise(F.col("last_seen")).alias("last_seen")).select("r.*", *MARKS)


def upsert(batch: DataFrame, root: str, key: str, gone: str | None = None, stamp: str | None = None, buckets: int = BUCKETS, attempts: int = 20) -> int:
    """Put ``batch`` into the table at ``root`` and return the commit's number. ``stamp`` is the time of the
    batch (now, in UTC, by default).

    Rows of one key in a batch count as the one of the largest hash; rows whose ``gone`` column is true
    remove their key. Null keys are one key. An empty batch commits a table without changes.
    """
    spark, log, run = batch.sparkSession, f"{root}/{LOG}", uuid.uuid4().hex
    columns = [c for c in batch.columns if c not in (*MARKS, gone)]
    stamp = stamp or datetime.datetime.now(datetime.timezone.utc).isoformat()
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.select(*columns).schema.fields), "first_seen string, last_seen string"])
    number, body = logs.latest(spark, log)
    if body.get("schema", ddl) != ddl:
        raise ValueError(f"the table holds {body['schema']}, the batch {ddl}")
    buckets = body.get("buckets", buckets)
    mark = F.coalesce(F.col(gone).cast("boolean"), F.lit(False)) if gone else F.lit(False)
    packed = batch.select(F.struct(*columns, mark.alias("_gone")).alias("row"))
    once = packed.groupBy(F.col(f"row.{key}").alias("_k")).agg(F.max_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    mine = materialize(once.withColumn("_bucket", _bucket(key, buckets)), "batch")
    touched = {str(r["_bucket"]) for r in mine.select("_bucket").distinct().collect()}
    done: dict[str, str] = {}  # my buckets, by what they rest on
    base: dict[str, str | None] = {}
    for _ in range(attempts):
        parts, next_number = body.get("parts", {}), number + 1
        stale = {b for b in touched if b not in done or base[b] != parts.get(b)}
        if stale:
            fresh = mine.filter(F.col("_bucket").isin([int(b) for b in stale])).drop("_bucket")
            rows = _merged(_stored(spark, root, body, stale), fresh, key, columns, stamp)
            where = f"data/{next_number:010d}-{uuid.uuid4().hex}"
            rows.withColumn("_bucket", _bucket(key, buckets)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{root}/{where}")
            for b in stale:
                base[b] = parts.get(b)
                done[b] = f"{where}/_bucket={b}"
        found = {b: p for b, p in done.items() if logs.exists(spark, f"{root}/{p}")}
        new = {**{b: p for b, p in parts.items() if b not in touched}, **found}
        if logs.commit(spark, log, next_number, {"run": run, "parts": new, "buckets": buckets, "rewritten": sorted(touched), "schema": ddl, "key": key, "stamp": stamp}):
            discard(mine)
            return next_number
        number, body = logs.latest(spark, log)
    raise RuntimeError(f"no commit to {root} after {attempts} attempts")
