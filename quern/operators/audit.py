"""Audit log: hash chain, verification, directory differences, producers and ancestry."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.storage import materialize
from quern.operators import folders, merkle, pathtree

GENESIS = merkle.GENESIS
MAX_DEPTH = 10
#: What a record's own hash leaves out.
OWN = "record_hash"


def canonical(value: object) -> str:
    """JSON with sorted keys and no spaces; what JSON doesn't know becomes text."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), default=str)


def sealed_after(last: dict | None, record: dict) -> dict:
    """``record`` as the one after ``last``: numbered, with the hash before it and its own, which is
    SHA-256 over that hash, a line end and the rest of the record."""
    at, before = (last["seq"], last[OWN]) if last else (0, GENESIS)
    body = {k: v for k, v in record.items() if k != OWN} | {"seq": at + 1, "prev_hash": before}
    return body | {OWN: hashlib.sha256("\n".join((before, canonical(body))).encode()).hexdigest()}


def _leaves(log: DataFrame, payload: Column, seq: str) -> DataFrame:
    return log.select((F.col(seq).cast("long") - 1).alias("pos"), merkle.leaf(payload).alias("hash"))


def _rooted(log: DataFrame, payload: Column, order: str) -> DataFrame:
    return merkle.rooted_stretches(log, F.col(order).cast("long") - 1, merkle.leaf(payload))


def linked(log: DataFrame, payload: Column, order: str) -> DataFrame:
    """``log`` (numbered from 1) with prev_hash and record_hash: the roots of the hash trees over all
    records before a row, and over those and itself. So an edit anywhere changes every later row."""
    return _rooted(log, payload, order).select(F.explode("rows").alias("r")).select("r.row.*", "r.prev_hash", "r.record_hash")


def breaks(log: DataFrame, payload: Column, seq: str = "seq", stored: str = "record_hash", prev: str = "prev_hash") -> DataFrame:
    """(seq, detail) for every row that doesn't fit: a number that is missing before it or that stands
    twice, a previous hash that isn't the root over all rows before, or a record hash that isn't the
    root with its own content; the first that holds. Rows after a break don't fit either.

    The tree is built anew from the payloads, so rows that were resealed after an edit are found out
    by the first row that wasn't; a log that was resealed to its end needs ``verify``'s root. Rows are
    judged within their stretch, which is told whether the one before it has its last row.
    """
    pos = F.col(seq).cast("long") - 1
    ends = log.select(pos.alias("pos")).filter(F.pmod("pos", F.lit(merkle.SPAN)) == merkle.SPAN - 1)
    ends = ends.select((F.shiftright("pos", merkle.BITS) + 1).alias("group"), F.lit(True).alias("before")).distinct()
    places = F.array_distinct(F.transform("rows", lambda r: r["pos"]))
    found = _rooted(log, payload, seq).join(ends.hint("shuffle_hash"), "group", "left").select("rows", "before", F.shiftleft("group", merkle.BITS).alias("first"), places.alias("places"))

    def judged(r: Column) -> Column:
        row, at = r["row"], r["pos"]
        follows = F.when(at == F.col("first"), F.coalesce("before", F.lit(False))).otherwise(F.array_contains("places", at - 1))
        # where all places differ nothing has to be counted
        twice = (F.size("places") < F.size("rows")) & (F.size(F.filter("rows", lambda o: o["pos"] == at)) > 1)
        detail = (
            F.when((row[seq] != 1) & ~follows, "sequence gap")
            .when(twice, "sequence repeated")
            .when(row[prev] != r["prev_hash"], "prev_hash mismatch")
            .when(row[stored] != r["record_hash"], "record_hash mismatch")
        )
        return F.struct(row[seq].alias(seq), detail.alias("detail"))

    wrong = F.filter(F.transform("rows", judged), lambda j: j["detail"].isNotNull())
    return found.select(F.explode(wrong).alias("j")).select("j.*")


def verify(found: DataFrame, n_records: DataFrame, seq: str = "seq", root: tuple[str | None, str] | None = None) -> DataFrame:
    """One row: ok, n_records, broken_at, detail of the first break. With ``root`` = (the log's root
    now, the one that was noted elsewhere) a log that fits itself must have the noted root too."""
    first = found.agg(F.min(F.struct(seq, "detail")).alias("b"))
    other = F.lit(bool(root and root[0] != root[1]))
    detail = F.coalesce(F.col("b.detail"), F.when(other, "root mismatch"))
    return n_records.crossJoin(first).select(detail.isNull().alias("ok"), "n_records", F.col(f"b.{seq}").alias("broken_at"), detail.alias("detail"))


def inclusion(log: DataFrame, payload: Column, order: str = "seq") -> DataFrame:
    """(order, leaf, path, root) of each row: what shows that the row is part of the log with that
    root, without the other rows (see ``merkle.climbed``)."""
    paths = merkle.with_paths(_leaves(log, payload, order))
    return paths.select((F.col("pos") + 1).alias(order), F.col("hash").alias("leaf"), "path", merkle.climbed(F.col("hash"), F.col("path")).alias("root"))


def directory_diff(before: DataFrame, after: DataFrame, path: str = "rel_path") -> DataFrame:
    """(path, change): created, deleted or modified by size and time; unchanged files aren't listed.
    Only folders whose digests differ are looked into."""
    return folders.changes(before, after, ["size_bytes", "mtime"], path)


def changed_paths(log: DataFrame) -> DataFrame:
    """(seq, run_id, changed, coarse) of a log's outputs: a row for each listed path, and a coarse one for the
    place itself where more changed than was listed. Missing places changed nothing."""
    outputs = log.select("seq", "run_id", F.explode("outputs").alias("o")).filter("o.kind is null or o.kind <> 'missing'")
    kinds = F.array("o.created", "o.deleted", "o.modified")
    listed = F.flatten(F.transform(kinds, lambda k: F.coalesce(k["names"], F.array().cast("array<string>"))))
    more = F.exists(kinds, lambda k: F.coalesce(k["count"], F.lit(0)) > F.coalesce(F.size(k["names"]), F.lit(0)))
    place = F.rtrim("o.path", F.lit("/"))
    named = outputs.select("seq", "run_id", F.explode(F.transform(listed, lambda n: F.when(n == "", place).otherwise(F.concat_ws("/", place, n)))).alias("changed"), F.lit(False).alias("coarse"))
    return named.union(outputs.filter(more).select("seq", "run_id", place, F.lit(True)))


def producers(runs: DataFrame, targets: DataFrame) -> DataFrame:
    """(target, run_id, seq): the newest run before ``before_seq`` that changed each target: the path itself,
    something inside, or something that holds it (see ``pathtree.newest_touching``)."""
    return pathtree.newest_touching(runs, targets)


def trace(start: DataFrame, edges: DataFrame, depth: int = MAX_DEPTH) -> DataFrame:
    """(node, level): everything that ``start`` (node) rests on over ``edges`` (child, parent), each
    at its least level, up to ``depth``. Rounds end when one finds nothing new.

    Every round's new nodes are written, so that no round works out an earlier one again. A node's
    edges are of use once, so a round writes the edges that it didn't use for the next one; equal
    edges fall together there.
    """
    left = edges.select("child", "parent").filter("child is not null")
    front = seen = materialize(start.select("node").distinct().withColumn("level", F.lit(0)), "trace")
    for level in range(1, depth + 1):
        met = left.join(front.select(F.col("node").alias("child"), F.lit(True).alias("met")), "child", "left")
        # of used edges the parents remain
        step = materialize(met.select(F.when(F.col("met").isNull(), F.col("child")).alias("child"), "parent").distinct(), "trace-edges")
        left, above = step.filter("child is not null"), step.filter("child is null").select(F.col("parent").alias("node"))
        front = materialize(above.join(seen.select("node"), "node", "left_anti").withColumn("level", F.lit(level)), "trace")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def tail(log: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """The newest ``n`` records of a log."""
    return log.orderBy(F.desc(seq)).limit(n)
