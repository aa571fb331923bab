"""Readers, snapshots, streams, releases, audited runs and images on small files."""

import json
import os
import stat

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import audit, imaging, release
from quern.sources import audited, keyed, readers, releases, snapshots
from quern.streaming import ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_files_and_checksums(spark, tmp_path):
    import hashlib

    put(tmp_path / "d/a.txt", "one")
    put(tmp_path / "d/sub/b c.txt", "two")
    got = {r.rel_path.replace("%20", " "): (r.sha256, r.size_bytes) for r in readers.files(spark, f"{tmp_path}/d").collect()}
    assert got == {"a.txt": (hashlib.sha256(b"one").hexdigest(), 3), "sub/b c.txt": (hashlib.sha256(b"two").hexdigest(), 3)}
    put(tmp_path / "SUMS", "abc a.txt\n\ndef  sub/b c.txt\n")
    assert sorted(map(tuple, readers.checksums(spark, f"{tmp_path}/SUMS").collect())) == [("a.txt", "abc"), ("sub/b c.txt", "def")]


def test_tables_with_odd_headers(spark, tmp_path):
    put(tmp_path / "wide.csv", "﻿Patient , Slice\n49,1\n50,2\n")
    got = readers.wide_labels(spark, f"{tmp_path}/wide.csv", "`﻿Patient ` int, ` Slice` int")
    assert got.columns == ["Patient", "Slice"] and sorted(map(tuple, got.collect())) == [(49, 1), (50, 2)]
    put(tmp_path / "p.csv", '"Patient\nNumber",Age (years)\n49,3\n')
    assert readers.profiles(spark, f"{tmp_path}/p.csv").columns == ["Patient Number", "Age (years)"]


def test_runs_and_attachments(spark, tmp_path):
    for run, t in (("run-1", 0.25), ("run-2", 0.5)):
        put(tmp_path / f"runs/{run}/run.json", json.dumps({"run_id": run, "dataset_version": "v1", "selected_threshold": t}))
        spark.createDataFrame([("P", 0.3)], "patient string, score double").write.parquet(f"{tmp_path}/runs/{run}/predictions")
    assert readers.latest_run(spark, f"{tmp_path}/runs") == "run-2"
    assert readers.run(spark, f"{tmp_path}/runs/run-2").first().threshold == 0.5
    rows = spark.createDataFrame([("attachment", "10"), ("attachment", "9"), ("item", "1")], "kind string, n string")
    assert [r.n for r in readers.attachments(rows, F.col("n")).collect()] == ["9", "10"]


def test_snapshots_and_stream(spark, tmp_path):
    root = f"{tmp_path}/snap"
    assert snapshots.current(spark, root, ingest.INVENTORY).count() == 0
    spark.createDataFrame([("a", "1", 1), ("b", "2", 2)], ingest.INVENTORY).write.parquet(f"{tmp_path}/in")
    ingest.ingest(spark, f"{tmp_path}/in", root, f"{tmp_path}/cp").awaitTermination()
    spark.createDataFrame([("b", "3", 2), ("c", "4", 4)], ingest.INVENTORY).write.mode("append").parquet(f"{tmp_path}/in")
    ingest.ingest(spark, f"{tmp_path}/in", root, f"{tmp_path}/cp").awaitTermination()
    table = keyed.read(spark, root, ingest.INVENTORY)
    assert all((r.first_seen < r.last_seen) == (r.rel_path == "b") for r in table.collect())
    got = table.select("rel_path", "sha256", "size_bytes")
    assert sorted(map(tuple, got.collect())) == [("a", "1", 1), ("b", "3", 2), ("c", "4", 4)]
    names = [snapshots.publish(t, f"{tmp_path}/versions") for t in (got, got.limit(1))]
    assert snapshots.current(spark, f"{tmp_path}/versions", ingest.INVENTORY).count() == 1 and len(set(names)) == 2
    snapshots.write_csv(got, f"{tmp_path}/csv")
    snapshots.write_json(got, f"{tmp_path}/json")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).count() == spark.read.json(f"{tmp_path}/json").count() == 3
    events = spark.createDataFrame([("2024-01-01 10:05:00", "x"), ("2024-01-01 10:55:00", "x"), ("2024-01-01 11:05:00", "x")], "ts string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.n for r in ingest.event_rates(events).collect()) == [1, 2]


def make_release(spark, path):
    index = spark.createDataFrame([("PAT-a", "train", "PAT-a/en/1.txt", "s1"), ("PAT-b", "test", "PAT-b/en/2.txt", "s2"), ("PAT-z", "test", "PAT-z/en/3.txt", "s3")], "patient string, split string, path string, sha256 string")
    splits = spark.createDataFrame([("PAT-a", "train"), ("PAT-b", "test")], "patient string, split string")
    stats = spark.createDataFrame([("train", 1), ("test", 2)], "split string, n long")
    releases.publish(index, splits, stats, {"version": "v1"}, path, ["one issue"])


def test_release_is_written_once_and_verified(spark, tmp_path):
    path = f"{tmp_path}/v1"
    make_release(spark, path)
    with pytest.raises(FileExistsError):
        make_release(spark, path)
    assert "one issue" in open(f"{path}/card.md").read() and json.load(open(f"{path}/metadata.json"))["statistics"][1]["n"] == 2
    assert not os.stat(f"{path}/card.md").st_mode & stat.S_IWUSR and readers.releases(spark, str(tmp_path)).first().version == "v1"
    tokens = spark.createDataFrame([("p1", "PAT-a"), ("p2", "PAT-b"), ("3", "PAT-c")], "identifier string, pseudonym string")
    curated = spark.createDataFrame([("p1/en/1.txt", "s1"), ("p2/en/2.txt", "other")], "rel_path string, sha256 string")
    found = lambda: sorted(map(tuple, releases.verify(spark, path, curated, tokens).collect()))
    assert found() == [("privacy", "3", "real-id-in-index"), ("references", "PAT-b/en/2.txt", "content-changed"), ("references", "PAT-z/en/3.txt", "unresolvable-pseudonym")]
    os.chmod(f"{path}/card.md", 0o644)
    open(f"{path}/card.md", "a").write("x")
    os.remove(f"{path}/.card.md.crc") if os.path.exists(f"{path}/.card.md.crc") else None
    os.remove(f"{path}/metadata.json")
    assert [x for x in found() if x[0] == "release_files"] == [("release_files", "card.md", "modified"), ("release_files", "metadata.json", "missing")]
    gone = release.references(releases.read(spark, path), curated.limit(0), tokens).filter("issue = 'missing'")
    assert gone.count() == 2
    os.remove(f"{path}/CHECKSUMS.txt")
    assert found() == [("release_files", "CHECKSUMS.txt", "missing")]


def test_audited_runs(spark, tmp_path):
    log, out = f"{tmp_path}/log", tmp_path / "out"
    put(tmp_path / "in/x.txt", "input")
    put(out / "old.txt", "old")
    with audited.audited(spark, log, "build", {"b": 1, "a": 2}, (f"{tmp_path}/in",), (str(out),)) as record:
        put(out / "new.txt", "new")
        os.remove(out / "old.txt")
        record["exit_code"] = 0
    with pytest.raises(ValueError), audited.audited(spark, log, "break", {}):
        raise ValueError("no")
    with audited.audited(spark, log, "check", {}, outputs=(str(out),)) as record:
        record["exit_code"] = 3
    a, b, c = audited.read_log(spark, log)
    assert (a["seq"], a["prev_hash"], a["status"]) == (1, audited.sealed_after(None, {})["prev_hash"], "ok") and a["inputs"][0]["n_files"] == 1
    assert a["outputs"][0]["created"] == {"count": 1, "names": ["new.txt"]} and a["outputs"][0]["deleted"]["names"] == ["old.txt"]
    assert b["status"] == "error" and "ValueError" in b["error"] and c["status"] == "failed" and c["outputs"][0]["modified"]["count"] == 0
    assert audited.verify_log([a, b, c])["ok"] and a["config_sha256"] == audited.config_sha256({"a": 2, "b": 1})
    assert audited.verify_log([a, {**b, "command": "other"}, c])["detail"] == "record_hash mismatch" and audited.verify_log([a, c])["detail"] == "sequence gap"


def test_images(spark, tmp_path):
    gray = np.arange(64, dtype=np.uint8).reshape(8, 8)
    assert imaging.normalise_mask(gray, 31).sum() == 255 * 32
    tinted = imaging.overlay(gray, imaging.normalise_mask(gray, 31), 0.5)
    assert tinted.shape == (8, 8, 3) and tinted[0, 0].tolist() == [0, 0, 0] and tinted[7, 7, 0] > tinted[7, 7, 1]
    header = b"BM" + (54 + 12).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (2).to_bytes(4, "little") + (1).to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24)
    (tmp_path / "img").mkdir()
    (tmp_path / "img/ok.bmp").write_bytes(header + bytes([10, 20, 30, 200, 210, 220]) + bytes(2))
    (tmp_path / "img/bad.bmp").write_bytes(b"no image")
    got = {os.path.basename(r.path): r for r in imaging.validate(imaging.read_images(spark, f"{tmp_path}/img"), (2, 1)).collect()}
    assert got["bad.bmp"].reasons == ["unreadable"] and got["ok.bmp"].reasons == [] and got["ok.bmp"].width == 2


def test_plans_have_no_nested_loops_or_single_tasks(spark):
    import test_queries as t

    if not os.path.isdir(t.SF):
        pytest.skip("the driver's tables aren't here")
    plan = lambda name: t.QUERIES[name](spark, t.SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan("lineage_producer") and "Cartesian" not in plan("lineage_producer")
    for name in ("audit_chain_build", "audit_inclusion", "pool_split", "stratified_split", "duplicate_of_first"):
        lines = plan(name).split("\n")
        assert not [x for x in lines if "SinglePartition" in x and "range" not in x and "partial" not in x], name
