"""The hash tree over a log, fingerprints of folders, audited runs and line numbers, against brute force."""

import hashlib
import json
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from quern.operators import audit, folders, merkle
from quern.sources import audited, readers, settings

# the tree -----------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    """The root by halving at the largest power of two below the number of leaves."""
    if len(leaves) == 1:
        return leaves[0]
    half = 1
    while 2 * half < len(leaves):
        half *= 2
    return sha(f"node\n{tree(leaves[:half])}\n{tree(leaves[half:])}")


@pytest.mark.parametrize("n, bits", [(1, 2), (4, 2), (5, 2), (37, 2), (70, 3), (20, 8)])
def test_roots_and_paths(spark, n, bits):
    own = [sha(f"leaf\n{i}") for i in range(n)]
    leaves = spark.range(n).select(F.col("id").alias("pos"), merkle.leaf(F.col("id").cast("string")).alias("hash")).repartition(3)
    got = {r.pos: (r.prev_hash, r.record_hash) for r in merkle.prefix_roots(leaves, bits).collect()}
    assert got == {i: (tree(own[:i]) if i else merkle.GENESIS, tree(own[: i + 1])) for i in range(n)}
    assert merkle.root(leaves, bits) == tree(own)
    climbed = merkle.inclusion_paths(leaves, bits).join(leaves, "pos").select(merkle.climbed(F.col("hash"), F.col("path")).alias("root"), F.size("path").alias("steps")).collect()
    assert len(climbed) == n and {r.root for r in climbed} == {tree(own)} and max(r.steps for r in climbed) <= max(n - 1, 0).bit_length()


def test_an_empty_log_has_no_root(spark):
    assert merkle.root(spark.createDataFrame([], "pos long, hash string")) is None
    log = spark.createDataFrame([], "seq long, payload string")
    assert audit.linked(log, F.col("payload"), "seq").count() == 0 and audit.inclusion(log, F.col("payload")).count() == 0


def test_a_tree_with_holes_and_repeats(spark):
    rows = [(i, sha(str(i))) for i in range(40) if i not in (3, 9, 10)]
    holes = spark.createDataFrame(rows, "pos long, hash string")
    whole = spark.createDataFrame([(i, sha(str(i))) for i in range(40)], "pos long, hash string")
    a, b = ({r.pos: r.record_hash for r in merkle.prefix_roots(t, 3).collect()} for t in (holes, whole))
    assert all((a[i] == b[i]) == (i < 3) for i in range(40) if i in a)
    twice = spark.createDataFrame([*rows, (5, sha("5"))], "pos long, hash string")
    assert {r.pos: r.record_hash for r in merkle.prefix_roots(twice, 3).collect()} == a


def sealed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts, 1)), "seq long, payload string")
    return [tuple(r) for r in audit.linked(df, F.col("payload"), "seq").select("seq", "payload", "prev_hash", "record_hash").orderBy("seq").collect()]


def verdict(spark, rows, root=None):
    log = spark.createDataFrame(rows, "seq long, payload string, prev_hash string, record_hash string")
    r = audit.verify(audit.breaks(log, F.col("payload")), log.agg(F.count("*").alias("n_records")), root=root).first()
    return r.ok, r.broken_at, r.detail


def test_an_edit_that_was_resealed_is_found(spark):
    honest = sealed(spark, [f"p{i}" for i in range(1, 9)])
    forged = sealed(spark, [f"p{i}" if i != 4 else "edited" for i in range(1, 9)])
    assert verdict(spark, honest) == (True, None, None)
    assert verdict(spark, [*honest[:3], forged[3], *honest[4:]]) == (False, 5, "prev_hash mismatch")
    assert verdict(spark, [*honest[:3], *forged[3:5], *honest[5:]]) == (False, 6, "prev_hash mismatch")
    assert verdict(spark, [*honest[:3], *forged[3:7], honest[7]]) == (False, 8, "prev_hash mismatch")
    assert verdict(spark, [*honest[:4], honest[3], *honest[4:]]) == (False, 4, "sequence repeated")
    # resealed to its end, a log is told by a root that was noted elsewhere
    assert verdict(spark, forged)[0] and verdict(spark, forged, (forged[-1][3], honest[-1][3])) == (False, None, "root mismatch")


def plan(spark, df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """Joins as of tables too large for a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_paths_stay_where_they_are_made(spark, shuffled):
    log = spark.createDataFrame([(i, f"p{i}") for i in range(1, 301)] + [(7, "again")], "seq long, payload string")
    found = audit.inclusion(log, F.col("payload"))
    assert "SortMergeJoin" not in plan(spark, found)
    rows = found.collect()
    root = tree([max(sha(f"leaf\np{i}"), sha("leaf\nagain")) if i == 7 else sha(f"leaf\np{i}") for i in range(1, 301)])
    assert len(rows) == 301 and sum(r.root != root for r in rows) == 1 and {r.seq for r in rows if r.root != root} == {7}


def test_rows_stay_in_their_stretch(spark, shuffled):
    """A log over two stretches: edits and missing rows at the border, and a repeated row."""
    honest = sealed(spark, [f"p{i}" for i in range(1, 301)])
    log = spark.createDataFrame(honest, "seq long, payload string, prev_hash string, record_hash string")
    assert "SortMergeJoin" not in plan(spark, audit.linked(log.select("seq", "payload"), F.col("payload"), "seq"))
    assert "SortMergeJoin" not in plan(spark, audit.breaks(log, F.col("payload")))
    assert verdict(spark, honest) == (True, None, None)
    for gone in (255, 256, 257):
        assert verdict(spark, [r for r in honest if r[0] != gone]) == (False, gone + 1, "sequence gap")
    assert verdict(spark, [*honest, honest[256]]) == (False, 257, "sequence repeated")
    assert verdict(spark, [*honest[:256], (257, "edited", *honest[256][2:]), *honest[257:]]) == (False, 257, "record_hash mismatch")


def test_a_trace_uses_edges_once(spark, monkeypatch):
    handed = []
    written = audit.materialize

    def recorded(df, name):
        table = written(df, name)
        if name == "trace-edges":
            handed.append(table.filter("child is not null").count())
        return table

    monkeypatch.setattr(audit, "materialize", recorded)
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c"), ("b", "d"), ("b", "d"), ("d", "a"), ("x", "y"), (None, "z")], "child string, parent string")
    got = {(r.node, r.level) for r in audit.trace(spark.createDataFrame([("a",)], "node string"), edges).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 1), ("d", 2)} and handed == [3, 2, 1]


# folders ------------------------------------------------------------------------------------------

FILES = "rel_path string, size_bytes long, mtime int"


def plain_digest(rows):
    total = sum(int(sha("\n".join([p, str(s), str(m)])), 16) for p, s, m in rows)
    return f"{total % (1 << 256):064x}"


def test_folder_digests_against_sums(spark):
    rng = random.Random(4)
    rows = [("/".join(rng.choice("abc") for _ in range(rng.randint(0, 3))) + f"/{k}.txt", k, 1) for k in range(200)]
    rows = [(p.lstrip("/"), s, m) for p, s, m in rows]
    df = spark.createDataFrame(rows, FILES).repartition(4)
    one = folders.fingerprint(df, ["size_bytes", "mtime"]).first()
    assert (one.n_files, one.bytes, one.digest) == (200, sum(s for _, s, _ in rows), plain_digest(rows))
    for r in folders.folders(df, ["size_bytes", "mtime"]).collect():
        inside = [x for x in rows if x[0].startswith(f"{r.folder}/") or not r.folder]
        direct = [x for x in inside if x[0].rpartition("/")[0] == r.folder]
        assert (r.n_files, r.digest, r.own) == (len(inside), plain_digest(inside), plain_digest(direct))
        assert r.parent == (r.folder.rpartition("/")[0] if r.folder else None) and r.depth == (r.folder.count("/") + 1 if r.folder else 0)
    empty = folders.fingerprint(df.limit(0), ["mtime"]).first()
    assert (empty.n_files, empty.bytes, empty.digest) == (0, 0, "0" * 64)


def test_many_files_change(spark):
    """100,000 files: the changes are those of a full comparison, and few folders are looked into."""
    path = lambda i: F.concat_ws("/", F.concat(F.lit("d"), (i % 40).cast("string")), F.concat(F.lit("e"), (i % 1000).cast("string")), F.concat(i.cast("string"), F.lit(".bin")))
    before = spark.range(100_000).select(path(F.col("id")).alias("rel_path"), F.col("id").alias("size_bytes"), F.lit(1).alias("mtime"), "id")
    after = before.filter("id % 40 <> 7 or id % 1000 <> 47").withColumn("size_bytes", F.when(F.col("id").isin(5, 4005, 77000), -1).otherwise(F.col("size_bytes")))
    new = spark.createDataFrame([("x/y/z.txt", 1, 1), ("top.txt", 1, 1)], FILES)
    after = after.drop("id").union(new)
    got = {(r.rel_path, r.change) for r in folders.changes(before, after, ["size_bytes", "mtime"]).collect()}
    a, b = ({r.rel_path: r.size_bytes for r in t.collect()} for t in (before, after))
    assert got == {(p, "deleted") for p in a.keys() - b.keys()} | {(p, "created") for p in b.keys() - a.keys()} | {(p, "modified") for p in a.keys() & b.keys() if a[p] != b[p]}
    looked = folders.changed_folders(folders.folders(before, ["size_bytes"]), folders.folders(after, ["size_bytes"])).filter("direct").count()
    assert len(got) == 100 + 3 + 2 and looked == 5
    one = lambda t: folders.fingerprint(t, ["size_bytes"]).first()
    assert one(before) == one(before.repartition(7)) and one(before) != one(after)


# audited runs -------------------------------------------------------------------------------------


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_records_follow_each_other():
    log = []
    for k in range(4):
        log.append(audit.sealed_after(log[-1] if log else None, {"run": k}))
    assert log[0]["prev_hash"] == audit.GENESIS and [r["seq"] for r in log] == [1, 2, 3, 4]
    assert all(b["prev_hash"] == a["record_hash"] for a, b in zip(log, log[1:]))
    body = {k: v for k, v in log[2].items() if k != "record_hash"}
    assert log[2]["record_hash"] == sha(log[1]["record_hash"] + "\n" + json.dumps(body, sort_keys=True, separators=(",", ":")))
    assert audited.verify_log(log)["ok"]
    edited = audit.sealed_after(log[0], {"run": "other"})
    assert audited.verify_log([log[0], edited, *log[2:]]) == {"ok": False, "n_records": 4, "broken_at": 3, "detail": "prev_hash mismatch"}


def test_a_log_is_read_with_its_schema(spark, tmp_path):
    log, out = f"{tmp_path}/log", tmp_path / "out"
    with audited.audited(spark, log, "build", {"b": 1}, (f"{tmp_path}/nowhere",), (str(out),)):
        for k in range(60):
            write(out / f"{k:02}.txt", "x")
    first = audited.read_log(spark, log)[0]
    assert first["inputs"][0]["kind"] == "missing" and first["actor"].count("@") == 1 and first["duration_s"] > 0
    assert first["outputs"][0]["created"] == {"count": 60, "names": [f"{k:02}.txt" for k in range(50)]}
    row = readers.audit_log(spark, log).first()
    assert row.seq == 1 and row.outputs[0].created["count"] == 60 and row.record_hash == first["record_hash"]


def test_two_writers_lose_nothing(spark, tmp_path):
    log = f"{tmp_path}/log"
    run = lambda who: [audited.append(spark, log, {"who": who, "k": k}) for k in range(5)]
    writers = [threading.Thread(target=run, args=(w,)) for w in "ab"]
    [w.start() for w in writers]
    [w.join() for w in writers]
    records = audited.read_log(spark, log)
    assert sorted((r["who"], r["k"]) for r in records) == [(w, k) for w in "ab" for k in range(5)] and audited.verify_log(records)["ok"]
    write(tmp_path / "log/HEAD", "2")  # a late or broken head costs time alone
    os.remove(tmp_path / "log/.HEAD.crc")
    assert audited.last_record(spark, log)["seq"] == 10


def test_declared_inputs_and_outputs(spark, tmp_path):
    write(tmp_path / "conf/settings.toml", '[paths]\nraw = "data/raw"\ninventory = "data/inventory"\nlabels = "s3://bucket/labels"\nreports = "/abs/reports"\n[split]\nseed = 3\n')
    got = settings.load(spark, f"{tmp_path}/conf/settings.toml")
    assert got.rest == {"split": {"seed": 3}} and got.resolve("labels") == "s3://bucket/labels" and got.resolve("reports/gates") == "/abs/reports/gates"
    assert got.declared("ingest") == ((f"{tmp_path}/conf/data/raw",), (f"{tmp_path}/conf/data/inventory",)) and got.declared("else") == ((), ())
    assert got.declared("curate")[1] == ("/abs/reports/curation", f"{tmp_path}/conf/data/inventory")
    with pytest.raises(KeyError):
        got.resolve("nothing")
    write(tmp_path / "conf/data/raw/a.txt", "a")
    with audited.declared(spark, got, f"{tmp_path}/log", "ingest"):
        write(tmp_path / "conf/data/inventory/part", "rows")
    record = audited.read_log(spark, f"{tmp_path}/log")[0]
    assert [p["n_files"] for p in record["inputs"]] == [1] and record["outputs"][0]["created"]["names"] == ["part"]


def test_bad_lines_have_numbers(spark, tmp_path):
    """Many splits of one file, blank lines counted, and a second file."""
    rng = random.Random(1)
    lines, bad = [], []
    for k in range(1, 3001):
        kind = rng.random()
        lines.append("" if kind < 0.1 else "{no json" if kind > 0.995 else json.dumps({"seq": k, "command": "x" * 40}))
        bad += [k] if kind > 0.995 else []
    write(tmp_path / "log/a.jsonl", "\n".join(lines) + "\n")
    write(tmp_path / "log/b.jsonl", '{"seq": 1}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        marks = readers.line_marks(spark, f"{tmp_path}/log", readers.AUDIT_SCHEMA).collect()
        assert len(marks) > 5 and sum(m["lines"] for m in marks) == 3001 and sum(m["blank"] for m in marks) == lines.count("")
        got = [(os.path.basename(r.file), r.line) for r in readers.bad_lines(spark, f"{tmp_path}/log", readers.AUDIT_SCHEMA).orderBy("line").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert bad and got == [("a.jsonl", k) for k in bad]
    with pytest.raises(ValueError, match=rf"a.jsonl: line {bad[0]} "):
        readers.audit_log(spark, f"{tmp_path}/log")
    os.remove(tmp_path / "log/a.jsonl")
    assert readers.audit_log(spark, f"{tmp_path}/log").count() == 1


# producers ----------------------------------------------------------------------------------------


def test_places_in_a_tree(spark):
    from quern.operators import pathtree

    rng = random.Random(8)
    paths = {"/".join(rng.choice(["a", "a.b", "a b", "ab", "é", "a\x03"]) for _ in range(rng.randint(1, 5))) for _ in range(150)}
    rows = [(p,) for p in [*paths, *list(paths)[:9], None]]
    got = {r.path: (r.low, r.high) for r in pathtree.numbered_tree(spark.createDataFrame(rows, "path string").repartition(4)).collect()}
    assert set(got) == paths and sorted(low for low, _ in got.values()) == list(range(1, len(paths) + 1))
    for p in paths:
        for q in paths:
            assert (got[q][0] < got[p][0] <= got[q][1]) == p.startswith(q + "/"), (p, q)


def test_producers_against_a_search(spark):
    rng = random.Random(9)
    path = lambda: "/".join(["d", *(rng.choice(["v1", "v1.0", "v10", "x"]) for _ in range(rng.randint(0, 3)))])
    runs = [(k, f"r{k}", path(), rng.random() < 0.2) for k in range(120)]
    targets = {path(): rng.randint(0, 130) for _ in range(60)} | {"nowhere": 99, "d/v1/": 99}
    schema = "seq long, run_id string, changed string, coarse boolean"
    got = {r.target: (r.seq, r.run_id) for r in audit.producers(spark.createDataFrame(runs, schema), spark.createDataFrame(list(targets.items()), "target string, before_seq long")).collect()}
    want = {}
    for t, before in targets.items():
        bare = t.rstrip("/")
        hits = [(s, r) for s, r, c, coarse in runs if s < before and (c == bare or bare.startswith(c + "/") or (c.startswith(bare + "/") and not coarse))]
        if hits:
            want[t] = max(hits)
    assert got == want and len(want) > 20


def test_capped_lists_fall_back(spark, tmp_path):
    """More files than a record lists: what isn't listed is found by the place alone; a sibling isn't."""
    log, out = f"{tmp_path}/log", tmp_path / "out"
    with audited.audited(spark, log, "many", {}, outputs=(str(out),)):
        for k in range(60):
            write(out / f"{k:02}.txt", "x")
    with audited.audited(spark, log, "few", {}, outputs=(str(out),)):
        write(out / "03.txt", "longer")
    rows = audit.changed_paths(readers.audit_log(spark, log))
    assert rows.filter("coarse").count() == 1 and rows.count() == 52
    targets = [(f"{out}/03.txt", 9), (f"{out}/59.txt", 9), (str(out), 9), (f"{tmp_path}/outer", 9), (f"{out}/03.txt", 2)]
    got = [(r.target, r.seq) for t in targets for r in audit.producers(rows, spark.createDataFrame([t], "target string, before_seq long")).collect()]
    assert got == [(f"{out}/03.txt", 2), (f"{out}/59.txt", 1), (str(out), 2), (f"{out}/03.txt", 1)]
