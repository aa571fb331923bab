"""Tables of commits and releases that share parts, against plain dictionaries; two writers at a time."""

import os
import random
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from quern.functions import digests, logs
from quern.sources import derived, keyed

ROWS = "key string, value int"


def put(spark, root, rows, **more):
    return keyed.upsert(spark.createDataFrame(rows, ROWS), root, "key", **more)


def held(spark, root, number=None):
    return {r.key: (r.value, r.first_seen, r.last_seen) for r in keyed.read(spark, root, ROWS, number).collect()}


def test_batches_against_a_dictionary(spark, tmp_path):
    root, rng, want = str(tmp_path / "t"), random.Random(1), {}
    assert held(spark, root) == {}
    for k in range(4):
        rows = {rng.choice([*"abcdefghijklmnop", None]): rng.randint(0, 99) for _ in range(8)}
        put(spark, root, list(rows.items()), stamp=f"t{k}", buckets=4)
        want.update({key: (v, want.get(key, (0, f"t{k}"))[1], f"t{k}") for key, v in rows.items()})
        assert held(spark, root) == want
    assert logs.numbers(spark, f"{root}/_commits") == [1, 2, 3, 4] and len(held(spark, root, 1)) <= 8
    gone = spark.createDataFrame([("a", 0, True), (None, 0, True), ("zz", 1, False)], "key string, value int, gone boolean")
    keyed.upsert(gone, root, "key", gone="gone", stamp="t9")
    assert held(spark, root) == {**{k: v for k, v in want.items() if k not in ("a", None)}, "zz": (1, "t9", "t9")}


def test_odd_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, [("a", 1), ("a", 1), ("b", None)], stamp="t1")
    assert held(spark, root) == {"a": (1, "t1", "t1"), "b": (None, "t1", "t1")}
    assert put(spark, root, [], stamp="t2") == 2 and len(held(spark, root)) == 2
    with pytest.raises(ValueError):
        keyed.upsert(spark.createDataFrame([("a", "text")], "key string, value string"), root, "key")
    with pytest.raises(ValueError):
        keyed.read(spark, root, ROWS, 7)
    clash = spark.createDataFrame([("a", 1, 2, 3, "x")], "key string, old int, new int, row int, `_k` string")
    keyed.upsert(clash, str(tmp_path / "u"), "key")
    assert keyed.read(spark, str(tmp_path / "u"), "").drop("first_seen", "last_seen").collect() == clash.collect()


def test_a_batch_rewrites_what_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, [(f"k{i}", i) for i in range(200)])
    before = logs.latest(spark, f"{root}/_commits")[1]["parts"]
    put(spark, root, [("k7", -1)])
    after = logs.latest(spark, f"{root}/_commits")[1]["parts"]
    assert len(before) == keyed.BUCKETS and sum(before[b] != after[b] for b in before) == 1
    assert [r.buckets for r in keyed.history(spark, root).orderBy("number").collect()] == [keyed.BUCKETS, 1]


@pytest.mark.parametrize("mine, theirs", [("a", "b"), ("a", "a")])
def test_a_commit_in_between_is_kept(spark, tmp_path, monkeypatch, mine, theirs):
    """Another batch commits after this one was worked out and before its own commit."""
    root, real, once = str(tmp_path / "t"), logs.commit, []

    def late(spark_, log, number, body):
        if not once:
            once.append(1)
            put(spark, root, [(theirs, 2), ("other", 2)], stamp="theirs")
        return real(spark_, log, number, body)

    put(spark, root, [("old", 0)], stamp="t0")
    monkeypatch.setattr(logs, "commit", late)
    assert put(spark, root, [(mine, 1)], stamp="mine") == 3
    want = {"old": (0, "t0", "t0"), "other": (2, "theirs", "theirs"), theirs: (2, "theirs", "theirs")}
    want[mine] = (1, "theirs" if mine == theirs else "mine", "mine")
    assert held(spark, root) == want


def test_two_writers_at_a_time(spark, tmp_path):
    root, failed = str(tmp_path / "t"), []

    def write(who):
        try:
            for k in range(3):
                put(spark, root, [(f"{who}{k}", k), ("both", k)], buckets=2)
        except Exception as e:
            failed.append(e)

    writers = [threading.Thread(target=write, args=(w,)) for w in "xy"]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert not failed and set(held(spark, root)) == {f"{w}{k}" for w in "xy" for k in range(3)} | {"both"}
    assert logs.numbers(spark, f"{root}/_commits") == list(range(1, 7))


def test_one_of_many_makes_a_file(spark, tmp_path):
    made = []
    race = lambda k: made.append((k, logs.create_text(spark, f"{tmp_path}/one.json", str(k))))
    many = [threading.Thread(target=race, args=(k,)) for k in range(12)]
    [t.start() for t in many]
    [t.join() for t in many]
    winners = [k for k, won in made if won]
    assert len(winners) == 1 and logs.read_text(spark, f"{tmp_path}/one.json") == str(winners[0])
    assert [f for f in os.listdir(tmp_path) if "draft" in f and not f.endswith(".crc")] == []


# releases -----------------------------------------------------------------------------------------

INDEX = "path string, patient string, split string, label int"


def index(spark, n=120):
    return spark.createDataFrame([(f"p{i % 12}/{i}.txt", f"p{i % 12}", ("train", "validation", "test")[(i % 12) // 4 if i % 12 > 3 else 0], i % 2) for i in range(n)], INDEX)


def test_a_derived_release_shares_parts(spark, tmp_path):
    root = str(tmp_path / "r")
    whole = derived.publish(index(spark), root, "v1", buckets=4)
    with pytest.raises(FileExistsError):
        derived.publish(index(spark), root, "v1", buckets=4)
    chosen = spark.createDataFrame([("p0",), ("p1",)], "patient string")
    small = derived.derive(spark, root, "v1", "v1.1", chosen, "patient", {"budget": 2})
    same = lambda body: {(p["split"], p["bucket"]): p["digest"] for p in body["parts"] if p["split"] != "train"}
    assert same(whole) == same(small) and not any(p["new"] for p in small["parts"] if p["split"] != "train")
    want = {tuple(r) for r in index(spark).filter("split <> 'train' or patient in ('p0', 'p1')").collect()}
    assert {tuple(r) for r in derived.read(spark, root, "v1.1").collect()} == want and small["about"] == {"budget": 2}
    assert derived.read(spark, root, "v1", "test").count() == index(spark).filter("split = 'test'").count()
    derived.publish(index(spark).repartition(5), root, "v1-again", buckets=4, derived_from="v1.1")
    again = derived.describe(spark, root, "v1-again")
    assert not any(p["new"] for p in again["parts"])  # order of rows and files doesn't count
    assert [(r.node, r.level) for r in derived.ancestors(spark, root, "v1-again").orderBy("level").collect()] == [("v1-again", 0), ("v1.1", 1), ("v1", 2)]
    assert derived.verify(spark, root, "v1-again").collect() == []


def test_verification_follows_parents(spark, tmp_path):
    root = str(tmp_path / "r")
    derived.publish(index(spark), root, "v1", buckets=2)
    derived.publish(index(spark).withColumn("label", F.when(F.col("split") == "test", 9).otherwise(F.col("label"))), root, "v2", derived_from="v1", buckets=2)
    assert {(r.version, r.split, r.issue) for r in derived.verify(spark, root, "v2").collect()} == {("v2", "test", "not-inherited")}
    train = [p for p in derived.describe(spark, root, "v1")["parts"] if p["split"] == "train"]
    shutil.rmtree(f"{root}/parts/digest={train[0]['digest']}")
    where = f"{root}/parts/digest={train[1]['digest']}"
    rows = spark.read.schema(INDEX).parquet(where).withColumn("label", F.lit(5)).collect()
    shutil.rmtree(where)
    spark.createDataFrame(rows, INDEX).write.parquet(where)
    got = {(r.version, r.bucket, r.issue) for r in derived.verify(spark, root, "v1").collect()}
    assert got == {("v1", train[0]["bucket"], "missing"), ("v1", train[1]["bucket"], "modified")}
    with pytest.raises(FileNotFoundError):
        derived.describe(spark, root, "v9")


def test_an_empty_release(spark, tmp_path):
    root = str(tmp_path / "r")
    derived.publish(index(spark).limit(0), root, "v0")
    assert derived.read(spark, root, "v0").columns == ["path", "patient", "split", "label"] and derived.verify(spark, root, "v0").count() == 0


def test_row_digests_tell_cells_apart(spark):
    rows = [(None, "a"), ("", "a"), ("-", "a"), ("a\n+b", "c"), ("a", "b\n+c"), ("a\\n", "b"), ("a\n", "b")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(digests.row_digest(F.col("x"), F.col("y")).alias("d")).distinct().count() == len(rows)
