"""Small operators: conditions, columns by name, masks, flips, arms, runs, the pseudonym map."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import evaluation, experiments, image_metadata, imaging, pixels, privacy, release, training
from quern.sources import pseudonyms, readers


def test_conditions_that_are_given(spark):
    rows = spark.createDataFrame([(1, "en", "train", "A/x"), (2, "de", "test", "b/X"), (3, None, "test", None), (4, "en", "test", "c")], "k int, variant string, split string, path string")
    ks = lambda **c: sorted(r.k for r in release.select(rows, **c).collect())
    assert ks() == ks(variant=None, text=None) == [1, 2, 3, 4] and ks(variant="en") == [1, 4] and ks(split=["test"], variant="en") == [4]
    assert ks(text="/x", text_columns=("path",)) == [1, 2] and ks(text="en", text_columns=("path", "variant")) == [1, 4] and ks(split=[]) == []


def test_columns_by_name(spark):
    rows = spark.createDataFrame([(1, 2)], "`Age (years)` int, `Patient  Number` int")
    assert privacy.column_like(rows, prefix="age") == "Age (years)" and privacy.column_like(rows, name="patient number") == "Patient  Number"
    assert privacy.column_like(rows, prefix="weight") is None and privacy.column_like(rows, name="age") is None


def test_names_of_all_tables(spark):
    a = spark.createDataFrame([("x", None), (None, None)], "`Patient.Name` string, zip int")
    b = spark.createDataFrame([(1,)], "k int")
    got = {tuple(r) for r in privacy.scan_schemas({"a": a, "b": b, "again": a.select("zip")}).collect()}
    assert got == {("a", "Patient.Name", "name-implies:name", 1), ("a", "zip", "name-implies:zip", 0), ("again", "zip", "name-implies:zip", 0)}


def test_masks_and_pictures(spark):
    rng = np.random.default_rng(0)
    gray, colour = rng.integers(0, 256, (3, 5), dtype=np.uint8), rng.integers(0, 256, (4, 2, 3), dtype=np.uint8)
    both = imaging.side_by_side(gray, colour)
    assert both.shape == (4, 9, 3) and (both[:, 5:7] == 255).all() and (both[3, :5] == 0).all() and (both[:3, :5, 1] == gray).all()
    assert imaging.side_by_side(gray, gray).shape == (3, 12)
    for p in (gray, colour):
        packed = imaging.png(p)
        at = packed.index(b"IDAT")
        raw = zlib.decompress(packed[at + 4 : at + 4 + int.from_bytes(packed[at - 4 : at], "big")])
        assert np.frombuffer(raw, np.uint8).reshape(len(p), -1)[:, 1:].tobytes() == p.tobytes() and image_metadata.keys(packed) == []
    rows = [("a", 5, 3, 1, bytearray(gray.tobytes())), ("bad", -1, -1, -1, bytearray())]
    got = {r.path: r for r in imaging.normalised_masks(spark.createDataFrame(rows, "path string, width int, height int, channels int, data binary")).collect()}
    assert got["a"].n_white == int((gray > 128).sum()) and bytes(got["a"].png) == imaging.png(imaging.normalise_mask(gray)) and got["bad"].png is None


def test_flips_of_train_images(spark):
    image = list(range(12))
    rows = spark.createDataFrame([(k, "train" if k < 200 else "test", image) for k in range(260)], "k long, split string, p array<int>")
    want = np.arange(12).reshape(3, 4)[:, ::-1].ravel().tolist()
    got = [(r.split, list(r.p)) for r in pixels.augmented(rows, "k", "p", 4, 7).collect()]
    turned = [s for s, p in got if p == want]
    assert set(turned) == {"train"} and 70 < len(turned) < 130 and all(p in (image, want) for _, p in got)
    assert pixels.augmented(rows, "k", "p", 4, 7).collect() == pixels.augmented(rows.repartition(5), "k", "p", 4, 7).orderBy("k").collect()


def test_statistics_of_images(spark):
    rows = spark.createDataFrame([(1, [1, 2, 4]), (2, []), (3, None)], "k int, p array<int>")
    got = {r.k: tuple(r)[1:] for r in pixels.statistics(rows, "k", "p").collect()}
    assert got == {1: (1.0, 4.0, 2.33, 1.25), 2: (None,) * 4, 3: (None,) * 4}


def test_order_of_groups_left_out(spark):
    rng = np.random.default_rng(4)
    rows = [(f"g{k % 5}", int(rng.integers(0, 2)), float(rng.random())) for k in range(60)]
    out = evaluation.leave_one_group_out(spark.createDataFrame(rows, "g string, label int, score double"), "g").collect()
    sizes = [abs(r.delta) for r in out]
    assert sizes == sorted(sizes, reverse=True) and len(out) == 5
    lone = evaluation.leave_one_group_out(spark.createDataFrame([("a", 1, 0.5), ("a", 0, 0.1), ("b", 0, 0.7)], "g string, label int, score double"), "g").collect()
    assert [r.g for r in lone] == ["b", "a"] and lone[-1].delta is None


def test_indexes_of_arms(spark, tmp_path):
    index = spark.createDataFrame([(g, s, k) for k, (g, s) in enumerate([("a", "train"), ("b", "train"), ("c", "test"), ("a", "train")])], "`group` string, split string, k int")
    labelled = spark.createDataFrame([(0, "seed", 0, "a"), (0, "random", 1, "a"), (0, "random", 1, "b")], "seed int, arm string, round int, `group` string")
    experiments.write_arms(index, labelled, f"{tmp_path}/arms")
    got = spark.read.parquet(f"{tmp_path}/arms")
    ks = lambda arm: sorted(r.k for r in got.filter(F.col("arm") == arm).collect())
    assert ks("seed") == [0, 2, 3] and ks("random") == [0, 1, 2, 3]


def test_a_run_is_kept(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(k, (rng.normal(size=2) + k % 2).tolist(), k % 2) for k in range(80)], "k int, v array<double>, label int")
    model = training.train(rows, "v")
    scored = training.predict(model, rows, "v", ["k", "label"])
    record = training.run_record("v1", scored, scored, {"a": 1})
    training.save(model, scored, record, f"{tmp_path}/run")
    again = training.predict(training.load(f"{tmp_path}/run"), rows, "v", ["k", "label"])
    assert sorted(again.collect()) == sorted(scored.collect())
    assert readers.run(spark, f"{tmp_path}/run").select("threshold").first()[0] == record["selected_threshold"]
    with pytest.raises(Exception):
        training.save(model, scored, record, f"{tmp_path}/run")


def test_the_map_of_pseudonyms(spark, tmp_path):
    root = f"{tmp_path}/map"
    assert pseudonyms.read(spark, root).count() == 0
    pseudonyms.update(spark.createDataFrame([("49",), ("50",), (None,), ("49",)], "id string"), root, "id", "salt")
    pseudonyms.update(spark.createDataFrame([("50",), ("51",)], "id string"), root, "id", "salt")
    got = {r.identifier: r.pseudonym for r in pseudonyms.read(spark, root).collect()}
    assert set(got) == {"49", "50", "51"} and all(p.startswith("PAT-") and len(p) == 16 for p in got.values())


def test_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Many near pairs go to as many tasks as they need, with the same result."""
    from quern.operators import similarity

    rows = spark.createDataFrame([(k, k % 3, [float((k * j) % 7) for j in range(64)]) for k in range(60)], "k long, g int, v array<double>")
    rows = rows.withColumn("bits", similarity.difference_bits(F.col("v")))
    found = lambda: similarity.confirm(similarity.near_pairs(rows, "k", "g", "bits", 16), rows, "k", "v", 0.3)
    want = sorted(map(tuple, found().collect()))
    monkeypatch.setattr(similarity, "BLOCK", 8)
    monkeypatch.setattr(similarity, "BLOCK_PAIRS", 4)
    monkeypatch.setattr(similarity, "PAIRS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = found()
        assert "hashpartitioning(b#" in (plan := got._jdf.queryExecution().executedPlan().toString()) and f", {-(-similarity_pairs(similarity, rows) // 10)}), REPARTITION_BY_NUM" in plan
        assert sorted(map(tuple, got.collect())) == want and len(want) > 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def similarity_pairs(similarity, rows):
    return similarity.near_pairs(rows, "k", "g", "bits", 16).count()
