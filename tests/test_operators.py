"""Edge cases of the operators on small tables, with expected values worked out by hand or by brute force."""

import hashlib
import hmac
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import keys
from quern.functions.ordered import running_totals
from quern.operators import active, audit, curation, evaluation, labels, manifest, metrics, privacy, quality_gates as qc, release, similarity


def frame(spark, rows, schema="group_id string, item_no long, label int, score double"):
    return spark.createDataFrame(rows, schema)


def scored(spark, labels_, scores):
    return frame(spark, [("g", i, y, float(s)) for i, (y, s) in enumerate(zip(labels_, scores))])


# keys -------------------------------------------------------------------------------------------


def test_stable_hash_pins(spark):
    got = spark.createDataFrame([("True",), ("False",), ("hemorrhage",)], "t string").select("t", keys.stable_hash32(F.col("t")).alias("h")).collect()
    assert {r.t: r.h for r in got} == {"True": 1018988487, "False": 1621311084, "hemorrhage": 3935587066}


def test_hmac_matches_python(spark):
    for key, message in (("test-salt", "049"), ("k" * 100, "é"), ("", "")):
        got = spark.createDataFrame([(message,)], "m string").select(keys.hmac_sha256(F.col("m"), key)).first()[0]
        assert got == hmac.new(key.encode(), message.encode(), hashlib.sha256).hexdigest()
    assert spark.range(1).select(keys.pseudonym(F.lit("049"), "test-salt")).first()[0] == "PAT-436c1f720f33"


def test_pad_and_segments(spark):
    row = spark.range(1).select(keys.pad_id(F.lit(49)), keys.pad_id(F.lit(12345)), keys.replace_segment(F.lit("a/049/x049/049.png"), F.lit("049"), F.lit("P"))).first()
    assert tuple(row) == ("049", "12345", "a/P/x049/049.png")


def test_running_totals_match_a_loop(spark):
    random.seed(1)
    values = [(i, random.randint(0, 9)) for i in range(300)]
    got = {r.k: r.v_before for r in running_totals(spark.createDataFrame(random.sample(values, 300), "k int, v long"), ["k"], ["v"]).collect()}
    total = 0
    for k, v in values:
        assert got[k] == total
        total += v


# inventory --------------------------------------------------------------------------------------


def test_classify(spark):
    paths = ["root/049/brain/1.png", "root/049/brain/1_seg.png", "root/049/other/1.png", "root/049/1.png", "README.md", "elsewhere/049/bone/2.png", "root/050/bone/x.png"]
    cols = manifest.classify(F.col("p"), "root", ["brain", "bone"], "_seg")
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(*[c.alias(n) for n, c in cols.items()]).collect()
    assert [tuple(r) for r in got] == [("item", "049", "brain", 1), ("attachment", "049", "brain", 1), *[("metadata", None, None, None)] * 4, ("item", "050", "bone", None)]


def test_merge_scan_is_idempotent(spark):
    schema = "rel_path string, sha256 string, size_bytes long"
    seen = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), ("c", "3", 3)], schema)
    empty = spark.createDataFrame([], schema)
    count = lambda df: {r.action: r["count"] for r in df.groupBy("action").count().collect()}
    first = manifest.merge_scan(empty, seen)
    assert count(first) == {"new": 3}
    assert count(manifest.merge_scan(first, seen)) == {"unchanged": 3}
    assert count(manifest.merge_scan(first, spark.createDataFrame([("a", "1", 1), ("b", "9", 2)], schema))) == {"unchanged": 1, "updated": 1, "missing": 1}


def test_reconcile(spark):
    schema = "rel_path string, sha256 string"
    got = manifest.reconcile(spark.createDataFrame([("ok", "1"), ("bad", "2"), ("gone", "3")], schema), spark.createDataFrame([("ok", "1"), ("bad", "x"), ("stray", "4")], schema))
    assert {r.rel_path: r.status for r in got.collect()} == {"ok": "verified", "bad": "mismatched", "gone": "missing", "stray": "extra"}


def test_curation_reasons_in_order(spark):
    rows = spark.createDataFrame([("1", "x", True, False), ("6", "x", False, False), ("4", "y", True, True)], "name string, sha string, labelled boolean, blank boolean")
    rows = curation.with_first_copy(rows, "sha", "name")
    rejecting = curation.reasons((F.col("first_copy") != F.col("name"), F.concat(F.lit("duplicate-of:"), "first_copy")), (F.col("blank"), "blank-or-constant"), (~F.col("labelled"), "no-label-row"))
    got = {r["name"]: (r["decision"], r["reasons"]) for r in curation.decide(rows, rejecting, F.array().cast("array<string>")).collect()}
    assert got == {"1": ("accepted", []), "6": ("rejected", ["duplicate-of:1", "no-label-row"]), "4": ("rejected", ["blank-or-constant"])}


def test_curation_skip_and_force(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, sha256 string")
    old = spark.createDataFrame([("a", "1"), ("b", "x")], "k string, sha256 string")
    action = lambda **k: {r.k: r.action for r in curation.to_process(now, old, "k", **k).collect()}
    assert action() == {"a": "skipped", "b": "processed", "c": "processed"}
    assert set(action(force=True).values()) == {"processed"}


# privacy ----------------------------------------------------------------------------------------


def test_text_scan(spark):
    notes = ["mail a.b@c.org now", "seen by Dr. Smith", "on 2020-01-02", "after about two weeks", None]
    got = privacy.scan_text(spark.createDataFrame(list(enumerate(notes)), "k int, note string"), "k", ["note"]).collect()
    assert {(r.k, r.issue, r.match) for r in got} == {(0, "possible-email", "a.b@c.org"), (1, "possible-person_title", "Dr. Smith"), (2, "possible-date", "2020-01-02"), (2, "possible-phone", "2020-01-02")}


def test_name_scan_and_ages(spark):
    names = spark.createDataFrame([("PatientName",), ("MRN",), ("DOB",), ("SliceNumber",)], "column string")
    assert {r.column for r in privacy.scan_names(names).collect()} == {"PatientName", "MRN", "DOB"}
    ages = spark.createDataFrame([(1, "35"), (2, "72"), (3, "91"), (4, "old"), (5, "89")], "k int, age string")
    assert [(r.k, r.value) for r in privacy.over_age(ages, "k", "age").collect()] == [(3, 91.0)]


def test_leaks_are_row_aligned(spark):
    rows = spark.createDataFrame([("049", 35, "49.0", "049"), ("050", 49, "50.0", "051"), ("130", 60, "130.0", "130")], "id string, age int, legacy string, half string")
    got = {r.column: (r.aligned_rows, r.leaks) for r in privacy.leak_fractions(rows, "id", ["age", "legacy", "half"]).collect()}
    assert got == {"age": (0, False), "legacy": (3, True), "half": (2, True)}
    assert privacy.malformed(spark.createDataFrame([("PAT-436c1f720f33",), ("049",), (None,)], "patient string")).count() == 2


def test_pseudonymize_unknown(spark):
    mapping = privacy.pseudonym_map(spark.createDataFrame([("1",), (None,), ("1",)], "id string"), "id", "s")
    assert mapping.count() == 1
    out = privacy.pseudonymize(spark.createDataFrame([("1", 5), ("2", 6)], "id string, v int"), mapping, "id")
    assert out.columns == ["patient", "v"] and {r.v: r.patient[:5] for r in out.collect()} == {5: "PAT-" + mapping.first().pseudonym[4], 6: "PAT-U"}


def test_salt_file(tmp_path, monkeypatch):
    path = str(tmp_path / "salt")
    first = privacy.load_or_create_salt(path)
    assert privacy.load_or_create_salt(path) == first and len(first) == 64 and (tmp_path / "salt").stat().st_mode & 0o777 == 0o600
    monkeypatch.setenv("QUERN_SALT", "x")
    assert privacy.load_or_create_salt(path) == "x"


# labels -----------------------------------------------------------------------------------------

TAXONOMY = [("a", "A", "main", "", "colA"), ("b", "B", "other", "", "colB"), ("c", "C", "other", "", "colC")]


def test_label_store(spark):
    tax = spark.createDataFrame(TAXONOMY, labels.TAXONOMY_SCHEMA)
    wide = spark.createDataFrame([(1, 0, 0), (2, 1, 1)], "k int, colA int, colB int")
    long = labels.unpivot_labels(wide, tax, ["k"], "x", "f.csv")
    assert long.count() == 4 and labels.invalid_values(long).isEmpty()
    assert sorted(map(tuple, labels.unpivot_labels(wide, tax, ["k"], "x", "f.csv").collect())) == sorted(map(tuple, long.collect()))
    found = {r.k: (r.labels, r.positive, r.none_of_main) for r in labels.lookup(long, tax, ["k"], "main").collect()}
    assert found == {1: ({"a": 0, "b": 0}, [], True), 2: ({"a": 1, "b": 1}, ["a", "b"], False)}
    assert {r.code: (r.positives, r.total) for r in labels.distribution(long, tax).collect()} == {"a": (1, 2), "b": (1, 2), "c": (0, 0)}
    other = labels.unpivot_labels(wide, tax, ["k"], "y", "f.csv")
    assert labels.lookup(long.union(other), tax, ["k"], "main").count() == 4
    fixed = labels.unpivot_labels(spark.createDataFrame([(1, 1, 0)], "k int, colA int, colB int"), tax, ["k"], "x", "f.csv")
    merged = labels.upsert(long, fixed, ["annotation_id", "label_code"])
    assert merged.count() == 4 and merged.filter("k = 1 and label_code = 'a'").first().value == 1


# gates ------------------------------------------------------------------------------------------


def issues(df):
    return sorted((r.issue, r.key) for r in df.collect())


def test_gates_fire(spark):
    k = lambda *v: spark.createDataFrame([(x,) for x in v], "k int")
    assert issues(qc.orphans(k(1, 2), k(1, 99), k(77, 1), "k")) == [("image-without-label", "2"), ("label-without-image", "99"), ("mask-without-slice", "77")]
    assert issues(qc.agreement(k(1), k(2), "k")) == [("hemorrhage-label-but-no-mask", "2"), ("mask-but-no-hemorrhage-label", "1")]
    assert issues(qc.coverage(k(1, 2), k(2, 3), "k")) == [("demographics-without-images", "3"), ("images-without-demographics", "1")]
    ages = spark.createDataFrame([(1, 300.0), (2, 0.0027), (3, None), (4, float("nan")), (5, 50.0), (6, -1.0)], "k int, age double")
    assert issues(qc.plausibility(ages, "k", "age")) == [("implausible-age", "1"), ("implausible-age", "3"), ("implausible-age", "4"), ("implausible-age", "6"), ("paediatric-age-under-1-year", "2")]
    assert issues(qc.unexpected_values(spark.createDataFrame([("Male",), ("X",), (None,), ("X",)], "s string"), "s", ["Male", "Female"])) == [("unexpected-gender-value", "X")]


def test_gate_report_and_summaries(spark):
    items = spark.createDataFrame([("p", 0), ("p", 1), ("q", 0)], "g string, t int")
    summary = spark.createDataFrame([("p", 0.0), ("q", float("nan")), ("r", 1.0)], "g string, t double")
    assert [tuple(r) for r in qc.summary_disagreements(items, summary, "g", ["t"]).collect()] == [("p", "t", 1, 0)]
    warn = qc.finding(items.limit(1), "slice-counts", qc.WARNING, "w", F.col("g"))
    assert qc.passes(warn)
    bad = warn.union(qc.finding(items.limit(1), "orphans", qc.ERROR, "e", F.col("g")))
    assert not qc.passes(bad)
    assert {r.check: r.result for r in qc.report(bad, ["slice-counts", "orphans", "leakage"]).collect()} == {"slice-counts": "WARN", "orphans": "FAIL", "leakage": "PASS"}


# similarity -------------------------------------------------------------------------------------


@pytest.mark.parametrize("radius", [2, 20])
def test_near_pairs_match_brute_force(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(62) for _ in range(12)]
    values = base + [b ^ sum(1 << rng.randrange(62) for _ in range(rng.randint(0, 3))) for b in base for _ in range(4)]
    rows = [(i, i % 3, v) for i, v in enumerate(values)]
    want = {(i, j, (x ^ y).bit_count()) for (i, g, x), (j, h, y) in itertools.combinations(rows, 2) if g != h and (x ^ y).bit_count() <= radius}
    got = similarity.near_pairs(spark.createDataFrame(rows, "k long, g int, x long"), "k", "g", "x", radius)
    assert {tuple(r) for r in got.collect()} == want and want


def test_near_pairs_meet_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 7)
    rows = [(i, i % 2, i) for i in range(40)]
    got = similarity.near_pairs(spark.createDataFrame(rows, "k long, g int, x long"), "k", "g", "x", 1, n_bits=8)
    want = {(i, j, 1) for i in range(40) for j in range(i + 1, 40) if (i ^ j).bit_count() <= 1 and i % 2 != j % 2}
    assert {tuple(r) for r in got.collect()} == want


def test_bits_and_correlation(spark):
    v, w = [1.0, 2.0, 2.0, 5.0, 4.0], [2.0, 1.0, 4.0, 4.0, 3.0]
    row = spark.createDataFrame([(v, w)], "v array<float>, w array<float>").select(similarity.difference_bits(F.col("v")).alias("b"), similarity.correlation(similarity.standardized(F.col("v")), similarity.standardized(F.col("w"))).alias("c")).first()
    assert row.b == 0b0101 and abs(row.c - np.corrcoef(v, w)[0, 1]) < 1e-6


# releases ---------------------------------------------------------------------------------------


def groups(spark, n=60):
    return spark.createDataFrame([(f"g{i:03d}", int(i % 4 == 0)) for i in range(n)], "g string, s int")


def test_split_properties(spark):
    got = {r.g: r.split for r in release.stratified_split(groups(spark), "g", "s", 1).collect()}
    assert len(got) == 60 and release.overlaps(release.stratified_split(groups(spark), "g", "s", 1), "g").isEmpty()
    assert {r.g: r.split for r in release.stratified_split(groups(spark).orderBy(F.desc("g")), "g", "s", 1).collect()} == got
    assert {r.g: r.split for r in release.stratified_split(groups(spark), "g", "s", 2).collect()} != got
    for s, n in ((0, 45), (1, 15)):
        sizes = [sum(v == name and (int(k[1:]) % 4 == 0) == s for k, v in got.items()) for name in release.SPLITS]
        assert sizes == [round(n * 0.7), round(n * 0.85) - round(n * 0.7), n - round(n * 0.85)]
    assert [r.split for r in release.stratified_split(groups(spark, 1), "g", "s", 1).collect()] == ["train"]


def test_release_files(spark, tmp_path):
    rows = spark.createDataFrame([("p", "train", "a", "1"), ("q", "test", "b", "2")], "patient string, split string, path string, sha256 string")
    path = str(tmp_path / "v1")
    release.write_release(rows, rows.select("patient", "split"), path)
    with pytest.raises(Exception):
        release.write_release(rows, rows.select("patient", "split"), path)
    now = spark.createDataFrame([("a", "x")], "path string, sha256 string")
    assert {(r.path, r.issue) for r in release.verify(spark.read.parquet(path + "/index"), now).collect()} == {("a", "content-changed"), ("b", "missing")}
    ids = spark.createDataFrame([("049",), ("07",)], "id string")
    text = spark.createDataFrame([("x 049 y",), ("1049",), (None,)], "t string")
    assert [tuple(r) for r in release.leaked_ids(text, ["t"], ids, "id").collect()] == [("t", "049", 1)]


# metrics ----------------------------------------------------------------------------------------


def drawn(seed, n=30, levels=7, share=0.4):
    """Labels and scores with many ties."""
    rng = random.Random(seed)
    return [int(rng.random() < share) for _ in range(n)], [rng.randrange(levels) / (levels - 1) for _ in range(n)]


def won(y, s):
    """The share of (positive, negative) pairs that the positive wins, ties half; 0.5 without a pair."""
    pairs = [(p > q) + (p == q) / 2 for a, p in zip(y, s) for b, q in zip(y, s) if a > b]
    return sum(pairs) / len(pairs) if pairs else 0.5


@pytest.mark.parametrize("seed, share", [(1, 0.4), (2, 0.1), (3, 0.0), (4, 1.0)])
def test_auroc(spark, seed, share):
    y, s = drawn(seed, share=share)
    assert abs(metrics.auroc(scored(spark, y, s)).first().auroc - won(y, s)) < 1e-12
    assert metrics.auroc(scored(spark, y, [4 * v - 9 for v in s])).first() == metrics.auroc(scored(spark, y, s)).first()


def test_auroc_of_nothing(spark):
    assert metrics.auroc(scored(spark, [], [])).first().auroc == 0.5


@pytest.mark.parametrize("seed, at", [(5, 0.5), (6, 1 / 3), (7, 2.0)])
def test_confusion(spark, seed, at):
    y, s = drawn(seed)
    r = metrics.with_rates(metrics.confusion(scored(spark, y, s), at)).first()
    said = [v >= at for v in s]
    want = {k: sum(a == l and b == c for a, b in zip(y, said)) for k, l, c in (("tp", 1, True), ("fp", 0, True), ("tn", 0, False), ("fn", 1, False))}
    assert {k: r[k] for k in want} == want and r.n == len(y)
    rate = lambda top, *rest: top / (top + sum(rest)) if top + sum(rest) else 0.0
    assert abs(r.recall - rate(want["tp"], want["fn"])) < 1e-12 and abs(r.precision - rate(want["tp"], want["fp"])) < 1e-12
    assert abs(r.balanced_accuracy - (rate(want["tp"], want["fn"]) + rate(want["tn"], want["fp"])) / 2) < 1e-12


def test_the_majority_guess(spark):
    y, s = drawn(8, share=0.2)
    flat = metrics.trivial_baseline(scored(spark, y, s)).first()
    assert (flat.accuracy, flat.f1, flat.auroc) == (y.count(0) / len(y), 0.0, 0.5)


@pytest.mark.parametrize("seed, share", [(9, 0.3), (10, 0.7), (11, 0.0), (12, 1.0)])
def test_best_threshold_is_the_lowest(spark, seed, share):
    y, s = drawn(seed, 12, 5, share)

    def f1(t):
        both = sum(v >= t for v in s) + sum(y)
        return 2 * sum(a for a, v in zip(y, s) if v >= t) / both if both else 0.0

    want = max({0.0, 1.0, *s}, key=lambda t: (f1(t), -t))
    assert tuple(metrics.best_threshold(scored(spark, y, s)).first()) == (want, f1(want))


def test_bootstrap(spark):
    rng = np.random.default_rng(0)
    rows = []
    for g in range(12):
        shift, y = rng.normal(), g % 3 == 0
        rows += [(f"g{g}", i, int(y), float(shift + rng.normal() * 0.1)) for i in range(10)]
    df = frame(spark, rows)
    by_group = metrics.interval(metrics.bootstrap_auroc(df, "group_id", 60, 1), "auroc").first()
    by_item = metrics.interval(metrics.bootstrap_auroc(df.withColumn("item", F.concat_ws("-", "group_id", "item_no")), "item", 60, 1), "auroc").first()
    assert by_group.ci_high - by_group.ci_low > 2 * (by_item.ci_high - by_item.ci_low)
    none = metrics.interval(metrics.bootstrap_auroc(scored(spark, [1, 1], [0.1, 0.2]), "group_id", 5, 1), "auroc").first()
    assert tuple(none) == (0, 0.0, 1.0, True)


# evaluation -------------------------------------------------------------------------------------


def test_subtypes(spark):
    rows = spark.createDataFrame([(0.9, 1, 0), (0.8, 1, 0), (0.1, 1, 1), (0.2, 1, 0)], "score double, a int, b int").withColumn("c", F.lit(0))
    got = {r.subtype: (r.support, r.detected, r.recall, r.measurable) for r in evaluation.subtype_recall(rows, ["a", "b", "c"], 0.5).collect()}
    assert got == {"a": (4, 2, 0.5, True), "b": (1, 0, 0.0, False), "c": (0, 0, None, False)}


def test_groups(spark):
    rng = random.Random(13)
    rows = [(f"g{rng.randrange(5)}", i, rng.randrange(2), rng.random()) for i in range(60)] + [("calm", 99, 0, 0.4)]
    of = lambda g: [r for r in rows if r[0] == g]
    for r in evaluation.group_contributions(frame(spark, rows), 0.5, "group_id").collect():
        sick = [x for x in of(r.group_id) if x[2]]
        assert (r.n_items, r.n_positive) == (len(of(r.group_id)), len(sick))
        assert r.detection_rate == (sum(x[3] >= 0.5 for x in sick) / len(sick) if sick else None)
        assert abs(r.share_of_positives - len(sick) / sum(x[2] for x in rows)) < 1e-12
    for r in evaluation.aggregate_groups(frame(spark, rows), "group_id", "topk").collect():
        best = sorted((x[3] for x in of(r.group_id)), reverse=True)[:3]
        assert abs(r.score - sum(best) / len(best)) < 1e-12
    with pytest.raises(ValueError):
        evaluation.aggregate_groups(frame(spark, rows), "group_id", "median")
    g = evaluation.granularity(frame(spark, [(f"p{i}", 0, 1, 0.5) for i in range(3)] + [(f"n{i}", 0, 0, 0.5) for i in range(4)])).first()
    assert g.comparable_pairs == 12 and abs(g.auroc_granularity - 1 / 12) < 1e-12


def test_leave_one_out_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"g{rng.randrange(6)}", i, rng.randrange(2), rng.randrange(8) / 8) for i in range(80)] + [("only", 99, 1, 0.3)]

    def auc(part):
        pos, neg = [s for *_, y, s in part if y], [s for *_, y, s in part if not y]
        return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg)) if pos and neg else None

    for r in evaluation.leave_one_group_out(frame(spark, rows), "group_id").collect():
        want = auc([x for x in rows if x[0] != r.group_id])
        assert abs(r.auroc_without - want) < 1e-12 and abs(r.delta - (want - auc(rows))) < 1e-12
    lone = evaluation.leave_one_group_out(frame(spark, [("a", 0, 1, 0.9), ("b", 1, 0, 0.1)]), "group_id").collect()
    assert all(r.auroc_without is None for r in lone)


def test_sweep(spark):
    rows = scored(spark, [0, 1, 1, 0, 1], [0.1, 0.6, 0.6000000000000001, 1.0, -0.2])
    got = evaluation.threshold_sweep(rows).orderBy("threshold").collect()
    assert len(got) == 41 and all(a.recall >= b.recall for a, b in zip(got, got[1:]))
    for i, r in enumerate(got):
        t = i * 0.025
        assert r.tp == sum(s >= t for y, s in zip([0, 1, 1, 0, 1], [0.1, 0.6, 0.6000000000000001, 1.0, -0.2]) if y)
    y, s = drawn(14)
    sure = scored(spark, y, [(v + 2 * a) / 3 for a, v in zip(y, s)])  # every positive above every negative but for ties
    assert evaluation.operating_point(sure).first().fn == 0
    assert evaluation.operating_point(scored(spark, [1, 1], [-1, -1])).isEmpty()


def test_checked_join(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    assert evaluation.checked_left_join(left, right, ["k"]).count() == 2
    with pytest.raises(ValueError):
        evaluation.checked_left_join(left, right.union(right), ["k"])


def test_hardest(spark):
    rows = frame(spark, [("P1", 10, 1, 0.1), ("P1", 11, 1, 0.2), ("P1", 9, 1, 0.9), ("P2", 12, 0, 0.95), ("P2", 13, 0, 0.7)])
    got = [(r.kind, r.place, r.group_id, r.item_no) for r in evaluation.hardest_cases(rows, 0.5, 2, "group_id", "item_no").collect()]
    assert got == [("false_negative", 1, "P1", 10), ("false_negative", 2, "P1", 11), ("false_positive", 1, "P2", 12), ("false_positive", 2, "P2", 13)]


# active learning --------------------------------------------------------------------------------


def test_uncertainty_rules(spark):
    rows = spark.createDataFrame([("A", 0.5), ("A", 0.4), ("B", 0.5), ("B", 0.01), ("C", 0.0), ("C", 1.0)], "g string, p double")
    rank = lambda rule: [r.g for r in active.group_uncertainty(rows, "g", "p", rule).orderBy(F.desc("uncertainty"), "g").collect()]
    assert rank("mean") == ["A", "B", "C"] and rank("max") == ["A", "B", "C"]
    with pytest.raises(ValueError):
        rank("median")


def test_pools_and_selection(spark):
    flags = spark.createDataFrame([(f"g{i:02d}", i < 10) for i in range(30)], "g string, flag boolean")
    pool = active.stratified_pool(flags, "g", "flag", 0.5, 7)
    assert {(r.flag, r.pool): r["count"] for r in pool.groupBy("flag", "pool").count().collect()} == {(True, "labelled"): 5, (True, "unlabelled"): 5, (False, "labelled"): 10, (False, "unlabelled"): 10}
    ranking = flags.select("g", F.substring("g", 2, 2).cast("double").alias("uncertainty"))
    rest = pool.filter("pool = 'unlabelled'")
    best = sorted((r.g for r in rest.collect()), reverse=True)
    assert {r.g for r in active.select_uncertain(ranking, rest, "g", 3).collect()} == set(best[:3])
    assert active.select_random(rest, "g", 100, 1).count() == 15


def test_paired(spark):
    rng = random.Random(15)
    both = [(rng.randrange(20) / 20, rng.randrange(20) / 20) for _ in range(5)]
    rows = [(k, a, m) for k, pair in enumerate(both) for a, m in zip("ur", pair)] + [(9, "u", 0.5)]
    results = spark.createDataFrame(rows, "seed int, arm string, metric double")
    r = active.paired_statistics(active.paired_deltas(results, "seed", "arm", "metric", "u", "r")).first()
    d = np.array([x - y for x, y in both])
    half = active.T_CRITICAL[len(d) - 2] * d.std(ddof=1) / len(d) ** 0.5
    assert (r.n_pairs, r.wins, r.losses, r.ties, r.significant) == (5, (d > 0).sum(), (d < 0).sum(), (d == 0).sum(), abs(d.mean()) > half)
    assert abs(r.mean_delta - d.mean()) < 1e-12 and abs(r.ci_high - d.mean() - half) < 1e-12
    one = active.paired_statistics(spark.createDataFrame([(0.1,)], "delta double")).first()
    assert one.std_delta is None and one.ci_low is None and not one.significant
    summary = {x.arm: x.std for x in active.arm_summary(results.filter("seed = 9"), "arm", "metric").collect()}
    assert summary == {"u": None}


# audit ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("tamper, want", [("none", None), ("edit", (3, "record_hash mismatch")), ("drop", (4, "sequence gap")), ("swap", (2, "prev_hash mismatch"))])
def test_chain_verification(spark, tamper, want):
    log = audit.linked(spark.createDataFrame([(i, f"p{i}") for i in range(1, 7)], "seq long, payload string"), F.col("payload"), "seq")
    if tamper == "edit":
        log = log.withColumn("payload", F.when(F.col("seq") == 3, "x").otherwise(F.col("payload")))
    if tamper == "drop":
        log = log.filter("seq <> 3")
    if tamper == "swap":
        log = log.withColumn("seq", F.when(F.col("seq") == 2, 3).when(F.col("seq") == 3, 2).otherwise(F.col("seq")))
    found = audit.breaks(log, F.col("payload"))
    r = audit.verify(found, log.agg(F.count("*").alias("n_records"))).first()
    assert (None if r.ok else (r.broken_at, r.detail)) == want


def test_directories_and_lineage(spark):
    schema = "rel_path string, size_bytes long, mtime int"
    got = audit.directory_diff(spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 1, 1)], schema), spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("d", 1, 1)], schema))
    assert {r.rel_path: r.change for r in got.collect()} == {"b": "modified", "c": "deleted", "d": "created"}
    runs = spark.createDataFrame([(1, "r1", "datasets/v1.0"), (2, "r2", "datasets/v1.1"), (3, "r3", "datasets/v1.0/index.csv"), (4, "r4", "datasets/v1.01")], "seq int, run_id string, changed string")
    targets = spark.createDataFrame([("datasets/v1.0", 99), ("datasets/v1.1", 2), ("datasets/v1.0/splits.csv", 99)], "target string, before_seq int")
    assert {r.target: r.run_id for r in audit.producers(runs, targets).collect()} == {"datasets/v1.0": "r3", "datasets/v1.0/splits.csv": "r1"}
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "child string, parent string")
    assert {(r.node, r.level) for r in audit.trace(spark.createDataFrame([("a",)], "node string"), edges).collect()} == {("a", 0), ("b", 1), ("c", 2)}
