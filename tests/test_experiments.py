"""The experiment loop, AUROCs by model and resampling, against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions.keys import draw
from quern.operators import active, experiments, metrics


def plain_auroc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    return 0.5 if not len(pos) or not len(neg) else float(np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)))


def newton(x, y, penalty=experiments.PENALTY):
    """Weights by many small steps of the same loss."""
    x = np.column_stack([np.ones(len(x)), x])
    hold = np.diag([1e-6, *[penalty] * (x.shape[1] - 1)])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x / len(x) + hold, x.T @ (p - y) / len(x) + hold @ w)
    return w


def test_models_are_fitted_side_by_side(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    y = (x @ [1, -2, 0.5, 0] + rng.normal(size=300) > 0.3).astype(int)
    member = [[k for k in range(3) if (i + k) % (k + 2) == 0] for i in range(300)]
    rows = spark.createDataFrame([(v.tolist(), int(b), m) for v, b, m in zip(x, y, member)], "vector array<double>, label int, models array<int>").repartition(5)
    got = experiments.fit(rows, 4, 4, steps=30)
    for k in range(3):
        own = np.array([k in m for m in member])
        assert np.allclose(got[k], newton(x[own], y[own]), atol=1e-7)
    assert (got[3] == 0).all()  # a model without rows


def embedded(spark, n=360):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        group = i % 36
        label = int(rng.random() < (0.5 if group % 3 else 0.1))
        rows.append((f"g{group:02}", i, (rng.normal(size=3) + label).tolist(), label, "test" if group % 4 == 0 else "train"))
    return spark.createDataFrame(rows, "`group` string, key long, vector array<double>, label int, split string")


def test_the_loop(spark):
    rows = embedded(spark)
    results, chosen = experiments.run(rows, seeds=(0, 1), fraction=0.3, budget=3, rounds=2)
    got = {(r.seed, r.arm, r["round"]): r for r in results.collect()}
    assert set(got) == {(s, "seed", 0) for s in (0, 1)} | {(s, a, k) for s in (0, 1) for a in ("uncertainty", "random") for k in (1, 2)}
    picks = {}
    for r in chosen.collect():
        picks.setdefault((r.seed, r.arm, r["round"]), set()).add(r.group)
    data = rows.collect()
    train = [r for r in data if r.split == "train"]
    flags = spark.createDataFrame([(g, max(r.label for r in train if r.group == g)) for g in {r.group for r in train}], "`group` string, flag int")
    for s in (0, 1):
        labelled = {r.group for r in active.stratified_pool(flags, "group", "flag", 0.3, s).filter("pool = 'labelled'").collect()}
        model = {"seed": labelled}
        assert got[s, "seed", 0].n_groups == len(labelled)
        for a in ("uncertainty", "random"):
            assert all(len(picks[s, a, k]) == 3 for k in (1, 2)) and not picks[s, a, 1] & picks[s, a, 2] and not (picks[s, a, 1] | picks[s, a, 2]) & labelled
            for k in (1, 2):
                have = labelled | set().union(*(picks[s, a, j] for j in range(1, k + 1)))
                model[a, k] = have
        for name, have in model.items():
            own = [r for r in train if r.group in have]
            w = newton(np.array([r.vector for r in own]), np.array([r.label for r in own]))
            score = lambda rs: 1 / (1 + np.exp(-(np.column_stack([np.ones(len(rs)), [r.vector for r in rs]]) @ w)))  # noqa: B023,E731
            test = [r for r in data if r.split == "test"]
            r = got[(s, "seed", 0) if name == "seed" else (s, *name)]
            assert r.n_rows == len(own) and r.auroc == pytest.approx(plain_auroc([t.label for t in test], score(test)), abs=1e-9)
            if name == "seed" or name == ("uncertainty", 1):  # what the next choice rests on
                p = np.clip(score(train), 1e-12, 1 - 1e-12)
                doubt = -(p * np.log2(p) + (1 - p) * np.log2(1 - p))
                mean = {g: np.mean([d for d, t in zip(doubt, train) if t.group == g]) for g in {t.group for t in train} - have}
                assert picks[s, "uncertainty", 1 if name == "seed" else 2] == set(sorted(mean, key=lambda g: (-mean[g], g))[:3])


def test_loops_with_little_in_them(spark):
    rows = embedded(spark, 40).withColumn("vector", F.when(F.col("key") % 7 == 0, None).otherwise(F.col("vector")))
    results, chosen = experiments.run(rows, seeds=(0,), budget=100, rounds=2)
    last = {(r.arm, r["round"]): r.n_groups for r in results.collect()}
    assert last["random", 1] == last["random", 2] == last["uncertainty", 2]  # all that are left, once
    none, no = experiments.run(rows, seeds=(0,), rounds=0)
    assert none.count() == 1 and no.count() == 0


def test_aurocs_by_model(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), int(rng.integers(0, 2)), float(rng.integers(0, 6)) / 5) for k in rng.integers(0, 5, 400)] + [(9, 1, 0.5)]
    got = {r.m: r.auroc for r in metrics.auroc_by(spark.createDataFrame(rows, "m int, label int, score double").repartition(6), "m").collect()}
    assert got == {m: pytest.approx(plain_auroc([y for k, y, _ in rows if k == m], [p for k, _, p in rows if k == m])) for m in {*range(5), 9}}


def test_resampled_groups(spark):
    """Weights by vectors give what drawing whole groups again gives."""
    rng = np.random.default_rng(2)
    rows = [(f"g{k}", int(rng.integers(0, 2)), float(rng.integers(0, 9)) / 8) for k in rng.integers(0, 7, 150)]
    df = spark.createDataFrame(rows, "g string, label int, score double").repartition(5)
    got = {r.resample: r.auroc for r in metrics.bootstrap_auroc(df, "g", 25, 11).collect()}
    names = sorted({g for g, _, _ in rows})
    drawn = spark.range(25 * len(names)).select(F.floor(F.col("id") / len(names)).alias("r"), (F.col("id") % len(names)).alias("p")).withColumn("k", draw(len(names), 11, F.col("r"), F.col("p"))).collect()
    for r in range(25):
        again = [x for d in drawn if d.r == r for x in rows if x[0] == names[d.k]]
        assert got[r] == pytest.approx(plain_auroc([y for _, y, _ in again], [p for _, _, p in again]))
    one_class = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.1)], "g string, label int, score double")
    assert metrics.bootstrap_auroc(one_class, "g", 5, 1).count() == 0
