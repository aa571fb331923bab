"""The experiment loop of active learning: several seeds, arms and rounds, all models fitted together.

Every (seed, arm) is a model of its own: a logistic regression on the train rows of the groups that
the arm has labelled. All models of a round are fitted side by side by Newton steps: a pass over the
rows adds each model's gradient and curvature (whose size follows from the vector's length alone), so
no task gets a model's rows together, and the driver gets sums. The scores of a round's models then
choose the groups that each arm labels next.

Rows have ``group``, ``key``, ``vector``, ``label`` (0 or 1) and ``split``. Rows with a null vector, label
or group are left out; null entries count as 0. An arm whose rows have one class alone, or none, is
fitted all the same: the penalty keeps its weights finite, and its ranking is what it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quern.functions.keys import shuffle_key
from quern.functions.storage import discard, materialize
from quern.operators.active import entropy, stratified_pool
from quern.operators.metrics import auroc_by

ARMS = ("seed", "uncertainty", "random")
STEPS, PENALTY = 8, 1e-2


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors with a leading 1, null entries as 0."""
    flat = np.nan_to_num(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    return np.column_stack([np.ones(len(column)), flat.reshape(len(column), width)])


def _sums(rows: DataFrame, weights: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, gradients and curvatures of all models at ``weights`` (a row for each), from one pass over
    rows (``vector``, ``label``, ``models``: the numbers of the models that learn from the row)."""
    many, size = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((many, 1 + size + size * size))
        for batch in batches:
            x, y = _matrix(batch.column(0), width), batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            belongs = np.zeros((many, len(x)), dtype=bool)
            ids = batch.column(2)
            owner = np.repeat(np.arange(len(x)), np.diff(ids.offsets.to_numpy()))
            belongs[ids.flatten().to_numpy(zero_copy_only=False), owner] = True
            for k in np.flatnonzero(belongs.any(axis=1)):
                own, truth = x[belongs[k]], y[belongs[k]]
                p = 1 / (1 + np.exp(-np.clip(own @ weights[k], -500, 500)))
                total[k, 0] += len(own)
                total[k, 1 : 1 + size] += own.T @ (p - truth)
                total[k, 1 + size :] += ((own * (p * (1 - p))[:, None]).T @ own).ravel()
        for k in np.flatnonzero(total[:, 0]):
            yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), pa.array([total[k].tolist()], pa.list_(pa.float64()))], names=["model", "sums"])

    parts = rows.select("vector", "label", "models").mapInArrow(run, "model int, sums array<double>")
    summed = parts.select("model", F.posexplode("sums").alias("at", "v")).groupBy("model", "at").agg(F.sum("v").alias("v"))
    whole = np.zeros((many, 1 + size + size * size))
    for r in summed.collect():
        whole[r["model"], r["at"]] = r["v"]
    return whole[:, 0], whole[:, 1 : 1 + size], whole[:, 1 + size :].reshape(many, size, size)


def fit(rows: DataFrame, many: int, width: int, steps: int = STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Weights (constant first) of ``many`` logistic regressions, by Newton steps with a penalty on the mean
    loss that leaves the constant almost free."""
    weights = np.zeros((many, width + 1))
    hold = np.diag([1e-6, *[penalty] * width])
    for _ in range(steps):
        counts, gradients, curvatures = _sums(rows, weights, width)
        move = np.zeros_like(weights)
        for k in np.flatnonzero(counts):
            move[k] = np.linalg.solve(curvatures[k] / counts[k] + hold, gradients[k] / counts[k] + hold @ weights[k])
        weights = weights - move
        if np.abs(move).max(initial=0.0) < 1e-10:
            break
    return weights


def scored(rows: DataFrame, weights: np.ndarray, width: int) -> DataFrame:
    """``rows`` (``group``, ``key``, ``label``) with ``scores``: each model's probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = 1 / (1 + np.exp(-np.clip(_matrix(batch.column(3), width) @ weights.T, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(p.tolist(), pa.list_(pa.float64()))], names=["group", "key", "label", "scores"])

    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.select("group", "key", "label", "vector").mapInArrow(run, f"`group` {fields['group']}, `key` {fields['key']}, label int, scores array<double>")


def _chosen(pool: DataFrame, scores: DataFrame, budget: int, round_: int) -> DataFrame:
    """(``seed``, ``arm``, ``group``) that the two choosing arms label next: of ``pool`` (seed, arm, group) the
    groups of the largest mean entropy under the arm's own model, or those first in a keyed shuffle."""
    ranked = pool.join(scores, ["seed", "arm", "group"], "left")
    by_doubt = Window.partitionBy("seed", "arm").orderBy(F.desc(F.coalesce("doubt", F.lit(0.0))), "group")
    by_draw = Window.partitionBy("seed", "arm").orderBy(shuffle_key(round_, F.col("seed"), F.col("group")), "group")
    doubted = ranked.filter("arm = 'uncertainty'").withColumn("place", F.row_number().over(by_doubt)).filter(F.col("place") <= budget)
    drawn = ranked.filter("arm = 'random'").withColumn("place", F.row_number().over(by_draw)).filter(F.col("place") <= budget)
    return doubted.union(drawn).select("seed", "arm", "group")


def run(rows: DataFrame, seeds: tuple[int, ...] = (0, 1, 2), fraction: float = 0.4, budget: int = 12, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """The loop. Gives (``seed``, ``arm``, ``round``, ``n_groups``, ``n_rows``, ``auroc``), measured on the test
    rows, which no choice looks at, and (``seed``, ``arm``, ``round``, ``group``), what each arm chose.

    Round 0 fits the labelled pool alone (arm seed); each later round adds ``budget`` groups to either
    of the other arms, or all that are left.
    """
    spark = rows.sparkSession
    fine = materialize(rows.filter("vector is not null and label is not null and `group` is not null").select("group", "key", "vector", F.col("label").cast("int").alias("label"), "split"), "experiment-rows")
    width = (fine.agg(F.max(F.size("vector")).alias("w")).first()["w"]) or 0
    train = fine.filter("split = 'train'")
    flags = materialize(train.groupBy("group").agg(F.max("label").alias("flag")), "experiment-groups")
    pools = materialize(reduce(DataFrame.union, [stratified_pool(flags, "group", "flag", fraction, s).select(F.lit(s).alias("seed"), "group", "pool") for s in seeds]), "experiment-pools")
    labelled, rest = pools.filter("pool = 'labelled'").select("seed", "group"), pools.filter("pool = 'unlabelled'").select("seed", "group")
    arms = spark.createDataFrame([(a,) for a in ARMS[1:]], "arm string")
    results = chosen = None
    members = labelled.select("seed", F.lit(ARMS[0]).alias("arm"), "group")
    numbers = {(s, ARMS[0]): k for k, s in enumerate(seeds)}
    for round_ in range(rounds + 1):
        many = len(numbers)
        table = spark.createDataFrame([(s, a, k) for (s, a), k in numbers.items()], "seed int, arm string, model int")
        of_group = members.join(F.broadcast(table), ["seed", "arm"]).groupBy("group").agg(F.collect_list("model").alias("models"))
        learnt = materialize(train.join(of_group, "group").select("group", "vector", "label", "models"), "experiment-train")
        weights = fit(learnt, many, width)
        sizes = learnt.select("group", F.explode("models").alias("model")).groupBy("model").agg(F.count_distinct("group").alias("n_groups"), F.count("*").alias("n_rows"))
        tested = scored(fine.filter("split = 'test'"), weights, width).select("label", F.posexplode("scores").alias("model", "score"))
        measured = table.join(sizes, "model", "left").join(auroc_by(tested, "model"), "model", "left")
        now = materialize(measured.select("seed", "arm", F.lit(round_).alias("round"), F.coalesce("n_groups", F.lit(0)).alias("n_groups"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("auroc", F.lit(0.5)).alias("auroc")), "experiment-results")
        results = now if results is None else results.union(now)
        discard(learnt)
        if round_ == rounds:
            break
        pool = rest.crossJoin(F.broadcast(arms))
        if chosen is not None:
            pool = pool.join(chosen.select("seed", "arm", "group"), ["seed", "arm", "group"], "left_anti")
        # the first choice rests on the model of the labelled pool, later ones on the arm's own
        model_of = {s: numbers.get((s, "uncertainty"), numbers.get((s, ARMS[0]))) for s in seeds}
        owner = spark.createDataFrame([(s, "uncertainty", m) for s, m in model_of.items()], "seed int, arm string, model int")
        doubts = scored(train, weights, width).select("group", F.posexplode("scores").alias("model", "score")).groupBy("group", "model").agg(F.avg(entropy(F.col("score"))).alias("doubt"))
        picked = materialize(_chosen(pool, doubts.join(F.broadcast(owner), "model").select("seed", "arm", "group", "doubt"), budget, round_).withColumn("round", F.lit(round_ + 1)), "experiment-chosen")
        chosen = picked if chosen is None else chosen.union(picked)
        members = labelled.crossJoin(F.broadcast(arms)).select("seed", "arm", "group").union(chosen.select("seed", "arm", "group"))
        numbers = {(s, a): k for k, (s, a) in enumerate((s, a) for s in seeds for a in ARMS[1:])}
    if chosen is None:
        chosen = members.limit(0).withColumn("round", F.lit(0))
    return results, chosen.select("seed", "arm", "round", "group")


def write_arms(index: DataFrame, labelled: DataFrame, path: str, group: str = "group") -> None:
    """Each arm's index, below ``path`` by seed, arm and round: the train rows of the groups in ``labelled``
    (seed, arm, round, group) and all rows of the other splits. These are scratch, not releases."""
    train = index.filter("split = 'train'").join(labelled.select("seed", "arm", "round", F.col("group").alias(group)).distinct(), group)
    arms = labelled.select("seed", "arm", "round").distinct()
    rest = index.filter("split <> 'train'").crossJoin(F.broadcast(arms))
    train.unionByName(rest.select(*train.columns)).write.mode("errorifexists").partitionBy("seed", "arm", "round").parquet(path)
