"""Quality classifier: a sparse ensemble of rules over text statistics.

Paths of shallow trees become conjunctive rules, a lasso logistic regression picks and weighs them,
and the chosen rules compile into one Spark column expression, so scoring stays in the JVM.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from quern.llm.storage import materialize

TREES, DEPTH, LASSO, SEED = 16, 3, 0.001, 7
#: Labelled documents learnt from, at most.
SAMPLE = 8_000
#: Marks whose count per word is a statistic.
MARKS = {"bars": "|", "cries": "!", "hashes": "#", "dollars": "$", "percents": "%", "ands": "&", "stars": "*", "stops": ".", "commas": ",", "lines": "\n", "braces": "{", "angles": "<"}
STATISTICS = ("n_chars", "n_words", "word_chars", "longest", "distinct", "repeats", "capitals", "digits", *MARKS)


def statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the statistics of each whole text; null counts as empty.

    They come out of a generator, below which no later filter is pushed: pushed down, it would
    work out every statistic again for each use.
    """
    base = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    base = base.select(*keep, "_text", F.filter(F.split("_text", r"\s+"), lambda w: w != "").alias("_words"))
    n = F.greatest(F.size("_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.length("_text"), F.lit(1)).cast("double")
    same = F.filter("_words", lambda w, i: w == F.get("_words", i - 1))
    found = {
        "n_chars": F.length("_text").cast("double"),
        "n_words": F.size("_words").cast("double"),
        "word_chars": chars / n,
        "longest": F.coalesce(F.array_max(F.transform("_words", lambda w: F.length(w))), F.lit(0)).cast("double"),
        "distinct": F.size(F.array_distinct("_words")) / n,
        "repeats": F.size(same) / n,
        "capitals": F.regexp_count("_text", F.lit(r"\p{Lu}")) / chars,
        "digits": F.regexp_count("_text", F.lit("[0-9]")) / chars,
    }
    found |= {name: (F.length("_text") - F.length(F.replace("_text", F.lit(mark)))) / n for name, mark in MARKS.items()}
    return base.select(*keep, F.inline(F.array(F.struct(*[found[s].alias(s) for s in STATISTICS]))))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above?, bound)."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(s) > b if above else F.col(s) <= b for s, above, b in self.terms])


SPLIT = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-\d.E]+)\)$")


def tree_rules(tree_text: str) -> list[Rule]:
    """The rules of a tree as printed by Spark ML: one for the path to each node below the root."""
    path: list[tuple[int, tuple[str, bool, float]]] = []
    rules = []
    for line in tree_text.splitlines():
        if m := SPLIT.match(line):
            depth = len(m[1])
            while path and path[-1][0] >= depth:
                path.pop()
            path.append((depth, (STATISTICS[int(m[3])], m[4] == ">", float(m[5]))))
            rules.append(Rule(tuple(sorted({t for _, t in path}))))
    return rules


@dataclass
class Model:
    """Weighted rules; the score is the logistic function of their sum and the intercept."""

    rules: list[tuple[Rule, float]]
    intercept: float

    def column(self) -> Column:
        """The score as one expression over the statistics."""
        z = reduce(lambda a, b: a + b, [F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-z))


def fit(rows: DataFrame, label: str = "label") -> Model:
    """Fit on a small DataFrame of statistics and a 0/1 label.

    Where a label is missing altogether, or no tree finds a split (few rows, or statistics that are
    the same for all), the score is the same for all: the share of ones, drawn to one half by two
    pseudo-rows.
    """
    rows = rows.select(array_to_vector(F.array(*STATISTICS)).alias("features"), F.col(label).cast("double").alias("label"), *STATISTICS).cache()
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    ones, total = sizes.get(1.0, 0) + 1, sum(sizes.values()) + 2
    same = Model([], math.log(ones / (total - ones)))
    if len(sizes) < 2:
        rows.unpersist()
        return same
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(rows)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in tree_rules(tree.toDebugString)))
    if not rules:
        rows.unpersist()
        return same
    held = rows.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features")).cache()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=40, standardization=False).fit(held)
    rows.unpersist()
    held.unpersist()
    return Model([(r, float(w)) for r, w in zip(rules, lasso.coefficients) if w], float(lasso.intercept))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows, taken in the order of a hash of the key.

    Rows of ``labels`` with a null key or label are left out; the bounded sample is broadcast.
    """
    chosen = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(label).alias("label")).distinct()
    chosen = chosen.orderBy(F.xxhash64("_key"), "_key", "label").limit(sample)
    known = docs.select(key, text).join(F.broadcast(chosen), F.col(key) == F.col("_key"))
    # the scan stays spread over tasks; only the sample's statistics come together
    rows = statistics(known, ["_key", "label"], text).repartition(1).sortWithinPartitions("_key", "label", *STATISTICS)
    return fit(materialize(rows, "quality-sample").coalesce(1))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """``keep`` and ``out`` (0 to 1, label 1 likelier when higher) of every row; repeats stay.

    The kept columns travel as one struct, so their names can't clash with the statistics.
    """
    packed = docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_body"))
    return statistics(packed, ["_row"], "_body").select("_row.*", model.column().alias(out))
