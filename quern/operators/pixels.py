"""Pixels as arrays: moments that merge, resampling with separable weights, standard scores.

Everything is a column expression. An image has its own count, mean and sum of squared deviations;
such triples merge in any grouping, so tasks merge what they hold and few triples are shuffled.
Null images and null pixels don't count; without any pixel the moments are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.keys import rounded, shuffle_key

#: Triples that one task merges at a time.
FAN_IN = 4096


def own_moments(pixels: Column) -> Column:
    """struct<n, mean, m2> of one image."""
    fine = F.transform(F.filter(pixels, lambda p: p.isNotNull()), lambda p: p.cast("double"))
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda s, x: s + f(x))
    n = F.size(fine).cast("double")
    mean = total(fine, lambda x: x) / n
    # the mean is bound once by a lambda over one element, so it isn't worked out for each pixel
    m2 = F.get(F.transform(F.array(mean), lambda m: total(fine, lambda x: (x - m) * (x - m))), F.lit(0))
    return F.when(pixels.isNotNull() & (F.size(fine) > 0), F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2")))


def merged(a: Column, b: Column) -> Column:
    """The moments of two sets together."""
    n, shift = a["n"] + b["n"], b["mean"] - a["mean"]
    both = F.struct(n.alias("n"), (a["mean"] + shift * (b["n"] / n)).alias("mean"), (a["m2"] + b["m2"] + shift * shift * (a["n"] * b["n"] / n)).alias("m2"))
    return F.when(n == 0, a).otherwise(both)


def moments(images: DataFrame, pixels: str) -> DataFrame:
    """One row: ``n`` pixels, ``mean`` and population deviation ``std`` over all images."""
    triples = images.select(own_moments(F.col(pixels)).alias("m")).filter("m is not null")
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    gathered = lambda: F.aggregate(F.collect_list("m"), none, merged).alias("m")
    n = images.count()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        triples = triples.withColumn("g", F.pmod(F.monotonically_increasing_id(), F.lit(n))).groupBy("g").agg(gathered()).select("m")
    one = triples.agg(gathered())
    some = F.col("m.n") > 0
    return one.select(F.col("m.n").cast("long").alias("n"), F.when(some, F.col("m.mean")).alias("mean"), F.when(some, F.sqrt(F.col("m.m2") / F.col("m.n"))).alias("std"))


def running_deviation(pixels: Column) -> Column:
    """The population deviation by Welford's steps, one pixel after the other, as SQL engines take them:
    where the exact value lies in the middle of two rounded ones, other sums fall to the other side."""

    def step(s: Column, x: Column) -> Column:
        n, shift = s["n"] + 1.0, x - s["mean"]
        mean = s["mean"] + shift / n
        return F.struct(n.alias("n"), mean.alias("mean"), (s["m2"] + (x - mean) * shift).alias("m2"))

    fine = F.transform(F.filter(pixels, lambda p: p.isNotNull()), lambda p: p.cast("double"))
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(fine, none, step, lambda s: F.when(s["n"] > 0, F.sqrt(s["m2"] / s["n"])))


def statistics(images: DataFrame, key: str, pixels: str, places: int = 2) -> DataFrame:
    """(``key``, ``min``, ``max``, ``mean``, ``std``) of each image, the last two rounded; null without pixels."""
    m = F.col("m")
    return images.select(key, F.array_min(pixels).cast("double").alias("min"), F.array_max(pixels).cast("double").alias("max"), own_moments(F.col(pixels)).alias("m"), running_deviation(F.col(pixels)).alias("std")).select(
        key, "min", "max", rounded(m["mean"], places).alias("mean"), rounded(F.col("std"), places).alias("std")
    )


def flipped(pixels: Column, width: int) -> Column:
    """The image with each row from right to left."""
    return F.transform(pixels, lambda _, k: F.get(pixels, (k - k % width + (width - 1) - k % width).cast("int")))


def augmented(images: DataFrame, key: str, pixels: str, width: int, seed: int, split: str = "split") -> DataFrame:
    """``images`` with half of the train images flipped, chosen by a keyed hash, so that a run with the seed
    chooses the same; the other splits stay as they are."""
    chosen = (F.col(split) == "train") & (F.substring(shuffle_key(seed, F.col(key)), 1, 1) < "8")
    return images.withColumn(pixels, F.when(chosen, flipped(F.col(pixels), width)).otherwise(F.col(pixels)))


def weights(size: int, wanted: int) -> list[list[float]]:
    """For each of ``wanted`` places the weights of ``size`` places: a triangle as wide as the step, but
    at least one place to each side, that adds up to 1."""
    step = size / wanted
    reach = max(step, 1.0)
    rows = []
    for i in range(wanted):
        middle = (i + 0.5) * step
        row = [max(0.0, 1.0 - abs((j + 0.5 - middle) / reach)) for j in range(size)]
        rows.append([w / sum(row) for w in row])
    return rows


def resampled(pixels: Column, height: int, width: int, to_height: int, to_width: int) -> Column:
    """An image (rows one after the other) of ``height`` by ``width`` at another size: first along
    rows, then along columns, as array<double>."""
    table = lambda rows: F.array(*[F.array(*[F.lit(w) for w in row]) for row in rows])
    across, down = weights(width, to_width), weights(height, to_height)
    span = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    sum_of = lambda terms: F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    wide = F.transform(span(height * to_width), lambda k: sum_of(F.zip_with(F.slice(pixels, (F.floor(k / to_width) * width + 1).cast("int"), width), F.get(table(across), (k % to_width).cast("int")), lambda p, w: p.cast("double") * w)))
    column = lambda rows, x: F.transform(span(height), lambda y: F.get(rows, (y * to_width + x).cast("int")))
    both = lambda rows: F.transform(span(to_height * to_width), lambda k: sum_of(F.zip_with(column(rows, k % to_width), F.get(table(down), F.floor(k / to_width).cast("int")), lambda p, w: p * w)))
    return F.get(F.transform(F.array(wide), both), F.lit(0))


def standard_scores(pixels: Column, mean: Column, std: Column, eps: float = 1e-8) -> Column:
    """(p - mean) / (std + eps) of each pixel."""
    return F.transform(pixels, lambda p: (p.cast("double") - mean) / (std + eps))
