"""Vectors: difference bits, Hamming candidates, and correlation to confirm them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.storage import materialize

#: Vectors compared as one block where bands would be too narrow.
BLOCK = 1024
#: Pairs of blocks, and pairs with a vector, that one task sorts.
BLOCK_PAIRS, PAIRS = 256, 1 << 16


def difference_bits(vector: Column) -> Column:
    """Bit i is set where element i + 1 is larger than element i (up to 64 bits)."""
    places = F.sequence(F.lit(0), F.size(vector) - 2)
    set_bits = F.filter(places, lambda i: F.get(vector, i + 1) > F.get(vector, i))
    return F.aggregate(set_bits, F.lit(0).cast("long"), lambda acc, i: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def standardized(vector: Column, eps: float = 1e-8) -> Column:
    """(v - mean) / (population standard deviation + eps)."""
    wide = F.transform(vector, lambda x: x.cast("double"))

    def of(v: Column) -> Column:
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
        mean = total(v) / F.size(v)
        spread = F.sqrt(total(F.transform(v, lambda x: (x - mean) * (x - mean))) / F.size(v))
        return F.transform(F.array(F.struct(mean.alias("m"), spread.alias("s"))), lambda p: F.transform(v, lambda x: (x - p["m"]) / (p["s"] + eps)))[0]

    return F.transform(F.array(wide), of)[0]


def correlation(a: Column, b: Column) -> Column:
    """Mean product of two standardized vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def bands(bits: Column, n_bits: int, radius: int) -> Column:
    """array<struct<band, part>>: radius + 1 cuts of the bits. Two that differ in ``radius`` bits at
    most agree on one of them."""
    n = radius + 1
    cuts = [(k * n_bits // n, (k + 1) * n_bits // n) for k in range(n)]
    return F.array(*[F.struct(F.lit(k).alias("band"), F.shiftrightunsigned(bits, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long")).alias("part")) for k, (lo, hi) in enumerate(cuts)])


def _dealt(rows: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``rows`` dealt by ``keys`` to ``parts`` partitions, or to as many as Spark would take if those are
    more, and not put together again, so that a task's share stays small where the number of pairs
    grows with the square of the rows."""
    return rows.repartition(max(parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def near_pairs(rows: DataFrame, key: str, group: str, bits: str, radius: int, n_bits: int = 63, narrow: int = 12) -> DataFrame:
    """(a, b, hamming): pairs a < b of different groups within the radius, each once.

    With bands of ``narrow`` bits or more, an equi-join on bands finds all of them. With narrower
    ones most pairs share a band, so rows are dealt to blocks and every two blocks meet instead,
    spread over tasks by block pair; either way the result is exact.
    """
    slim = rows.select(F.col(key).alias("k"), F.col(group).alias("g"), F.col(bits).alias("x"))
    if n_bits // (radius + 1) >= narrow:
        cut = slim.select("*", F.explode(bands(F.col("x"), n_bits, radius)).alias("b")).select("k", "g", "x", "b.band", "b.part")
        pairs = cut.alias("l").join(cut.alias("r"), ["band", "part"])
    else:
        n = slim.count()
        blocks = max(1, -(-n // BLOCK))
        dealt = slim.withColumn("block", F.pmod(F.xxhash64("k"), F.lit(blocks)))
        ids = F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")
        left = dealt.select("*", F.explode(F.filter(ids, lambda i: i >= F.col("block"))).alias("other")).select("k", "g", "x", F.col("block").alias("p"), F.col("other").alias("q"), (F.col("block") == F.col("other")).alias("same"))
        right = dealt.select("*", F.explode(F.filter(ids, lambda i: i <= F.col("block"))).alias("other")).select("k", "g", "x", F.col("other").alias("p"), F.col("block").alias("q"))
        parts = -(-blocks * (blocks + 1) // (2 * BLOCK_PAIRS))
        pairs = _dealt(left, parts, "p", "q").alias("l").join(_dealt(right, parts, "p", "q").alias("r"), ["p", "q"]).filter("not l.same or l.k < r.k")
    near = hamming(F.col("l.x"), F.col("r.x"))
    found = pairs.filter((F.col("l.g") != F.col("r.g")) & (F.col("l.k") != F.col("r.k")) & (near <= radius))
    return found.select(F.least("l.k", "r.k").alias("a"), F.greatest("l.k", "r.k").alias("b"), near.alias("hamming")).distinct()


def confirm(pairs: DataFrame, rows: DataFrame, key: str, vector: str, least: float) -> DataFrame:
    """Pairs with ``correlation``, those from ``least`` on; compared before any rounding. The pairs are
    written and counted first, as they are many more than rows, and carry a vector each."""
    pairs = materialize(pairs, "near-pairs")
    parts = -(-pairs.count() // PAIRS)
    z = rows.select(F.col(key).alias("k"), standardized(F.col(vector)).alias("z"))
    first = _dealt(pairs, parts, "a").join(z.select(F.col("k").alias("a"), F.col("z").alias("za")), "a")
    joined = _dealt(first, parts, "b").join(z.select(F.col("k").alias("b"), F.col("z").alias("zb")), "b")
    return joined.select("a", "b", "hamming", correlation(F.col("za"), F.col("zb")).alias("correlation")).filter(F.col("correlation") >= least)


def shared_texts(left: DataFrame, right: DataFrame, left_key: str, right_key: str, text: str = "text") -> DataFrame:
    """Texts that stand on both sides after lower-casing and joining white space: one row for each,
    with its least key and its count of rows (n_left, n_right) on either side.

    Copies are counted and never met in pairs.
    """
    norm = F.sha2(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), 256)
    side = lambda df, key, n: df.groupBy(norm.alias("h")).agg(F.min(key).alias(key), F.count("*").alias(n))
    return side(left, left_key, "n_left").join(side(right, right_key, "n_right"), "h").select(left_key, right_key, "n_left", "n_right")


def leakage_statistics(rows: DataFrame, pairs: DataFrame, confirmed: DataFrame, group: str) -> DataFrame:
    """One row: rows, pairs of different groups (n_compared), candidates, confirmed, and the largest
    correlation of a confirmed pair. Pairs are counted from the sizes of groups."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("n"))
    n = F.sum("n")
    counts = sizes.agg(n.alias("n_rows"), ((n * n - F.sum(F.col("n") * F.col("n"))) / 2).cast("long").alias("n_compared"))
    found = confirmed.agg(F.count("*").alias("n_confirmed"), F.max("correlation").alias("max_correlation"))
    return counts.crossJoin(pairs.agg(F.count("*").alias("n_candidates"))).crossJoin(found)
