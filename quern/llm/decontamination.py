"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Of every ``WINDOW - K + 1`` consecutive k-gram hashes the smallest (leftmost on ties) is kept. A
shared span of WINDOW words holds the same run of k-grams on both sides, so both sides keep the
same hash in it. Joined fingerprints name candidate places; each is extended to the full windows
around it, whose words must then be equal, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quern.llm.storage import materialize

WINDOW = 10
K = 5
#: One long holds a 34-bit hash over a 30-bit position: the smallest is the leftmost least hash.
POSITION_BITS = 30
#: Benchmark fingerprints are broadcast up to this count (16 bytes each) and else joined by shuffle.
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased; other letters stay. Texts of ASCII alone take the faster built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def _positions(n: Column) -> Column:
    """0 to n - 1, empty where n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def kgrams(w: Column, k: int) -> Column:
    """The hash and position of each k-gram in one long each."""
    place = lambda i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.slice(w, i + 1, k)), 64 - (63 - POSITION_BITS)), POSITION_BITS)
    return F.transform(_positions(F.size(w) - (k - 1)), lambda i: place(i).bitwiseOR(i.cast("long")))


def winnow(grams: Column, span: int) -> Column:
    """The smallest of every ``span`` consecutive entries, each once."""
    return let(grams, lambda g: F.array_distinct(F.transform(_positions(F.size(g) - (span - 1)), lambda i: F.array_min(F.slice(g, i + 1, span)))))


def _hash(code: Column) -> Column:
    return F.shiftrightunsigned(code, POSITION_BITS)


def _position(code: Column) -> Column:
    return code.bitwiseAND(F.lit((1 << POSITION_BITS) - 1).cast("long")).cast("int")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if a count shows that it is small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """For each row of ``docs``: key, n_words, n_hit, n_items, item_ids (sorted), row_hash (of key
    and text), text_crc.

    A document word is hit inside any occurrence of an item's window of ``window`` words; an item
    of fewer words (but not none) is one window. Null texts have no words; null item keys count as
    an item called ''. Repeated rows stay; rows that share a key are judged by their own texts.
    """
    base = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(key, text).alias("row"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("row2"))
    bench = materialize(
        items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("item"), words(F.col(item_text)).alias("w")).filter("size(w) > 0"),
        "benchmark",
    )
    windows = (
        bench.select("item", "w", F.explode(_positions(F.greatest(F.size("w") - (window - 1), F.lit(1)))).alias("at"))
        .select("item", F.array_join(F.slice("w", F.col("at") + 1, window), " ").alias("content"), F.least(F.size("w"), F.lit(window)).alias("span"))
        .groupBy("content", "span")
        .agg(F.collect_set("item").alias("items"))
    )
    windows = materialize(windows, "benchmark-windows")
    long_prints = bench.filter(F.size("w") >= window).select(F.explode(winnow(kgrams(F.col("w"), k), window - k + 1)).alias("code")).select(_hash(F.col("code")).alias("hash")).distinct()
    # an item below the window is found by its longest word, tried at each offset that it has there
    short = bench.filter(F.size("w") < window).select("w", F.array_max(F.transform("w", lambda x: F.struct(F.length(x).alias("n"), x.alias("word"))))["word"].alias("anchor"))
    short = (
        short.select("anchor", F.size("w").alias("span"), F.posexplode("w").alias("offset", "word"))
        .filter("word = anchor")
        .groupBy("anchor")
        .agg(F.collect_set(F.struct("offset", "span")).alias("tries"))
    )
    short = materialize(short, "benchmark-anchors")
    has_short = not short.isEmpty()

    parts = base.select("key", "row", "row2", words(F.col("text")).alias("w"))
    prints = let(winnow(kgrams(F.col("w"), k), window - k + 1), lambda c: F.array_append(F.when(F.size("w") >= window, c).otherwise(F.array().cast("array<bigint>")), F.lit(-1).cast("long")))
    seen = parts.select("key", "row", "row2", F.size("w").alias("n_words"), F.explode(prints).alias("code"))
    hits = (
        seen.join(_small(long_prints.withColumn("known", F.lit(True))), _hash(F.col("code")) == F.col("hash"), "left")
        .filter("known or code = -1")
        .groupBy("key", "row", "row2", "n_words")
        .agg(F.collect_set(F.when(F.col("code") >= 0, _position(F.col("code")))).alias("places"))
    )
    hits = materialize(hits, "contamination-hits")

    cols = ["row", "row2"]
    def contents(starts: Column, at, span) -> Column:
        """Each start with the words of its window, made inside the row so that texts aren't copied."""
        return F.explode(F.transform(starts, lambda s: F.struct(at(s).alias("at"), F.array_join(F.slice("w", at(s) + 1, span(s)), " ").alias("content"), span(s).alias("span"))))

    around = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(F.greatest(p - (window - k), F.lit(0)), F.least(p, F.size("w") - window)))))
    texts = base.select(*cols, "text").join(hits.filter("size(places) > 0").select(*cols, "places").distinct(), cols).dropDuplicates(cols)
    tried = texts.select(*cols, "places", words(F.col("text")).alias("w")).select(*cols, contents(around, lambda p: p, lambda p: F.lit(window)).alias("s")).select(*cols, "s.*")
    if has_short:
        spots = parts.select(*cols, F.posexplode("w").alias("p", "word")).join(_small(short), F.col("word") == F.col("anchor"))
        spots = spots.select(*cols, "p", F.explode("tries").alias("try")).select(*cols, (F.col("p") - F.col("try.offset")).alias("at"), F.col("try.span").alias("span")).filter("at >= 0")
        spots = spots.groupBy(*cols).agg(F.collect_set(F.struct("at", "span")).alias("spots"))
        near = base.select(*cols, "text").join(spots, cols).dropDuplicates(cols).select(*cols, words(F.col("text")).alias("w"), "spots")
        fitting = F.filter("spots", lambda s: s["at"] + s["span"] <= F.size("w"))
        near = near.select(*cols, contents(fitting, lambda s: s["at"], lambda s: s["span"]).alias("s"))
        tried = tried.union(near.select(*cols, "s.*"))
    matched = tried.join(_small(windows), ["content", "span"]).select(*cols, "at", "span", "items")
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("span")).alias("end")))),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["end"] - F.greatest(x["at"], s["reach"]), F.lit(0))).alias("n"),
            F.greatest(s["reach"], x["end"]).alias("reach"),
        ),
    )["n"]
    found = matched.groupBy(*cols).agg(covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"))
    out = base.select("key", *cols).join(hits.select(*cols, "n_words").distinct(), cols, "left").join(found, cols, "left")
    return out.select(
        F.col("key").alias(key),
        F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("row").alias("row_hash"),
        F.col("row2").alias("text_crc"),
    )
