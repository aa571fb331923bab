"""SpotSigs document fingerprints, in DataFrame functions alone.

A signature is a common word (the anchor) with the chain of content words that follow it, anchors
skipped; a document's fingerprint is its set of signatures. Likeness is the Jaccard similarity.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quern.llm.storage import materialize

CHAIN = 2
THRESHOLD = 0.8
#: Rows of one stretch of the key order, and the most stretches that there are.
STRETCH_ROWS, STRETCHES = 512, 10_000

#: Common words of English, German, French and Spanish (fixed values).
ANCHORS = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will with "
    "auch auf aus das dem den der des die ein eine er es für ich im ist mit nicht sich sie und von war wie zu "
    "au aux avec ce dans de des du elle en est et il je la le les ne pas pour que qui se son sur un une "
    "al como con del el ella ha la las lo los más no para pero por que se sin su sus un una y"
).split()


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _places(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted distinct 32-bit signature hashes of a text; null counts as empty.

    A text without an anchor gets the chains from each of its words, and one without a word the
    hash of the text, so that every text has a signature and equal texts have equal ones.
    """
    text = F.coalesce(text, F.lit(""))
    word = lambda w, i: F.get(w, i)

    def anchored(w: Column, content: Column) -> Column:
        def at(p: Column, j: Column) -> Column:
            before = F.coalesce(F.get(content, j - 1), F.lit(-1))
            follow = [word(w, F.get(content, j + k)) for k in range(chain)]
            return F.transform(F.slice(w, before + 2, p - before - 1), lambda anchor: F.hash(anchor, *follow))

        return F.flatten(F.transform(content, at))

    def of(w: Column) -> Column:
        content = F.filter(_places(F.size(w)), lambda i: ~word(w, i).isin(ANCHORS))
        spots = _let(content, lambda c: anchored(w, c))
        plain = F.transform(_places(F.size(w)), lambda i: F.hash(F.lit(""), *[word(w, i + k) for k in range(chain)]))
        return _let(spots, lambda s: F.when(F.size(s) > 0, s).otherwise(plain))

    found = _let(_words(text), of)
    return _let(found, lambda s: F.when(F.size(s) > 0, F.sort_array(F.array_distinct(s))).otherwise(F.array(F.hash(F.lit("\0"), text))))


def fingerprint_text(sigs: Column) -> Column:
    """A signature set as text: eight hexadecimal digits for each."""
    return F.lower(F.array_join(F.transform(sigs, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets, neither of them empty."""
    return _let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))


def with_next(docs: DataFrame, key: str = "key", text: str = "text", keep=lambda df: df) -> DataFrame:
    """``docs`` with next_* columns from the row that follows in key order; after the last: the first.

    The key order is cut into stretches at approximate quantiles. Each stretch also gets the first
    row of the one after, so one shuffle by stretch serves and no task sees the whole order. Null
    keys come first and rows of one key go by text; keys that aren't whole numbers go in the order of their bytes. ``keep`` may add columns after the shuffle.
    """
    kind = docs.schema[key].dataType
    # other keys than whole numbers go by the first seven bytes of their text, and then as they are
    head = F.conv(F.rpad(F.hex(F.substring(F.col(key).cast("string").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    order = F.coalesce(F.col(key).cast("long") if isinstance(kind, T.IntegralType) else head, F.lit(-(1 << 63)))
    rows = docs.count()
    count = max(1, min(STRETCHES, math.ceil(rows / STRETCH_ROWS)))
    cuts = docs.select(order.alias("k")).agg(F.min("k").alias("least"), F.percentile_approx("k", [i / count for i in range(1, count)] or [0.5], max(10_000, 10 * count)).alias("cuts")).first()
    if cuts["least"] is None:
        starts = []
    else:
        starts = sorted({cuts["least"], *(cuts["cuts"] if count > 1 else [])})
    bounds = F.array(*[F.lit(s).cast("long") for s in starts]) if starts else F.array().cast("array<bigint>")
    steps = [1 << p for p in range(max(1, len(starts)).bit_length(), -1, -1)]

    def search(k: Column) -> Column:
        step = lambda low, s: F.when((low + s < len(starts)) & (F.coalesce(F.get(bounds, low + s), F.lit((1 << 63) - 1)) <= k), low + s).otherwise(low)
        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)

    placed = docs.withColumn("_k", order).withColumn("_s", search(F.col("_k")))
    ghost = F.when(F.get(bounds, F.col("_s")) == F.col("_k"), F.array(F.struct(F.lit(False).alias("ghost"), F.col("_s").alias("s")), F.struct(F.lit(True).alias("ghost"), F.pmod(F.col("_s") - 1, F.lit(max(1, len(starts)))).alias("s"))))
    placed = placed.withColumn("_at", F.explode(F.coalesce(ghost, F.array(F.struct(F.lit(False).alias("ghost"), F.col("_s").alias("s"))))))
    placed = placed.select(*docs.columns, "_k", F.col("_at.ghost").alias("_ghost"), F.col("_at.s").alias("_stretch")).repartition("_stretch")
    placed = keep(placed)
    follows = Window.partitionBy("_stretch").orderBy("_ghost", "_k", key, text)
    added = [c for c in placed.columns if not c.startswith("_")]
    return placed.select("*", *[F.lead(c).over(follows).alias(f"next_{c}") for c in added]).filter("not _ghost").drop("_k", "_ghost", "_stretch")


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and what they are like.

    The edited text has the last half of the code points (rounded down) replaced by as many, or
    all, from the start of the next text in key order. Null texts count as empty; repeated rows stay.
    """
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    both = with_next(slim, keep=lambda df: df.withColumn("sigs", signatures(F.col("text"))))
    half = F.floor(F.length("text") / 2).cast("int")
    both = both.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    both = both.select("key", "n_chars", "sigs", "next_sigs", F.sha2("edited", 256).alias("edited_sha256"), signatures(F.col("edited")).alias("edited_sigs"))
    return both.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        fingerprint_text(F.col("sigs")).alias("fingerprint"),
        fingerprint_text(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): every row's class of equal fingerprints, and the pairs of classes whose
    likeness reaches ``threshold``, as (left, right, likeness) with left < right.

    A class is named by its smallest key. Sets go to partitions by length, so that only equal or
    neighbouring ones can be alike enough; within those a pair must share one of its rarest
    signatures, as many as a set can miss and one more. Rows with a null key join classes, but a
    class of them alone is left out of the pairs.
    """
    rows = materialize(docs.select(F.col(key).alias("key"), signatures(F.col(text)).alias("sigs")).withColumn("print", F.sha2(fingerprint_text(F.col("sigs")), 256)), "spotsigs")
    sets = rows.groupBy("print").agg(F.min("key").alias("class"), F.first("sigs").alias("sigs"))
    members = rows.join(sets.select("print", "class"), "print").select(F.col("key").alias(key), "class")
    sets = materialize(sets.filter("class is not null").select("class", "sigs", F.size("sigs").alias("n")), "spotsigs-sets")
    single = sets.select("class", "n", F.explode("sigs").alias("sig"))
    ranked = single.join(single.groupBy("sig").agg(F.count("*").alias("df")), "sig").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by_df"))
    rare = ranked.select("class", "n", F.explode(F.slice("by_df", F.lit(1), F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)).alias("r")).select("class", "n", "r.sig", F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9).alias("part"))
    near = rare.select("class", "n", "sig", F.explode(F.array(F.col("part"), F.col("part") + 1, F.col("part") - 1)).alias("part"))
    found = rare.alias("x").join(near.alias("y"), ["sig", "part"]).filter("x.class < y.class and least(x.n, y.n) >= greatest(x.n, y.n) * %r" % (threshold - 1e-9))
    found = found.select(F.col("x.class").alias("left"), F.col("y.class").alias("right")).distinct()
    pairs = found.join(sets.select(F.col("class").alias("left"), F.col("sigs").alias("a")), "left").join(sets.select(F.col("class").alias("right"), F.col("sigs").alias("b")), "right")
    return members, pairs.select("left", "right", likeness(F.col("a"), F.col("b")).alias("likeness")).filter(F.col("likeness") >= threshold)
