"""SimHash near-duplicates with covering locality-sensitive hashing.

A radius r needs 2^(r+1) - 1 tables. Each of the 64 bits gets a nonzero vector of r+1 bits; table v
keeps the bits whose vector has an odd inner product with v. The vectors of any r bits span at most
r dimensions, so some v is orthogonal to all of them: two fingerprints that differ in those bits
agree on all the bits that table v keeps. No pair within the radius is missed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from quern.llm.components import connected_components
from quern.llm.storage import materialize

SEED = 42
WORDS = 3
RADIUS = 3
#: Fingerprints compared as one block; larger buckets are split into blocks that meet in pairs.
BLOCK = 512
#: Shingles counted at once, so that a long text needs bounded memory.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """SimHash of the text's word shingles (repeats count), as a signed 64-bit integer."""
    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()[words - 1 :] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    groups = (np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[k : k + CHUNK], stops[k : k + CHUNK])), dtype="<u8") for k in range(0, len(stops), CHUNK))
    return majority(groups, len(stops))


def majority(groups: Iterable[np.ndarray], total: int) -> int:
    """The bits that more than half of ``total`` hashes set, as a signed 64-bit integer."""
    ones = np.zeros(64, dtype=np.int64)
    for hashes in groups:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, bits): the fingerprint of each whole text; null and wordless texts have zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int64())], names=["key", "bits"])

    out = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("bits", T.LongType())])
    return docs.select(key, text).mapInArrow(run, out)


def masks(radius: int = RADIUS) -> list[int]:
    """The kept bits of each covering table, as signed 64-bit integers."""
    size = (1 << (radius + 1)) - 1
    vector = [k % size + 1 for k in range(64)]
    kept = [sum(1 << k for k in range(64) if (vector[k] & v).bit_count() % 2) for v in range(1, size + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def _forest(left: np.ndarray, right: np.ndarray, radius: int) -> list[dict[str, int]]:
    """Links within the radius between two blocks, less those that links kept before imply."""
    near = np.bitwise_count((left[:, None] ^ right[None, :]).view(np.uint64)) <= radius
    values, root = np.concatenate([left, right]), list(range(len(left) + len(right)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i, j in zip(*np.nonzero(near)):
        a, b = top(int(i)), top(len(left) + int(j))
        if a != b:
            root[a] = b
            if left[i] != right[j]:
                links.append({"u": int(left[i]), "v": int(right[j])})
    return links


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(u, v): links that connect exactly the distinct ``bits`` that chains of near pairs connect.

    Buckets of the covering tables are dealt out in blocks of about ``block`` fingerprints by a
    hash; a bucket's blocks meet in pairs, and each meeting returns a forest of its near pairs (under
    2 * ``block`` links). So a bucket of m distinct fingerprints, m over ``block``, takes about
    m * m / 2 comparisons and up to m * m / ``block`` links; copies of a fingerprint count once.
    """
    keyed = prints.select(
        "bits",
        F.posexplode(F.array(*[F.col("bits").bitwiseAND(F.lit(m).cast("long")) for m in masks(radius)])).alias("table", "kept"),
    )
    blocks = (
        keyed.groupBy("table", "kept")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    )
    dealt = (
        keyed.join(blocks, ["table", "kept"])
        .withColumn("block", F.pmod(F.xxhash64("bits"), F.col("blocks")).cast("int"))
        .groupBy("table", "kept", "blocks", "block")
        .agg(F.collect_list("bits").alias("members"))
    )
    dealt = materialize(dealt, "simhash-blocks")
    one = dealt.filter("blocks = 1").select(F.col("members").alias("a"), F.col("members").alias("b"))
    many = dealt.filter("blocks > 1")
    meet = many.alias("x").join(many.alias("y"), ["table", "kept"]).filter("x.block <= y.block").select(F.col("x.members").alias("a"), F.col("y.members").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for a, b in zip(batch.column(0), batch.column(1)):
                for e in _forest(a.values.to_numpy(), b.values.to_numpy(), radius):
                    u.append(e["u"])
                    v.append(e["v"])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return one.union(meet).mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(key, bits, component): for each row the smallest key it reaches over near fingerprints.

    Equal fingerprints are one node, so copies cost one row. Rows with a null key are linked like
    others but never name a component; one of nulls alone has a null component. Repeated rows stay.
    """
    prints = materialize(fingerprints(docs, key, text, words), "simhash")
    nodes = materialize(prints.groupBy("bits").agg(F.min("key").alias("least")), "simhash-nodes")
    found = connected_components(links(nodes.select("bits"), radius))
    # both sides of the join by class are read from tables, so that a large class can be split
    classes = materialize(nodes.join(found, nodes.bits == found.node, "left").select("bits", F.coalesce("component", "bits").alias("class"), "least"), "simhash-classes")
    least = materialize(classes.groupBy("class").agg(F.min("least").alias("component")), "simhash-least")
    named = classes.select("bits", "class").join(least, "class").select("bits", "component")
    return prints.join(named, "bits").select(F.col("key").alias(key), "bits", "component")


def fingerprint_hex(bits):
    """The fingerprint column as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
