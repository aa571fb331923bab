"""Views of the driver's tables that stand for the library's entities, in Spark and in SQL."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SALT = "test-salt"
SEED = 20260915
VARIANTS = ["en", "de", "fr", "es"]
#: code, display name, category, description, source column; 'unused' has no labels.
TAXONOMY = [
    ("quality", "Quality", "main", "Text of good quality.", "quality"),
    ("toxic", "Toxic", "other", "Text that insults.", "toxic"),
    ("unused", "Unused", "other", "A term without labels.", "unused"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TAXONOMY, "code string, display_name string, category string, description string, source_column string")


TAXONOMY_SQL = "taxonomy AS (SELECT * FROM (VALUES ('quality','main'),('toxic','other'),('unused','other')) t(code, category))"


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files: items, attachments (doc_id ends in 3) and metadata (ends in 07 or 57)."""
    text = F.concat(F.lit("items/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 10 == 3, "_att").otherwise(""), F.lit(".txt"))
    path = F.when(F.col("doc_id") % 50 == 7, F.concat(F.lit("meta/"), F.col("doc_id").cast("string"), F.lit(".txt"))).otherwise(text)
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "source", "lang", path.alias("rel_path"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"))


INV = """inv AS (SELECT doc_id, source, lang,
 CASE WHEN doc_id % 50 = 7 THEN 'meta/' || doc_id || '.txt'
      ELSE 'items/' || source || '/' || lang || '/' || doc_id || CASE WHEN doc_id % 10 = 3 THEN '_att' ELSE '' END || '.txt' END AS rel_path,
 sha256(text) AS sha256, strlen(text)::BIGINT AS size_bytes FROM documents)"""


def altered(inv: DataFrame) -> DataFrame:
    """An earlier state of the inventory: some files absent, some of other content, some since gone."""
    changed = F.col("doc_id") % 13 == 0
    old = inv.filter(F.col("doc_id") % 17 != 0).select(
        "doc_id", "rel_path", F.when(changed, F.sha2(F.concat("sha256", F.lit("x")), 256)).otherwise(F.col("sha256")).alias("sha256"), (F.col("size_bytes") + F.when(changed, 1).otherwise(0)).alias("size_bytes")
    )
    gone = inv.filter(F.col("doc_id") % 29 == 0).select("doc_id", F.concat("rel_path", F.lit(".old")).alias("rel_path"), "sha256", "size_bytes")
    return old.unionByName(gone)


OLD = """old AS (SELECT doc_id, rel_path, CASE WHEN doc_id % 13 = 0 THEN sha256(sha256 || 'x') ELSE sha256 END AS sha256,
 size_bytes + CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END AS size_bytes FROM inv WHERE doc_id % 17 <> 0
 UNION ALL SELECT doc_id, rel_path || '.old', sha256, size_bytes FROM inv WHERE doc_id % 29 = 0)"""


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled items with a score: group_id, item_no, label, score, and a 0/1 column by subtype."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    score = F.least("n_chars", F.lit(20000)).cast("double") / 20000.0
    flags = [((F.col("toxic") == 1) & (F.col("lang") == v)).cast("int").alias(v) for v in VARIANTS]
    return docs.select(F.col("source").alias("group_id"), F.col("doc_id").alias("item_no"), F.col("toxic").alias("label"), score.alias("score"), *flags, F.lit(0).alias("none"))


FRAME = """frame AS (SELECT d.source AS group_id, d.doc_id AS item_no, l.toxic AS label, d.lang,
 least(d.n_chars, 20000)::DOUBLE / 20000e0 AS score FROM documents d JOIN labels l USING (doc_id))"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curation of documents: duplicates, blank or oversized texts and missing labels reject; a
    conversation of the same number that is missing warns."""
    from quern.operators import curation

    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "source", "lang", "n_chars", F.sha2("text", 256).alias("sha256"), (F.trim("text") == "").alias("blank"))
    rows = curation.with_first_copy(rows, "sha256", "doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled")).distinct()
    talks = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.lit(True).alias("paired")).distinct()
    rows = rows.join(labels, "doc_id", "left").join(talks, "doc_id", "left")
    rejecting = curation.reasons(
        (F.col("first_copy") != F.col("doc_id"), F.concat(F.lit("duplicate-of:"), F.col("first_copy").cast("string"))),
        (F.col("n_chars") > 10000, F.concat(F.lit("wrong-dimensions:"), F.col("n_chars").cast("string"))),
        (F.col("blank"), "blank-or-constant"),
        (F.col("labelled").isNull(), "no-label-row"),
    )
    return curation.decide(rows, rejecting, curation.reasons((F.col("paired").isNull(), "missing-counterpart")))


DECISIONS = """firsts AS (SELECT sha256(text) AS sha256, min(doc_id) AS first_copy FROM documents GROUP BY 1),
decided AS (SELECT d.doc_id, d.source, d.lang, sha256(d.text) AS sha256,
 list_filter([CASE WHEN f.first_copy <> d.doc_id THEN 'duplicate-of:' || f.first_copy END,
  CASE WHEN d.n_chars > 10000 THEN 'wrong-dimensions:' || d.n_chars END,
  CASE WHEN trim(d.text, ' ') = '' THEN 'blank-or-constant' END,
  CASE WHEN NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 'no-label-row' END], lambda x: x IS NOT NULL) AS reasons,
 list_filter([CASE WHEN NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = d.doc_id) THEN 'missing-counterpart' END], lambda x: x IS NOT NULL) AS warnings
 FROM documents d JOIN firsts f ON f.sha256 = sha256(d.text)),
decisions AS (SELECT *, CASE WHEN len(reasons) > 0 THEN 'rejected' ELSE 'accepted' END AS decision FROM decided)"""


def long_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.operators import labels

    return labels.unpivot_labels(table(spark, sf_dir, "labels"), taxonomy(spark), ["doc_id"], "consensus", "labels.parquet")


LONG = """long AS (SELECT sha256(doc_id || '|labels.parquet|consensus')[1:16] AS annotation_id, doc_id, 'quality' AS label_code, quality AS value FROM labels
 UNION ALL SELECT sha256(doc_id || '|labels.parquet|consensus')[1:16], doc_id, 'toxic', toxic FROM labels)"""


def assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of documents as groups, split by whether they hold many toxic items."""
    from quern.operators import release

    return release.stratified_split(source_strata(spark, sf_dir), "source", "any_positive", SEED)


def source_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.operators import release

    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return release.strata(docs, "source", F.col("toxic") == 1, F.col("quality") == 1)


STRATA = """strata AS (SELECT source, count(*) AS n_items, count_if(toxic = 1)::BIGINT AS n_positive, max(toxic)::INTEGER AS any_positive, max(quality)::INTEGER AS any_other
 FROM documents JOIN labels USING (doc_id) GROUP BY source)"""


def split_sql(groups: str, group: str, stratum: str, seed: int = SEED) -> str:
    """SQL of the stratified split of a relation."""
    return f"""keyed AS (SELECT {group}, {stratum}, sha256('{seed}' || '|' || {stratum} || '|' || {group}) AS k FROM {groups}),
placed AS (SELECT {group}, {stratum}, row_number() OVER (PARTITION BY {stratum} ORDER BY k, {group}) AS place, count(*) OVER (PARTITION BY {stratum}) AS n FROM keyed),
assignment AS (SELECT {group}, {stratum}, CASE WHEN place <= round_even(n * 0.7e0, 0) THEN 'train' WHEN place <= round_even(n * (0.7e0 + 0.15e0), 0) THEN 'validation' ELSE 'test' END AS split FROM placed)"""


ASSIGNMENT = STRATA + ",\n" + split_sql("strata", "source", "any_positive")


def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as an audit log, numbered from 1."""
    return table(spark, sf_dir, "events").select((F.col("event_id") + 1).alias("seq"), "user_id", "event_type", "props")


def chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as an audit log with a hash chain."""
    from quern.operators import audit

    return audit.linked(logged(spark, sf_dir), payload(), "seq")


def payload():
    return F.concat_ws("|", F.col("seq").cast("string"), F.col("user_id").cast("string"), "event_type", "props")


def pixels() -> Column:
    """embeddings as gray pixels from 0 to 255, eight rows of eight. The 1 is a float, so that floats are
    added as floats, as other engines do; Spark would widen them beside a whole number."""
    return F.transform("embedding", lambda x: F.least(F.greatest(F.floor((x + F.lit(1).cast("float")) * 127.5), F.lit(0)), F.lit(255)))


PIXELS = "pixels AS (SELECT vec_id, label, list_transform(embedding, lambda x: least(greatest(floor((x + 1) * 127.5e0), 0), 255)::DOUBLE) AS p FROM embeddings)"


def pixel_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings (vec_id, label, p) with the split of their label."""
    from quern.operators import release

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", pixels().alias("p"))
    groups = rows.select("label", F.lit(0).alias("one")).distinct()
    return rows.join(F.broadcast(release.stratified_split(groups, "label", "one", SEED).select("label", "split")), "label")


def _png(gray: list[int], extra: list[tuple[bytes, bytes]]) -> bytes:
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    rows = b"".join(b"\0" + bytes(gray[k : k + 8]) for k in range(0, len(gray), 8))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 8, len(gray) // 8, 8, 0, 0, 0, 0)) + b"".join(chunk(*e) for e in extra) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def _jpeg(gray: list[int], extra: list[tuple[int, bytes]]) -> bytes:
    """The segments of a JPEG around bytes that stand for its pixels."""
    segment = lambda kind, body: struct.pack(">BBH", 0xFF, kind, len(body) + 2) + body
    return b"\xff\xd8" + segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0") + b"".join(segment(*e) for e in extra) + segment(0xDA, b"\1\1\0\0\x3f\0") + bytes(gray) + b"\xff\xd9"


def exif(tag: int, place: bool = False) -> bytes:
    """A TIFF with one tag, and one of a place in a directory of its own."""
    entries = [(tag, 3, 1, 7)] + ([(34853, 4, 1, 8 + 2 + 24 + 4)] if place else [])
    head = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(entries)) + b"".join(struct.pack("<HHII", *e) for e in entries) + struct.pack("<I", 0)
    return head + (struct.pack("<H", 1) + struct.pack("<HHII", 2, 2, 4, 0) + struct.pack("<I", 0) if place else b"")


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as image files (path, content): PNG and JPEG, every second one with marks, some cut short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, files = [], []
            for i, gray in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = i % 3 == 0
                if i % 4 < 2:
                    data = _png(gray, [(b"tEXt", b"Author\0Dr. Who")] + ([(b"eXIf", exif(271, True))] if place else []) if i % 4 else [])
                else:
                    data = _jpeg(gray, [(0xFE, b"taken at home"), (0xE1, b"Exif\0\0" + exif(306, place))] if i % 4 == 3 else [])
                names.append(f"img/{i}.{'png' if i % 4 < 2 else 'jpg'}")
                files.append(data[:20] if i % 50 == 7 else data)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(files, pa.binary())], names=["path", "content"])

    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform(pixels(), lambda p: p.cast("int")).alias("gray")).mapInArrow(run, "path string, content binary")


IMAGE_MARKS = """marks AS (SELECT 'img/' || vec_id || CASE WHEN vec_id % 4 < 2 THEN '.png' ELSE '.jpg' END AS path, unnest(
 CASE WHEN vec_id % 50 = 7 THEN [{'issue': 'unreadable', 'key': CASE WHEN vec_id % 4 < 2 THEN 'a chunk breaks off' ELSE 'the file breaks off' END}]
  WHEN vec_id % 4 = 1 THEN [{'issue': 'metadata-present', 'key': 'Author'}] || CASE WHEN vec_id % 3 = 0 THEN [{'issue': 'exif-present', 'key': 'tag:271'}, {'issue': 'exif-present', 'key': 'gps:2'}] ELSE [] END
  WHEN vec_id % 4 = 3 THEN [{'issue': 'metadata-present', 'key': 'comment'}, {'issue': 'exif-present', 'key': 'tag:306'}] || CASE WHEN vec_id % 3 = 0 THEN [{'issue': 'exif-present', 'key': 'gps:2'}] ELSE [] END
  ELSE [] END) AS m FROM embeddings)"""


#: A hash tree over leaves (pos, hash), and the root over each row's predecessors: level k's nodes, then for each
#: row the whole subtrees that its number's binary digits name, folded from the smallest.
TREE = """nodes AS (WITH RECURSIVE up AS (SELECT 0 AS level, pos AS idx, hash, (SELECT count(*) FROM leaves) AS width FROM leaves
  UNION ALL SELECT level + 1, idx // 2, CASE WHEN count(*) = 2 THEN sha256('node' || chr(10) || min_by(hash, idx) || chr(10) || max_by(hash, idx)) ELSE min(hash) END, (any_value(width) + 1) // 2 FROM up WHERE width > 1 GROUP BY level, idx // 2)
  SELECT * FROM up)"""
CHAIN = """leaves AS (SELECT event_id AS pos, sha256('leaf' || chr(10) || concat_ws('|', (event_id + 1)::VARCHAR, user_id::VARCHAR, event_type, props)) AS hash FROM events),
""" + TREE + """,
peaks AS (SELECT l.pos + s.k AS n, b.k AS level, (((l.pos + s.k) >> b.k) - 1)::BIGINT AS idx FROM leaves l, (SELECT unnest([1]) AS k) s, (SELECT unnest(range(40)) AS k) b WHERE ((l.pos + s.k) >> b.k) % 2 = 1),
roots AS (SELECT n, list_reduce(list(hash ORDER BY level), lambda acc, x: sha256('node' || chr(10) || x || chr(10) || acc)) AS root FROM peaks JOIN nodes USING (level, idx) GROUP BY n),
chained AS (SELECT n AS seq, coalesce(lag(root) OVER (ORDER BY n), repeat('0', 64)) AS prev_hash, root AS record_hash FROM roots)"""
