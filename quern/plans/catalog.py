"""Queries over the driver's tables for inventory, curation, privacy, labels and quality gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.functions.keys import _pads, replace_segment
from quern.functions.patterns import IN_NAMES, IN_TEXT
from quern.operators import curation, image_metadata as image_metadata_op, labels, manifest, pixels, privacy, quality_gates as qc, similarity
from quern.plans import bindings as b
from quern.plans.bindings import DECISIONS, INV, LONG, OLD, SALT, TAXONOMY_SQL, split_sql, table

QUERIES = {}
ORACLES = {}
ROUND6 = "floor(({}) * 1e6 + 0.5) / 1e6"
#: From eight places to four: (place, place before, weight).
SMALL_WEIGHTS = ", ".join(f"({y}, {i}, {w!r}::DOUBLE)" for y, row in enumerate(pixels.weights(8, 4)) for i, w in enumerate(row))


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"""WITH {INV} SELECT rel_path,
 CASE WHEN rel_path LIKE 'meta/%' THEN 'metadata' WHEN rel_path LIKE '%\\_att%' ESCAPE '\\' THEN 'attachment' ELSE 'item' END AS kind,
 CASE WHEN rel_path NOT LIKE 'meta/%' THEN source END AS group_id, CASE WHEN rel_path NOT LIKE 'meta/%' THEN lang END AS variant,
 CASE WHEN rel_path NOT LIKE 'meta/%' THEN doc_id::VARCHAR END AS item_no, sha256, size_bytes FROM inv""")
def manifest_inventory(spark: SparkSession, d: str) -> DataFrame:
    """SRC-01..03: path classification, digest and size of every file."""
    cols = manifest.classify(F.col("rel_path"), "items", b.VARIANTS, "_att")
    return b.inventory(spark, d).select("rel_path", *[(c.cast("string") if n == "item_no" else c).alias(n) for n, c in cols.items()], "sha256", "size_bytes")


@query(f"""WITH {INV}, {OLD} SELECT coalesce(i.rel_path, o.rel_path) AS rel_path,
 CASE WHEN o.rel_path IS NULL THEN 'new' WHEN i.rel_path IS NULL THEN 'missing' WHEN i.sha256 = o.sha256 AND i.size_bytes = o.size_bytes THEN 'unchanged' ELSE 'updated' END AS action,
 coalesce(i.sha256, o.sha256) AS sha256, coalesce(i.size_bytes, o.size_bytes)::BIGINT AS size_bytes FROM inv i FULL JOIN old o ON i.rel_path = o.rel_path""")
def manifest_upsert_status(spark, d):
    """SNK-01, JN-15: merge of a scan into the snapshot."""
    inv = b.inventory(spark, d)
    return manifest.merge_scan(b.altered(inv), inv)


@query(f"""WITH {INV}, {OLD} SELECT coalesce(i.rel_path, o.rel_path) AS rel_path,
 CASE WHEN o.rel_path IS NULL THEN 'extra' WHEN i.rel_path IS NULL THEN 'missing' WHEN i.sha256 = o.sha256 THEN 'verified' ELSE 'mismatched' END AS status FROM inv i FULL JOIN old o ON i.rel_path = o.rel_path""")
def checksum_reconcile(spark, d):
    """JN-16: listed against found digests."""
    inv = b.inventory(spark, d)
    return manifest.reconcile(b.altered(inv), inv)


@query("SELECT conv_id, count_if(role = 'user')::BIGINT AS n_user, count_if(role = 'assistant')::BIGINT AS n_assistant FROM conversations GROUP BY conv_id")
def raw_census(spark, d):
    """SRC-04: rows of each group by variant."""
    return manifest.census(table(spark, d, "conversations"), "conv_id", "role", ["user", "assistant"])


@query("""SELECT count(*) AS n_rows, count(DISTINCT conv_id) AS n_groups, min(n)::BIGINT AS least, max(n)::BIGINT AS most, floor(sum(n) / count(DISTINCT conv_id) * 1e4 + 0.5) / 1e4 AS mean
 FROM (SELECT conv_id, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) t JOIN (SELECT 1) ON true""".replace("sum(n) / count(DISTINCT conv_id)", "count(*)::DOUBLE / count(DISTINCT conv_id)"))
def census_report(spark, d):
    """AGG-20: totals and the spread of group sizes."""
    per = table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_groups"), F.min("n").alias("least"), F.max("n").alias("most"), (F.floor(F.sum("n").cast("double") / F.count("*") * 1e4 + 0.5) / 1e4).alias("mean"))


@query("""WITH c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS first_copy, count(*) OVER (PARTITION BY sha256(text)) AS copies FROM documents) SELECT * FROM c WHERE doc_id <> first_copy""")
def duplicate_of_first(spark, d):
    """WIN-02: later copies with the first of their digest."""
    rows = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return curation.with_first_copy(rows, "sha256", "doc_id").filter("doc_id <> first_copy").select("doc_id", "first_copy", "copies")


@query(f"WITH {DECISIONS} SELECT doc_id, decision, array_to_string(reasons, '; ') AS reasons, array_to_string(warnings, '; ') AS warnings FROM decisions")
def curation_decisions(spark, d):
    """CUR-01, CUR-02, CUR-05: accept or reject, with all reasons in order."""
    return b.decisions(spark, d).select("doc_id", "decision", F.array_join("reasons", "; ").alias("reasons"), F.array_join("warnings", "; ").alias("warnings"))


@query(f"""WITH {INV}, {OLD} SELECT i.rel_path, CASE WHEN o.sha256 = i.sha256 THEN 'skipped' ELSE 'processed' END AS action FROM inv i LEFT JOIN old o ON i.rel_path = o.rel_path""")
def curation_incremental(spark, d):
    """CUR-03: rows whose content is that of the previous run are skipped."""
    inv = b.inventory(spark, d)
    return curation.to_process(inv, b.altered(inv), "rel_path").select("rel_path", "action")


@query(f"""WITH {DECISIONS} SELECT decision, 'all' AS reason, count(*) AS n FROM decisions GROUP BY decision
 UNION ALL SELECT decision, split_part(r, ':', 1), count(*) FROM (SELECT decision, unnest(reasons) AS r FROM decisions) GROUP BY ALL""")
def curation_state(spark, d):
    """CUR-04, AGG-01: counts by decision and reason."""
    return curation.state(b.decisions(spark, d))


_IN, _OUT = _pads(SALT)
HMAC = f"sha256(unhex('{_OUT}') || unhex(sha256(unhex('{_IN}') || encode({{}}::VARCHAR))))"
MAP = f"map AS (SELECT DISTINCT c_custkey, 'PAT-' || {HMAC.format('c_custkey')}[1:12] AS pseudonym FROM customer WHERE c_custkey % 10 <> 0)"


@query(f"SELECT DISTINCT c_custkey, 'PAT-' || {HMAC.format('c_custkey')}[1:12] AS pseudonym FROM customer")
def pseudonym_map(spark, d):
    """FN-02, PRV-02: keyed tokens of every identifier."""
    return privacy.pseudonym_map(table(spark, d, "customer"), "c_custkey", SALT)


@query(f"WITH {MAP} SELECT coalesce(pseudonym, 'PAT-UNKNOWN') AS patient, o_orderkey, o_totalprice FROM orders LEFT JOIN map ON o_custkey = c_custkey")
def pseudonymized_export(spark, d):
    """PRV-08, FLT-08, JN-17: the pseudonym takes the identifier's place."""
    tokens = privacy.pseudonym_map(table(spark, d, "customer").filter("c_custkey % 10 <> 0"), "c_custkey", SALT).withColumnRenamed("c_custkey", "o_custkey")
    return privacy.pseudonymize(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), tokens, "o_custkey")


def _pattern_sql(p: str) -> str:
    return p.replace("'", "''")


PHI = "phi AS (" + " UNION ALL ".join(f"SELECT doc_id, 'possible-{k}' AS issue, regexp_extract(text, '{_pattern_sql(p)}', 0)[1:60] AS match FROM documents WHERE regexp_matches(text, '{_pattern_sql(p)}')" for k, p in IN_TEXT.items()) + ")"


@query(f"WITH {PHI} SELECT doc_id, 'text' AS \"column\", issue, match FROM phi")
def phi_scan(spark, d):
    """PRV-06, FN-12: identifiers in free text."""
    return privacy.scan_text(table(spark, d, "documents").select("doc_id", "text"), "doc_id", ["text"])


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
NAMES_SQL = "names AS (" + " UNION ALL ".join(f"SELECT '{t}' AS source, col AS \"column\", n FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME col VALUE n)" for t in TABLES) + ")"
TOKENS_SQL = "tokens AS (SELECT unnest([" + ",".join(f"'{t}'" for t in IN_NAMES) + "]) AS token)"


@query(f"WITH {NAMES_SQL}, {TOKENS_SQL} SELECT source, \"column\", 'name-implies:' || token AS issue, n AS n_values FROM names, tokens WHERE contains(regexp_replace(lower(\"column\"), '[^a-z]', '_', 'g'), token)")
def phi_columns(spark, d):
    """PRV-05, FN-11: columns of all tables whose names imply identifiers, and how many values they hold."""
    return privacy.scan_schemas({t: table(spark, d, t) for t in TABLES})


@query("SELECT c_custkey, c_acctbal / 100e0 AS value, 'age-over-89' AS issue FROM customer WHERE c_acctbal / 100e0 > 89")
def safe_harbor_rule(spark, d):
    """PRV-07, FN-16: ages above the limit."""
    rows = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") / 100.0).alias("age"))
    return privacy.over_age(rows, "c_custkey", "age")


EXPORT = """export AS (SELECT o_custkey AS id, lpad(o_custkey::VARCHAR, 8, '0') AS padded, o_custkey::VARCHAR || '.0' AS decimals, o_orderkey::VARCHAR AS other,
 CASE WHEN o_orderkey % 4 = 0 THEN o_custkey::VARCHAR ELSE 'x' END AS mixed FROM orders)"""
NORM = "regexp_replace(regexp_replace({}, '^(\\d+)\\.0+$', '\\1'), '^0+(\\d)', '\\1')"


@query(f"WITH {EXPORT}, long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count_if({NORM.format(c)} = id::VARCHAR)::BIGINT AS aligned_rows, count(*) AS n FROM export" for c in ("padded", "decimals", "other", "mixed")) + """)
 SELECT "column", aligned_rows, floor(aligned_rows::DOUBLE / n * 1e6 + 0.5) / 1e6 AS fraction, aligned_rows::DOUBLE / n > 0.2e0 AS leaks FROM long""")
def id_leak_fraction(spark, d):
    """PRV-09, AGG-22: columns that give their own row's identifier."""
    return privacy.leak_fractions(export(spark, d), "id", ["padded", "decimals", "other", "mixed"]).withColumn("fraction", F.floor(F.col("fraction") * 1e6 + 0.5) / 1e6)


def export(spark, d):
    key = F.col("o_custkey").cast("string")
    return table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.lpad(key, 8, "0").alias("padded"), F.concat(key, F.lit(".0")).alias("decimals"), F.col("o_orderkey").cast("string").alias("other"), F.when(F.col("o_orderkey") % 4 == 0, key).otherwise("x").alias("mixed"))


@query("SELECT c_custkey, c_acctbal AS value, 'age-over-89' AS issue FROM customer WHERE c_acctbal > 89")
def safe_harbor_column(spark, d):
    """FLT-07: the rule on the column whose name begins in some way, in any case."""
    rows = table(spark, d, "customer")
    return privacy.over_age(rows, privacy.column_like(rows, name="C_CUSTKEY"), privacy.column_like(rows, prefix="C_Acct"))


@query(f"WITH {b.PIXELS} SELECT vec_id, list_min(p) AS min, list_max(p) AS max, floor(list_avg(p) * 100e0 + 0.5) / 100e0 AS mean, floor(list_stddev_pop(p) * 100e0 + 0.5) / 100e0 AS std FROM pixels")
def pixel_statistics(spark, d):
    """AGG-19: the least, largest and mean pixel of every image, and their deviation."""
    return pixels.statistics(table(spark, d, "embeddings").select("vec_id", b.pixels().alias("p")), "vec_id", "p")


@query(f"""WITH {b.PIXELS}, groups AS (SELECT DISTINCT label, 0 AS one FROM embeddings), {split_sql('groups', 'label', 'one')},
 turned AS (SELECT vec_id, split, CASE WHEN split = 'train' AND sha256('{b.SEED}|' || vec_id)[1:1] < '8' THEN list_transform(range(64), lambda k: p[(k - k % 8 + 7 - k % 8 + 1)::BIGINT]) ELSE p END AS p FROM pixels JOIN assignment USING (label))
 SELECT vec_id, split, list_aggregate(list_transform(p, lambda x: x::BIGINT::VARCHAR), 'string_agg', ',') AS pixels FROM turned""")
def pixel_augmented(spark, d):
    """TRN-03: every image as a model sees it, half of the train images flipped."""
    rows = pixels.augmented(b.pixel_split(spark, d), "vec_id", "p", 8, b.SEED)
    return rows.select("vec_id", "split", F.array_join(F.transform("p", lambda x: x.cast("long").cast("string")), ",").alias("pixels"))


@query(f"""WITH {b.PIXELS}, masks AS (SELECT vec_id, list_transform(p, lambda x: CASE WHEN x > 128 THEN 255 ELSE 0 END) AS m FROM pixels)
 SELECT 'mask/' || vec_id AS path, len(list_filter(m, lambda x: x > 0)) AS n_white, sha256(from_hex(list_aggregate(list_transform(m, lambda x: CASE WHEN x > 0 THEN 'FF' ELSE '00' END), 'string_agg', ''))) AS pixels_sha256 FROM masks""")
def normalized_masks(spark, d):
    """SNK-05, FN-25: every image as a mask of 0 and 255, packed as a PNG."""
    from quern.operators import imaging

    data = F.unhex(F.array_join(F.transform(b.pixels(), lambda p: F.lpad(F.hex(p.cast("long")), 2, "0")), ""))
    size = F.lit(8)
    images = table(spark, d, "embeddings").select(F.concat(F.lit("mask/"), F.col("vec_id").cast("string")).alias("path"), size.alias("width"), size.alias("height"), F.lit(1).alias("channels"), data.alias("data"))
    return imaging.normalised_masks(images).select("path", "n_white", "pixels_sha256")


@query(f"WITH {b.IMAGE_MARKS} SELECT path, m.issue AS issue, m.key AS key FROM marks")
def image_metadata(spark, d):
    """PRV-04: tags, comments and texts that image files hold beside their pixels."""
    return image_metadata_op.scan(b.image_files(spark, d))


@query(f"WITH {b.PIXELS}, groups AS (SELECT DISTINCT label, 0 AS one FROM embeddings), {split_sql('groups', 'label', 'one')}, flat AS (SELECT unnest(p) AS x FROM pixels JOIN assignment USING (label) WHERE split = 'train') SELECT count(x) AS n, {ROUND6.format('avg(x)')} AS mean, {ROUND6.format('stddev_pop(x)')} AS std FROM flat")
def pixel_moments(spark, d):
    """AGG-18: mean and deviation of all pixels of the train split."""
    found = pixels.moments(b.pixel_split(spark, d).filter("split = 'train'"), "p")
    return found.select("n", *[(F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c) for c in ("mean", "std")])


@query(f"""WITH {b.PIXELS}, groups AS (SELECT DISTINCT label, 0 AS one FROM embeddings), {split_sql('groups', 'label', 'one')},
 stats AS (SELECT avg(x) AS mean, stddev_pop(x) AS std FROM (SELECT unnest(p) AS x FROM pixels JOIN assignment USING (label) WHERE split = 'train')),
 cells AS (SELECT vec_id, label, y, x, sum(p[(i * 8 + j + 1)::BIGINT] * r.w * q.w) AS v FROM pixels, (VALUES {SMALL_WEIGHTS}) AS r(y, i, w), (VALUES {SMALL_WEIGHTS}) AS q(x, j, w) GROUP BY ALL)
 SELECT vec_id, split, {ROUND6.format('min((v - mean) / (std + 1e-8))')} AS low, {ROUND6.format('max((v - mean) / (std + 1e-8))')} AS high, {ROUND6.format('sum((v - mean) / (std + 1e-8) * (y * 4 + x + 1))')} AS weighed FROM cells, stats JOIN assignment ON assignment.label = cells.label GROUP BY vec_id, split""")
def pixel_standardized(spark, d):
    """FN-27: every image at half its size, in standard scores of the train split's pixels."""
    rows = b.pixel_split(spark, d)
    stats = pixels.moments(rows.filter("split = 'train'"), "p").select("mean", "std")
    small = rows.select("vec_id", "split", pixels.resampled(F.col("p"), 8, 8, 4, 4).alias("s")).crossJoin(F.broadcast(stats))
    z = small.select("vec_id", "split", pixels.standard_scores(F.col("s"), F.col("mean"), F.col("std")).alias("z"))
    weighed = F.aggregate(F.transform("z", lambda v, k: v * (k + 1)), F.lit(0.0), lambda s, v: s + v)
    at6 = lambda c: F.floor(c * 1e6 + 0.5) / 1e6
    return z.select("vec_id", "split", at6(F.array_min("z")).alias("low"), at6(F.array_max("z")).alias("high"), at6(weighed).alias("weighed"))


@query(f"""WITH {PHI} SELECT "check", n_findings, CASE WHEN n_findings = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM (
 SELECT 'identifier-columns' AS "check", count(*) AS n_findings FROM ({ORACLES['phi_columns']})
 UNION ALL SELECT 'free-text-identifiers', count(*) FROM phi
 UNION ALL SELECT 'age-over-89', count(*) FROM customer WHERE c_acctbal / 100e0 > 89
 UNION ALL SELECT 'image-metadata', count(*) FROM ({ORACLES['image_metadata']})
 UNION ALL SELECT 'no-real-ids-in-exports', count(*) FROM ({ORACLES['id_leak_fraction']}) WHERE leaks)""")
def privacy_gate(spark, d):
    """PRV-10: the checks and whether they pass."""
    leaking = id_leak_fraction(spark, d).filter("leaks")
    return privacy.gate({"identifier-columns": phi_columns(spark, d), "free-text-identifiers": phi_scan(spark, d), "age-over-89": safe_harbor_rule(spark, d), "image-metadata": image_metadata(spark, d), "no-real-ids-in-exports": leaking})


@query(f"WITH {LONG} SELECT annotation_id, doc_id, label_code, value, 'consensus' AS annotator, 'labels.parquet' AS source_file FROM long")
def labels_unpivot(spark, d):
    """LBL-01, LBL-04: wide labels to long rows with provenance."""
    return b.long_labels(spark, d)


@query(f"""WITH {LONG} SELECT annotation_id, doc_id, count(*) AS n_labels, coalesce(string_agg(CASE WHEN value = 1 THEN label_code END, ',' ORDER BY label_code), '') AS positive,
 coalesce(string_agg(CASE WHEN value = 1 AND label_code = 'quality' THEN label_code END, ',' ORDER BY label_code), '') AS main_positive, count_if(value = 1 AND label_code = 'quality') = 0 AS none_of_main FROM long GROUP BY ALL""")
def item_lookup(spark, d):
    """LBL-02, FN-31, JN-06: an annotation's labels, positives and derived none flag."""
    found = labels.lookup(b.long_labels(spark, d), b.taxonomy(spark), ["doc_id"], "main")
    return found.select("annotation_id", "doc_id", F.size("labels").cast("long").alias("n_labels"), F.array_join("positive", ",").alias("positive"), F.array_join("main_positive", ",").alias("main_positive"), "none_of_main")


@query(f"WITH {LONG}, {TAXONOMY_SQL} SELECT code, category, coalesce(sum(value), 0)::BIGINT AS positives, count(label_code) AS total FROM taxonomy LEFT JOIN long ON code = label_code GROUP BY ALL")
def label_distribution(spark, d):
    """LBL-03, JN-05, AGG-04: positives and totals of every code."""
    return labels.distribution(b.long_labels(spark, d), b.taxonomy(spark))


@query("""SELECT doc_id, coalesce(CASE WHEN l.toxic = 1 THEN 'curated/' || doc_id || '_att.txt' END, 'raw/' || source || '/' || doc_id || '_att.txt') AS mask_path FROM documents LEFT JOIN labels l USING (doc_id)""")
def mask_path_coalesce(spark, d):
    """JN-02: the curated path where there is one, else the raw one."""
    docs, lab = table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels")
    key = F.col("doc_id").cast("string")
    curated = F.when(F.col("toxic") == 1, F.concat(F.lit("curated/"), key, F.lit("_att.txt")))
    return docs.join(lab, "doc_id", "left").select("doc_id", F.coalesce(curated, F.concat(F.lit("raw/"), "source", F.lit("/"), key, F.lit("_att.txt"))).alias("mask_path"))


@query(f"""WITH {LONG}, pos AS (SELECT DISTINCT source FROM documents JOIN long USING (doc_id) WHERE label_code = 'toxic' AND value = 1)
 SELECT n.source, count(d.doc_id) AS n_items, coalesce(count_if(d.lang = 'en'), 0)::BIGINT AS n_en, coalesce(count_if(d.lang = 'de'), 0)::BIGINT AS n_de, n.source IN (SELECT source FROM pos) AS positive
 FROM (SELECT DISTINCT source FROM documents UNION ALL SELECT 'src-empty') n LEFT JOIN documents d ON n.source = d.source GROUP BY n.source""")
def group_overview(spark, d):
    """JN-03, JN-04, AGG-03: every group, also empty ones, with conditional counts and a flag."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    groups = docs.select("source").distinct().union(spark.createDataFrame([("src-empty",)], "source string"))
    positive = docs.join(b.long_labels(spark, d).filter("label_code = 'toxic' and value = 1"), "doc_id").select("source").distinct().withColumn("hit", F.lit(True))
    counts = docs.groupBy("source").agg(F.count("*").alias("n_items"), F.count_if(F.col("lang") == "en").alias("n_en"), F.count_if(F.col("lang") == "de").alias("n_de"))
    joined = groups.join(counts, "source", "left").join(positive, "source", "left").na.fill(0)
    return joined.select("source", "n_items", "n_en", "n_de", F.coalesce("hit", F.lit(False)).alias("positive"))


@query(f"""WITH {LONG} SELECT source, doc_id % 7 AS slot, coalesce(string_agg(DISTINCT CASE WHEN value = 1 THEN label_code END, ',' ORDER BY CASE WHEN value = 1 THEN label_code END), '') AS positive, max(doc_id)::BIGINT AS last_doc
 FROM documents JOIN long USING (doc_id) GROUP BY ALL""")
def group_items_positive(spark, d):
    """AGG-05: positive codes of an item over annotators, each once."""
    rows = table(spark, d, "documents").select("doc_id", "source").join(b.long_labels(spark, d), "doc_id")
    return rows.groupBy("source", (F.col("doc_id") % 7).alias("slot")).agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("value") == 1, F.col("label_code")))), ",").alias("positive"), F.max("doc_id").alias("last_doc"))


@query("SELECT doc_id, 'curated/' || CASE WHEN source = 'src1' THEN 'TOKEN' ELSE source END || '/' || doc_id || '.txt' AS path FROM documents")
def path_tokens(spark, d):
    """FN-09: a path segment is replaced only where it matches as a whole."""
    path = F.concat(F.lit("curated/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return table(spark, d, "documents").select("doc_id", replace_segment(path, F.lit("src1"), F.lit("TOKEN")).alias("path"))


WINDOWS = "windows AS (SELECT conv_id FROM conversations GROUP BY conv_id HAVING count_if(role = 'user') <> count_if(role = 'assistant'))"


@query(f"WITH {WINDOWS} SELECT 'slice-counts' AS \"check\", 'WARNING' AS severity, 'window-count-mismatch' AS issue, conv_id::VARCHAR AS key FROM windows")
def qc_window_counts(spark, d):
    """QC-01, AGG-02: groups whose variants differ in count."""
    return qc.count_mismatches(raw_census(spark, d), "conv_id", "n_user", "n_assistant")


ORPHANS = """orphans AS (SELECT 'label-without-image' AS issue, doc_id AS k FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 11 <> 0)
 UNION ALL SELECT 'image-without-label', doc_id FROM documents WHERE doc_id % 11 <> 0 AND doc_id NOT IN (SELECT doc_id FROM labels)
 UNION ALL SELECT 'mask-without-slice', page_id FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 11 <> 0))"""


@query(f"WITH {ORPHANS} SELECT 'orphans' AS \"check\", 'ERROR' AS severity, issue, k::VARCHAR AS key FROM orphans")
def qc_orphans(spark, d):
    """QC-02, JN-09: labels, items and attachments without their counterpart."""
    items = table(spark, d, "documents").filter("doc_id % 11 <> 0").select("doc_id")
    return qc.orphans(items, table(spark, d, "labels").select("doc_id"), table(spark, d, "pages").select(F.col("page_id").alias("doc_id")), "doc_id")


AGREEMENT = """masks AS (SELECT doc_id FROM labels WHERE (toxic = 1 AND doc_id % 5 <> 0) OR doc_id % 97 = 1),
agreement AS (SELECT 'mask-but-no-hemorrhage-label' AS issue, doc_id FROM masks WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
 UNION ALL SELECT 'hemorrhage-label-but-no-mask', doc_id FROM labels WHERE toxic = 1 AND doc_id NOT IN (SELECT doc_id FROM masks))"""


@query(f"WITH {AGREEMENT} SELECT 'mask-label-agreement' AS \"check\", 'ERROR' AS severity, issue, doc_id::VARCHAR AS key FROM agreement")
def qc_mask_label(spark, d):
    """QC-03, JN-10: attachments and positive labels must come together."""
    lab = table(spark, d, "labels")
    return qc.agreement(lab.filter("(toxic = 1 and doc_id % 5 <> 0) or doc_id % 97 = 1").select("doc_id"), lab.filter("toxic = 1").select("doc_id"), "doc_id")


COVERAGE = """coverage AS (SELECT DISTINCT 'images-without-demographics' AS issue, o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 19 <> 0)
 UNION ALL SELECT 'demographics-without-images', c_custkey FROM customer WHERE c_custkey % 19 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 23 <> 0))"""


@query(f"WITH {COVERAGE.replace('FROM orders WHERE o_custkey NOT IN', 'FROM orders WHERE o_custkey % 23 <> 0 AND o_custkey NOT IN')} SELECT 'demographics' AS \"check\", 'ERROR' AS severity, issue, k::VARCHAR AS key FROM coverage")
def qc_coverage(spark, d):
    """QC-04, JN-11: groups without a profile and profiles without a group."""
    items = table(spark, d, "orders").filter("o_custkey % 23 <> 0").select(F.col("o_custkey").alias("k"))
    return qc.coverage(items, table(spark, d, "customer").filter("c_custkey % 19 <> 0").select(F.col("c_custkey").alias("k")), "k")


@query("""SELECT 'demographics' AS "check", 'ERROR' AS severity, 'implausible-age' AS issue, c_custkey::VARCHAR AS key FROM customer WHERE c_acctbal / 50e0 < 0 OR c_acctbal / 50e0 > 120
 UNION ALL SELECT 'demographics', 'WARNING', 'paediatric-age-under-1-year', c_custkey::VARCHAR FROM customer WHERE c_acctbal / 50e0 >= 0 AND c_acctbal / 50e0 < 1
 UNION ALL SELECT DISTINCT 'demographics', 'ERROR', 'unexpected-gender-value', c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def qc_plausibility(spark, d):
    """QC-05, QC-06, SET-04: ages out of range and values outside the domain."""
    rows = table(spark, d, "customer").withColumn("age", F.col("c_acctbal") / 50.0)
    return qc.plausibility(rows, "c_custkey", "age").unionByName(qc.unexpected_values(rows, "c_mktsegment", ["BUILDING", "MACHINERY"]))


@query("""WITH m AS (SELECT source, max(quality) AS quality, max(toxic) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY source),
 s AS (SELECT source, (quality * (CASE WHEN length(source) = 5 THEN 1 ELSE 0 END))::INTEGER AS quality, toxic FROM m)
 SELECT source, 'quality' AS term, m.quality::INTEGER AS item_value, s.quality::INTEGER AS summary_value FROM m JOIN s USING (source) WHERE m.quality <> s.quality
 UNION ALL SELECT source, 'toxic', m.toxic::INTEGER, s.toxic::INTEGER FROM m JOIN s USING (source) WHERE m.toxic <> s.toxic""")
def qc_label_agreement(spark, d):
    """QC-07, JN-12, AGG-08: item labels against group summaries, by term."""
    items = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    summary = items.groupBy("source").agg((F.max("quality") * (F.length("source") == 5).cast("int")).alias("quality"), F.max("toxic").alias("toxic"))
    return qc.summary_disagreements(items, summary, "source", ["quality", "toxic"])


BITS = "bits AS (SELECT vec_id, label, embedding, list_sum([CASE WHEN embedding[i + 2] > embedding[i + 1] THEN 1::BIGINT << i ELSE 0 END for i in range(63)])::BIGINT AS bits FROM embeddings)"


@query(f"WITH {BITS} SELECT vec_id, bits FROM bits")
def dhash_bits(spark, d):
    """FN-23: adjacent-difference bits of each vector."""
    return table(spark, d, "embeddings").select("vec_id", similarity.difference_bits(F.col("embedding")).alias("bits"))


HAMMING = f"{BITS}, near AS (SELECT a.vec_id AS a, b.vec_id AS b, bit_count(xor(a.bits, b.bits))::INTEGER AS hamming FROM bits a JOIN bits b ON a.vec_id < b.vec_id AND a.label <> b.label WHERE bit_count(xor(a.bits, b.bits)) <= 16)"


def _near(spark, d):
    rows = table(spark, d, "embeddings").withColumn("bits", similarity.difference_bits(F.col("embedding")))
    return rows, similarity.near_pairs(rows, "vec_id", "label", "bits", 16)


@query(f"WITH {HAMMING} SELECT * FROM near")
def hamming_candidates(spark, d):
    """JN-14, FN-24: pairs of different groups within the radius."""
    return _near(spark, d)[1]


CONFIRMED = HAMMING + """, z AS (SELECT vec_id, list_transform(embedding, lambda x: (x::DOUBLE - m) / (s + 1e-8)) AS z FROM (SELECT vec_id, embedding, list_avg(embedding::DOUBLE[]) AS m, list_stddev_pop(embedding::DOUBLE[]) AS s FROM embeddings)),
confirmed AS (SELECT a, b, hamming, list_dot_product(za.z, zb.z) / 64 AS correlation FROM near JOIN z za ON za.vec_id = a JOIN z zb ON zb.vec_id = b WHERE list_dot_product(za.z, zb.z) / 64 >= 0.3e0)"""


@query(f"WITH {CONFIRMED} SELECT a, b, hamming, floor(correlation * 1e6 + 0.5) / 1e6 AS correlation FROM confirmed")
def leakage_confirmed(spark, d):
    """QC-08, FN-19, SRT-04: candidates confirmed by correlation."""
    rows, pairs = _near(spark, d)
    return similarity.confirm(pairs, rows, "vec_id", "embedding", 0.3).withColumn("correlation", F.floor(F.col("correlation") * 1e6 + 0.5) / 1e6)


@query("""WITH l AS (SELECT doc_id, sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'), ' ')) AS h FROM documents)
 SELECT min(doc_id) FILTER (doc_id % 2 = 0) AS doc_id, min(doc_id) FILTER (doc_id % 2 = 1) AS other_id, count_if(doc_id % 2 = 0)::BIGINT AS n_left, count_if(doc_id % 2 = 1)::BIGINT AS n_right FROM l GROUP BY h HAVING n_left > 0 AND n_right > 0""")
def leakage_text_exact(spark, d):
    """QC-08 on texts: equal texts on both sides of a split, with their counts."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return similarity.shared_texts(docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1").withColumnRenamed("doc_id", "other_id"), "doc_id", "other_id")


@query(f"WITH {HAMMING.replace('<= 16', '<= 2')} SELECT * FROM near")
def hamming_candidates_tight(spark, d):
    """JN-14 at the leakage gate's radius of 2 bits: an equi-join on bands."""
    rows = table(spark, d, "embeddings").withColumn("bits", similarity.difference_bits(F.col("embedding")))
    return similarity.near_pairs(rows, "vec_id", "label", "bits", 2)


@query(f"""WITH {CONFIRMED}, s AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
 SELECT (SELECT sum(n)::BIGINT FROM s) AS n_rows, (SELECT ((sum(n) * sum(n) - sum(n * n)) / 2)::BIGINT FROM s) AS n_compared, (SELECT count(*) FROM near) AS n_candidates,
 (SELECT count(*) FROM confirmed) AS n_confirmed, (SELECT floor(max(correlation) * 1e6 + 0.5) / 1e6 FROM confirmed) AS max_correlation""")
def leakage_statistics(spark, d):
    """QC-08: how many pairs were compared, near and confirmed, and the largest correlation."""
    rows, pairs = _near(spark, d)
    confirmed = similarity.confirm(pairs, rows, "vec_id", "embedding", 0.3)
    found = similarity.leakage_statistics(rows, pairs, confirmed, "label")
    return found.withColumn("max_correlation", F.floor(F.col("max_correlation") * 1e6 + 0.5) / 1e6)


@query(f"WITH {CONFIRMED} SELECT a, b, hamming, floor(correlation * 1e6 + 0.5) / 1e6 AS correlation FROM confirmed ORDER BY confirmed.correlation DESC, a, b LIMIT 10")
def leakage_top(spark, d):
    """SRT-04: the closest candidates, in the order of the unrounded correlation."""
    rows, pairs = _near(spark, d)
    top = similarity.confirm(pairs, rows, "vec_id", "embedding", 0.3).orderBy(F.desc("correlation"), "a", "b").limit(10)
    return top.withColumn("correlation", F.floor(F.col("correlation") * 1e6 + 0.5) / 1e6)


@query("""SELECT d.doc_id, d.lang, d.n_chars, coalesce(l.quality, -1)::INTEGER AS quality, coalesce(l.toxic, -1)::INTEGER AS toxic FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.source = 'src1'""")
def group_detail(spark, d):
    """API-03: one group's items with their labels (-1: none); an absent group gives no rows."""
    docs = table(spark, d, "documents").filter(F.col("source") == "src1").select("doc_id", "lang", "n_chars")
    return docs.join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", "lang", "n_chars", *[F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c) for c in ("quality", "toxic")])


CHECKS = ["slice-counts", "orphans", "mask-label-agreement", "demographics", "leakage"]


FOUND = [f'SELECT "check", severity FROM ({ORACLES[q]})' for q in ("qc_window_counts", "qc_orphans", "qc_mask_label", "qc_coverage", "qc_plausibility")]
FOUND += [f"SELECT 'demographics', 'ERROR' FROM ({ORACLES['qc_label_agreement']})", f"SELECT 'leakage', 'ERROR' FROM ({ORACLES['leakage_confirmed']})"]


@query(f"""WITH f AS ({" UNION ALL ".join(FOUND)}),
 t AS (SELECT c."check", count_if(severity = 'ERROR')::BIGINT AS errors, count_if(severity = 'WARNING')::BIGINT AS warnings FROM (SELECT unnest({CHECKS}) AS "check") c LEFT JOIN f ON c."check" = f."check" GROUP BY ALL)
 SELECT "check", errors, warnings, CASE WHEN errors > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'WARN' ELSE 'PASS' END AS result FROM t""")
def qc_gate(spark, d):
    """QC-09: errors and warnings of every check."""
    findings = qc_window_counts(spark, d).unionByName(qc_orphans(spark, d)).unionByName(qc_mask_label(spark, d))
    findings = findings.unionByName(qc_coverage(spark, d)).unionByName(qc_plausibility(spark, d))
    findings = findings.unionByName(qc.finding(qc_label_agreement(spark, d), "demographics", qc.ERROR, "patient-vs-slice-label-disagreement", F.concat_ws("/", "source", "term")))
    findings = findings.unionByName(qc.finding(leakage_confirmed(spark, d), "leakage", qc.ERROR, "cross-patient-near-duplicate", F.concat_ws("/", "a", "b")))
    return qc.report(findings, CHECKS)
