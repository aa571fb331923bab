"""Queries over the driver's tables for releases, metrics, evaluation, active learning and audit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.functions.keys import pseudonym, rounded
from quern.functions.storage import delete_at_end, materialize, shared_dir
from quern.operators import active, audit, evaluation, experiments, metrics, release
from quern.plans import bindings as b
from quern.plans.bindings import ASSIGNMENT, CHAIN, DECISIONS, FRAME, INV, OLD, SALT, SEED, STRATA, TREE, split_sql, table
from quern.plans.catalog import HMAC
from quern.sources import derived, keyed

QUERIES = {}
ORACLES = {}
THRESHOLD = 0.1


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(x: str) -> str:
    return f"floor(({x}) * 1e6 + 0.5) / 1e6"


def at6(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles rounded by the formula that the SQL repeats."""
    return df.withColumns({c: rounded(F.col(c), 6) for c in columns})


@query(f"WITH {STRATA} SELECT * FROM strata")
def group_strata(spark: SparkSession, d: str) -> DataFrame:
    """AGG-06: items, positives and flags of each group."""
    return b.source_strata(spark, d)


CUSTOMERS = "groups AS (SELECT o_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)::INTEGER AS urgent FROM orders GROUP BY o_custkey)"


def _customers(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("urgent"))


@query(f"WITH {CUSTOMERS}, {split_sql('groups', 'o_custkey', 'urgent')} SELECT * FROM assignment")
def stratified_split(spark, d):
    """REL-01, WIN-04, FN-03: every group in one split, ratios within strata."""
    return release.stratified_split(_customers(spark, d), "o_custkey", "urgent", SEED)


@query(f"WITH {CUSTOMERS}, {split_sql('groups', 'o_custkey', 'urgent')}, moved AS (SELECT o_custkey, split FROM assignment UNION SELECT o_custkey, 'test' FROM assignment WHERE o_custkey % 100 = 0) SELECT o_custkey, count(DISTINCT split) AS n_splits FROM moved GROUP BY 1 HAVING count(DISTINCT split) > 1")
def split_overlap(spark, d):
    """REL-02, AGG-23: groups in more than one split, on an assignment with some moved."""
    split = stratified_split(spark, d).select("o_custkey", "split")
    moved = split.filter("o_custkey % 100 = 0").withColumn("split", F.lit("test"))
    return release.overlaps(split.union(moved), "o_custkey")


INDEX = f"""{DECISIONS}, {ASSIGNMENT}, rel AS (SELECT 'PAT-' || {HMAC.format('d.source')}[1:12] AS patient, a.split, d.lang AS variant, d.doc_id,
 'PAT-' || {HMAC.format('d.source')}[1:12] || '/' || d.lang || '/' || d.doc_id || '.txt' AS path, d.sha256, l.quality, l.toxic
 FROM decisions d JOIN assignment a ON a.source = d.source LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE d.decision = 'accepted' AND d.doc_id % 17 <> 0)"""


def _index(spark, d):
    decided = b.decisions(spark, d).withColumn("rel_path", F.col("doc_id").cast("string"))
    status = F.when(F.col("doc_id") % 17 == 0, "missing").otherwise("curated")
    files = decided.select("rel_path", "doc_id", "source", F.col("lang").alias("variant"), "sha256", status.alias("status"))
    tokens = decided.select("source").distinct().withColumn("pseudonym", pseudonym(F.col("source"), SALT))
    return release.index(files, decided, table(spark, d, "labels"), b.assignment(spark, d), tokens, "source", "doc_id")


@query(f"WITH {INDEX} SELECT patient, split, variant, doc_id, path, sha256, quality::INTEGER AS quality, toxic::INTEGER AS toxic FROM rel")
def release_index(spark, d):
    """REL-03, JN-01, JN-08, FN-10: accepted files with split, pseudonymous path and labels."""
    return _index(spark, d).withColumns({"quality": F.col("quality").cast("int"), "toxic": F.col("toxic").cast("int")})


@query(f"WITH {INDEX} SELECT patient, split, variant, doc_id, path FROM rel WHERE variant = 'en' AND split IN ('train', 'test') AND contains(lower(path), '/en/1')")
def release_select(spark, d):
    """FLT-03, FLT-04: rows of one variant and two splits, with the conditions that are given."""
    found = release.select(_index(spark, d), text="/EN/1", text_columns=("path",), variant="en", split=["train", "test"], patient=None)
    return found.select("patient", "split", "variant", "doc_id", "path")


@query(f"""WITH {INDEX}, s AS (SELECT unnest(['train', 'validation', 'test']) AS split),
 g AS (SELECT split, count(*) AS n_groups, sum(any_positive)::BIGINT AS n_positive_groups FROM assignment GROUP BY split),
 i AS (SELECT split, count(*) AS n_items, count_if(toxic = 1)::BIGINT AS n_positive FROM rel GROUP BY split)
 SELECT s.split, coalesce(n_groups, 0) AS n_groups, coalesce(n_positive_groups, 0) AS n_positive_groups, coalesce(n_items, 0) AS n_items, coalesce(n_positive, 0) AS n_positive,
 {r6("CASE WHEN coalesce(n_items, 0) = 0 THEN 0e0 ELSE n_positive::DOUBLE / n_items END")} AS rate FROM s LEFT JOIN g USING (split) LEFT JOIN i USING (split)""")
def split_statistics(spark, d):
    """REL-04, AGG-07: all three splits, groups from the assignment and items from the index."""
    out = release.split_statistics(_index(spark, d), b.assignment(spark, d), b.source_strata(spark, d), "source", F.col("toxic") == 1)
    return at6(out, "rate")


@query(f"""WITH {INV}, {OLD} SELECT o.rel_path, CASE WHEN i.rel_path IS NULL THEN 'missing' ELSE 'content-changed' END AS issue FROM old o LEFT JOIN inv i ON i.rel_path = o.rel_path WHERE i.rel_path IS NULL OR i.sha256 <> o.sha256""")
def release_verify(spark, d):
    """REL-06: recorded against current content."""
    inv = b.inventory(spark, d)
    return release.verify(b.altered(inv), inv, key="rel_path")


@query(f"""WITH {INDEX}, tok AS (SELECT DISTINCT source, 'PAT-' || {HMAC.format('source')}[1:12] AS pseudonym FROM documents WHERE source <> 'src3'),
 cur AS (SELECT source || '/' || lang || '/' || doc_id || '.txt' AS rel_path, CASE WHEN doc_id % 13 = 0 THEN sha256(sha256(text) || 'x') ELSE sha256(text) END AS now FROM documents WHERE doc_id % 29 <> 0),
 j AS (SELECT rel.path, rel.sha256, tok.source, cur.now FROM rel LEFT JOIN tok ON tok.pseudonym = split_part(rel.path, '/', 1) LEFT JOIN cur ON cur.rel_path = tok.source || '/' || split_part(rel.path, '/', 2) || '/' || split_part(rel.path, '/', 3))
 SELECT path, CASE WHEN source IS NULL THEN 'unresolvable-pseudonym' WHEN now IS NULL THEN 'missing' ELSE 'content-changed' END AS issue FROM j WHERE source IS NULL OR now IS NULL OR now <> sha256""")
def release_references(spark, d):
    """REL-06, REL-08: pseudonymous paths resolved to curated files, some of them gone or changed."""
    docs = table(spark, d, "documents")
    tokens = docs.filter("source <> 'src3'").select(F.col("source").alias("identifier")).distinct().withColumn("pseudonym", pseudonym(F.col("identifier"), SALT))
    sha = F.sha2("text", 256)
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    curated = docs.filter("doc_id % 29 <> 0").select(path.alias("rel_path"), F.when(F.col("doc_id") % 13 == 0, F.sha2(F.concat(sha, F.lit("x")), 256)).otherwise(sha).alias("sha256"))
    return release.references(_index(spark, d), curated, tokens)


@query(f"""WITH {INV}, w AS (SELECT rel_path, unnest(list_distinct(regexp_split_to_array(rel_path, '[^A-Za-z0-9_]+'))) AS word FROM inv) SELECT 'rel_path' AS "column", source AS identifier, count(*) AS n_rows FROM w JOIN (SELECT DISTINCT source FROM documents) s ON s.source = w.word GROUP BY source""")
def release_leaks(spark, d):
    """REL-06, FN-15: real identifiers that stand as words in a release."""
    ids = table(spark, d, "documents").select("source").distinct()
    return release.leaked_ids(b.inventory(spark, d), ["rel_path"], ids, "source")


#: Words joined by punctuation: addresses, numbers, hosts.
JOINED = "[A-Za-z0-9]+(?:[-.@/][A-Za-z0-9]+)+"


@query(f"""WITH ids AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{JOINED}')) AS identifier FROM documents),
 near AS MATERIALIZED (SELECT identifier, text FROM ids JOIN documents ON contains(text, identifier))
 SELECT 'text' AS "column", identifier, count(*) AS n_rows FROM near WHERE regexp_matches(text, '(^|[^\\p{{L}}\\p{{N}}_])' || regexp_escape(identifier) || '($|[^\\p{{L}}\\p{{N}}_])') GROUP BY identifier""")
def identifier_hits(spark, d):
    """FN-15: identifiers with hyphens, dots and at signs, out of all texts, in all texts."""
    docs = table(spark, d, "documents").select("text")
    ids = docs.select(F.explode(F.regexp_extract_all("text", F.lit(f"({JOINED})"), 1)).alias("identifier"))
    return release.leaked_ids(docs, ["text"], ids, "identifier")


RANKED = f"{FRAME}, ranked AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS rk FROM frame)"
AUROC = "(sum(CASE WHEN label = 1 THEN rk ELSE 0 END) - count_if(label = 1) * (count_if(label = 1) + 1) / 2e0) / (count_if(label = 1) * count_if(label = 0))"


@query(f"WITH {RANKED} SELECT count_if(label = 1)::BIGINT AS n_pos, count_if(label = 0)::BIGINT AS n_neg, {r6(AUROC)} AS auroc FROM ranked")
def auroc(spark, d):
    """MET-01, WIN-01: tie-aware AUROC."""
    return at6(metrics.auroc(b.frame(spark, d)), "auroc")


def conf_sql(relation: str, threshold: str, by: str = "") -> str:
    return f"(SELECT {by} count_if(score >= {threshold} AND label = 1)::BIGINT AS tp, count_if(score >= {threshold} AND label = 0)::BIGINT AS fp, count_if(score < {threshold} AND label = 0)::BIGINT AS tn, count_if(score < {threshold} AND label = 1)::BIGINT AS fn FROM {relation})"


RATES = """tp, fp, tn, fn, tp + fp + tn + fn AS n, {p} AS prevalence, {a} AS accuracy, {pr} AS "precision", {re} AS recall, {sp} AS specificity, {ba} AS balanced_accuracy, {f1} AS f1""".format(
    p=r6("(tp + fn)::DOUBLE / (tp + fp + tn + fn)"), a=r6("(tp + tn)::DOUBLE / (tp + fp + tn + fn)"), pr=r6("CASE WHEN tp + fp = 0 THEN 0e0 ELSE tp::DOUBLE / (tp + fp) END"), re=r6("CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp::DOUBLE / (tp + fn) END"),
    sp=r6("CASE WHEN tn + fp = 0 THEN 0e0 ELSE tn::DOUBLE / (tn + fp) END"), ba=r6("(CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp::DOUBLE / (tp + fn) END + CASE WHEN tn + fp = 0 THEN 0e0 ELSE tn::DOUBLE / (tn + fp) END) / 2e0"),
    f1=r6("CASE WHEN 2 * tp + fp + fn = 0 THEN 0e0 ELSE (2 * tp)::DOUBLE / (2 * tp + fp + fn) END"),
)
RATE_COLUMNS = ("prevalence", "accuracy", "precision", "recall", "specificity", "balanced_accuracy", "f1")


@query(f"WITH {FRAME} SELECT {RATES} FROM {conf_sql('frame', '0.1e0')}")
def classification_metrics(spark, d):
    """MET-02, AGG-12, AGG-13: confusion counts and rates at a threshold."""
    return at6(evaluation.slice_report(b.frame(spark, d), THRESHOLD), *RATE_COLUMNS)


@query(f"WITH {FRAME}, g AS (SELECT label, CASE WHEN (SELECT avg(label) FROM frame) > 0.5e0 THEN 1e0 ELSE 0e0 END AS score FROM frame) SELECT {RATES}, 0.5e0 AS auroc FROM {conf_sql('g', '0.5e0')}")
def trivial_baseline(spark, d):
    """MET-03: the majority guess."""
    return at6(metrics.trivial_baseline(b.frame(spark, d)), *RATE_COLUMNS)


@query(f"""WITH {FRAME}, c AS (SELECT DISTINCT score AS t FROM frame UNION SELECT 0e0 UNION SELECT 1e0), m AS (SELECT t, count_if(score >= t AND label = 1) AS tp, count_if(score >= t AND label = 0) AS fp, count_if(label = 1) AS p FROM c, frame GROUP BY t),
 f AS (SELECT t, CASE WHEN tp + fp + p = 0 THEN 0e0 ELSE (2 * tp)::DOUBLE / (tp + fp + p) END AS f1 FROM m) SELECT t AS threshold, {r6('f1')} AS f1 FROM f ORDER BY f.f1 DESC, t LIMIT 1""")
def best_threshold(spark, d):
    """MET-04: the lowest threshold of the highest F1."""
    return at6(metrics.best_threshold(b.frame(spark, d)), "f1")


#: As many as the evaluation's default.
RESAMPLES = 2000
BOOT = f"""{FRAME}, g AS (SELECT group_id, row_number() OVER (ORDER BY group_id) - 1 AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT group_id FROM frame)),
draws AS (SELECT r.i AS resample, ('0x' || sha256('{SEED}|' || r.i || '|' || p.i)[1:8])::BIGINT % (SELECT max(n) FROM g) AS rank FROM range({RESAMPLES}) r(i), range((SELECT max(n) FROM g)) p(i)),
weights AS (SELECT resample, group_id, count(*) AS w FROM draws JOIN g USING (rank) GROUP BY ALL),
cells AS (SELECT resample, score, sum(CASE WHEN label = 1 THEN w ELSE 0 END) AS pos, sum(CASE WHEN label = 0 THEN w ELSE 0 END) AS neg FROM frame JOIN weights USING (group_id) GROUP BY ALL),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY resample ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM cells),
boot AS (SELECT resample, sum(pos * (2 * before + neg))::DOUBLE / (2e0 * sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS auroc FROM cum GROUP BY resample HAVING sum(pos) > 0 AND sum(neg) > 0)"""


@query(f"WITH {BOOT} SELECT count(*) AS n_resamples, {r6('quantile_cont(auroc, 0.025)')} AS ci_low, {r6('quantile_cont(auroc, 0.975)')} AS ci_high, count(*) = 0 AS undefined FROM boot")
def bootstrap_auroc_ci(spark, d):
    """MET-05, FN-21: interval from resampled groups."""
    return at6(metrics.interval(metrics.bootstrap_auroc(b.frame(spark, d), "group_id", RESAMPLES, SEED), "auroc"), "ci_low", "ci_high")


@query(f"""WITH {FRAME}, s AS (SELECT unnest(['en', 'de', 'fr', 'es', 'none']) AS subtype), x AS (SELECT subtype, coalesce(count_if(label = 1 AND lang = subtype), 0)::BIGINT AS support, coalesce(count_if(label = 1 AND lang = subtype AND score >= 0.1e0), 0)::BIGINT AS detected FROM s, frame GROUP BY subtype)
 SELECT subtype, support, detected, CASE WHEN support > 0 THEN {r6('detected::DOUBLE / support')} END AS recall, support >= 2 AS measurable FROM x""")
def subtype_recall(spark, d):
    """EVL-01, AGG-14: recall by subtype, also of one without support."""
    return at6(evaluation.subtype_recall(b.frame(spark, d), [*b.VARIANTS, "none"], THRESHOLD), "recall")


@query(f"""WITH {FRAME} SELECT 'false_negative' AS kind, row_number() OVER (ORDER BY score, group_id, item_no) AS place, group_id, item_no, score FROM frame WHERE label = 1 AND score < 0.1e0 QUALIFY place <= 8
 UNION ALL SELECT 'false_positive', row_number() OVER (ORDER BY score DESC, group_id, item_no) AS place, group_id, item_no, score FROM frame WHERE label = 0 AND score >= 0.1e0 QUALIFY place <= 8""")
def hardest_cases(spark, d):
    """EVL-02, WIN-06, SRT-02: the worst misses and false alarms."""
    return evaluation.hardest_cases(b.frame(spark, d), THRESHOLD, 8, "group_id", "item_no")


@query(f"""WITH {FRAME} SELECT group_id, count(*) AS n_items, count_if(label = 1)::BIGINT AS n_positive, count_if(label = 1 AND score >= 0.1e0)::BIGINT AS detected,
 {r6('CASE WHEN count_if(label = 1) > 0 THEN count_if(label = 1 AND score >= 0.1e0)::DOUBLE / count_if(label = 1) END')} AS detection_rate, {r6('median(score)')} AS median_score, {r6('count_if(label = 1)::DOUBLE / (SELECT count_if(label = 1) FROM frame)')} AS share_of_positives FROM frame GROUP BY group_id""")
def group_contributions(spark, d):
    """EVL-03, AGG-11: what each group holds and how much of it is found."""
    return at6(evaluation.group_contributions(b.frame(spark, d), THRESHOLD, "group_id"), "detection_rate", "median_score", "share_of_positives")


LOGO = f"""{FRAME}, x AS (SELECT e.group_id, f.label, rank() OVER (PARTITION BY e.group_id ORDER BY f.score) + (count(*) OVER (PARTITION BY e.group_id, f.score) - 1) / 2e0 AS rk FROM (SELECT DISTINCT group_id FROM frame) e JOIN frame f ON f.group_id <> e.group_id),
a AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS rk FROM frame), full_ AS (SELECT {AUROC} AS v FROM a),
o AS (SELECT group_id, CASE WHEN count_if(label = 1) * count_if(label = 0) > 0 THEN {AUROC} END AS auroc FROM x GROUP BY group_id)"""


@query(f"WITH {LOGO} SELECT group_id, {r6('auroc')} AS auroc_without, {r6('auroc - v')} AS delta FROM o, full_")
def leave_one_group_out(spark, d):
    """EVL-04, WIN-07, SRT-03: AUROC without each group, in closed form."""
    return at6(evaluation.leave_one_group_out(b.frame(spark, d), "group_id"), "auroc_without", "delta")


@query(f"WITH {FRAME} SELECT group_id, max(label) AS label, max(score) AS score FROM frame GROUP BY group_id")
def group_aggregate_max(spark, d):
    """AGG-10: group score by maximum."""
    return evaluation.aggregate_groups(b.frame(spark, d), "group_id", "max")


TOPK = f"{FRAME}, r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, item_no) AS n FROM frame)"


@query(f"WITH {TOPK} SELECT group_id, max(label) AS label, {r6('avg(CASE WHEN n <= 3 THEN score END)')} AS score FROM r GROUP BY group_id")
def group_aggregate_topk(spark, d):
    """AGG-10: group score by the mean of the three highest."""
    return at6(evaluation.aggregate_groups(b.frame(spark, d), "group_id", "topk"), "score")


@query(f"""WITH {FRAME}, g AS (SELECT group_id, max(CASE WHEN label = 1 AND score >= 0.2e0 THEN 1 ELSE 0 END) AS label, max(score) AS score FROM frame GROUP BY group_id), k AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS rk FROM g),
 c AS (SELECT count_if(label = 1)::BIGINT AS n_pos, count_if(label = 0)::BIGINT AS n_neg FROM g) SELECT n_pos, n_neg, n_pos * n_neg AS comparable_pairs, CASE WHEN n_pos * n_neg > 0 THEN {r6('1e0 / (n_pos * n_neg)')} END AS auroc_granularity,
 (SELECT CASE WHEN count_if(label = 1) * count_if(label = 0) = 0 THEN 0.5e0 ELSE {r6(AUROC)} END FROM k) AS auroc FROM c""")
def group_level_report(spark, d):
    """EVL-05: comparable pairs, their granularity and the groups' AUROC."""
    rows = b.frame(spark, d).withColumn("label", ((F.col("label") == 1) & (F.col("score") >= 0.2)).cast("int"))
    groups = evaluation.aggregate_groups(rows, "group_id", "max")
    return at6(evaluation.granularity(groups).crossJoin(metrics.auroc(groups).select("auroc")), "auroc_granularity", "auroc")


SWEEP = f"{FRAME}, grid AS (SELECT i * 2.5e-2 AS threshold FROM range(41) t(i)), counts AS (SELECT threshold, count_if(score >= threshold AND label = 1)::BIGINT AS tp, count_if(score >= threshold AND label = 0)::BIGINT AS fp, count_if(score < threshold AND label = 0)::BIGINT AS tn, count_if(score < threshold AND label = 1)::BIGINT AS fn FROM grid, frame GROUP BY threshold)"


@query(f"WITH {SWEEP} SELECT threshold, {RATES} FROM counts")
def threshold_sweep(spark, d):
    """EVL-06, FN-20: counts and rates on the grid."""
    return at6(evaluation.threshold_sweep(b.frame(spark, d)), *RATE_COLUMNS)


@query(f"WITH {SWEEP} SELECT threshold, {RATES} FROM counts WHERE CASE WHEN tp + fn = 0 THEN 0e0 ELSE tp::DOUBLE / (tp + fn) END >= 0.9e0 ORDER BY threshold DESC LIMIT 1")
def operating_point(spark, d):
    """EVL-06: the strictest threshold that keeps the recall."""
    return at6(evaluation.operating_point(b.frame(spark, d)), *RATE_COLUMNS)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def join_cardinality(spark, d):
    """JN-07: keys that would multiply rows of a join."""
    return evaluation.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


ENTROPY = "CASE WHEN p IS NOT NULL THEN -(p * log2(p) + (1 - p) * log2(1 - p)) END"
RANKING = f"u AS (SELECT user_id, avg({ENTROPY}) AS uncertainty FROM (SELECT user_id, least(greatest(value / 500e0, 1e-12), 1 - 1e-12) AS p FROM events) GROUP BY user_id)"


def _ranking(spark, d):
    return active.group_uncertainty(table(spark, d, "events").withColumn("p", F.col("value") / 500.0), "user_id", "p")


@query(f"WITH {RANKING}, v AS (SELECT user_id, {r6('uncertainty')} AS uncertainty FROM u) SELECT *, row_number() OVER (ORDER BY uncertainty DESC, user_id) AS rank FROM v")
def entropy_rank(spark, d):
    """ACT-01, FN-17, WIN-05: mean entropy of each group, and its rank."""
    return active.ranking(at6(_ranking(spark, d), "uncertainty"), "user_id")


@query("SELECT d.doc_id, coalesce(l.quality, -1)::INTEGER AS quality, coalesce(l.toxic, -1)::INTEGER AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def checked_join(spark, d):
    """JN-07: a left join after the check that it can't multiply rows; -1 where there is no label."""
    docs, lab = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels")
    return evaluation.checked_left_join(docs, lab, ["doc_id"]).select("doc_id", *[F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c) for c in ("quality", "toxic")])


REPORT = ("n_pos", "n_neg", "auroc"), ("tp", "fp", "tn", "fn", *RATE_COLUMNS)


def _long_sql(name: str, section: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, '{c}' AS metric, \"{c}\"::DOUBLE AS value FROM ({ORACLES[name]})" for c in columns)


@query(" UNION ALL ".join([_long_sql("auroc", "ranking", REPORT[0]), _long_sql("classification_metrics", "threshold", REPORT[1]), _long_sql("trivial_baseline", "baseline", REPORT[1]), _long_sql("operating_point", "operating-point", ("threshold", *REPORT[1])), _long_sql("group_level_report", "groups", ("n_pos", "n_neg", "comparable_pairs", "auroc_granularity", "auroc"))]))
def evaluation_report(spark, d):
    """EVL-07: one long table (section, metric, value) of a run's whole evaluation."""
    return evaluation.report({
        "ranking": auroc(spark, d).select(*REPORT[0]),
        "threshold": classification_metrics(spark, d).select(*REPORT[1]),
        "baseline": trivial_baseline(spark, d).select(*REPORT[1]),
        "operating-point": operating_point(spark, d).select("threshold", *REPORT[1]),
        "groups": group_level_report(spark, d),
    })


@query(f"WITH {CHAIN} SELECT seq, record_hash FROM chained ORDER BY seq DESC LIMIT 25")
def audit_tail(spark, d):
    """SRT-05, API-09: the newest records of the log."""
    return audit.tail(b.chained(spark, d), 25).select("seq", "record_hash")


POOL = f"""flags AS (SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::INTEGER AS buys FROM events GROUP BY user_id),
pk AS (SELECT *, row_number() OVER (PARTITION BY buys ORDER BY sha256('{SEED}|' || buys || '|' || user_id), user_id) AS place, count(*) OVER (PARTITION BY buys) AS n FROM flags),
pool AS (SELECT user_id, buys, CASE WHEN place <= round_even(n * 0.4e0, 0) THEN 'labelled' ELSE 'unlabelled' END AS pool FROM pk)"""


def _pool(spark, d):
    flags = table(spark, d, "events").groupBy("user_id").agg(F.max((F.col("event_type") == "purchase").cast("int")).alias("buys"))
    return active.stratified_pool(flags, "user_id", "buys", 0.4, SEED)


@query(f"WITH {POOL} SELECT * FROM pool")
def pool_split(spark, d):
    """ACT-02: a stratified part of the groups is labelled."""
    return _pool(spark, d)


@query(f"WITH {POOL}, {RANKING} SELECT user_id FROM u JOIN pool USING (user_id) WHERE pool = 'unlabelled' ORDER BY {r6('uncertainty')} DESC, user_id LIMIT 12")
def select_uncertain(spark, d):
    """ACT-03, SRT-06: the most uncertain groups of the pool."""
    return active.select_uncertain(entropy_rank(spark, d), _pool(spark, d).filter("pool = 'unlabelled'"), "user_id", 12)


@query(f"WITH {POOL} SELECT user_id FROM pool WHERE pool = 'unlabelled' ORDER BY sha256('{SEED}|' || user_id), user_id LIMIT 12")
def select_random(spark, d):
    """ACT-03: as many at random."""
    return active.select_random(_pool(spark, d).filter("pool = 'unlabelled'"), "user_id", 12, SEED)


DERIVED = """rows AS (SELECT 'v1' AS version, split, o_custkey, o_orderkey FROM orders JOIN assignment USING (o_custkey)
  UNION ALL SELECT 'v1.1', split, o_custkey, o_orderkey FROM orders JOIN assignment USING (o_custkey) WHERE split <> 'train' OR o_custkey % 3 = 0),
 dealt AS (SELECT version, split, o_orderkey, ('0x' || sha256(o_orderkey::VARCHAR)[1:8])::BIGINT % 16 AS bucket FROM rows),
 parts AS (SELECT version, split, bucket::INTEGER AS bucket, count(*) AS n_rows, list_sort(list(o_orderkey)) AS held FROM dealt GROUP BY ALL)"""


@query(f"WITH {CUSTOMERS}, {split_sql('groups', 'o_custkey', 'urgent')}, {DERIVED} SELECT a.version, CASE WHEN a.version = 'v1.1' THEN 'v1' END AS derived_from, a.split, a.bucket, a.n_rows, count(b.version) > 1 AS shared FROM parts a JOIN parts b ON a.split = b.split AND a.bucket = b.bucket AND a.held = b.held GROUP BY ALL")
def derived_release(spark, d):
    """REL-07: a release of orders, one derived from it with fewer train groups, and which parts they share."""
    root = f"{shared_dir(spark)}/quern/releases-{uuid.uuid4().hex}"
    delete_at_end(spark, root)
    rows = table(spark, d, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("path"), "o_totalprice").join(stratified_split(spark, d).select("o_custkey", "split"), "o_custkey")
    derived.publish(rows, root, "v1")
    derived.derive(spark, root, "v1", "v1.1", _customers(spark, d).filter("o_custkey % 3 = 0"), "o_custkey")
    parts = derived.versions(spark, root)
    holders = parts.groupBy("digest").agg((F.count_distinct("version") > 1).alias("shared"))
    return parts.join(holders, "digest").select("version", "derived_from", "split", "bucket", "n_rows", "shared")


@query(f"""WITH {INV}, {OLD} SELECT coalesce(i.rel_path, o.rel_path) AS rel_path, coalesce(i.sha256, o.sha256) AS sha256, coalesce(i.size_bytes, o.size_bytes) AS size_bytes,
 CASE WHEN o.rel_path IS NULL THEN 't2' ELSE 't1' END AS first_seen, CASE WHEN i.rel_path IS NULL THEN 't1' ELSE 't2' END AS last_seen FROM inv i FULL JOIN old o ON i.rel_path = o.rel_path""")
def inventory_commits(spark, d):
    """SNK-01: two scans put into a table one after the other; each path with when it was first and last seen."""
    root = f"{shared_dir(spark)}/quern/inventory-{uuid.uuid4().hex}"
    delete_at_end(spark, root)
    inv = b.inventory(spark, d)
    keyed.upsert(b.altered(inv).select("rel_path", "sha256", "size_bytes"), root, "rel_path", stamp="t1")
    keyed.upsert(inv.select("rel_path", "sha256", "size_bytes"), root, "rel_path", stamp="t2")
    return keyed.read(spark, root, "rel_path string, sha256 string, size_bytes bigint")


@query(f"""WITH {CUSTOMERS}, {split_sql('groups', 'o_custkey', 'urgent')} SELECT a.split, count(*) AS n FROM orders o JOIN assignment a USING (o_custkey) WHERE a.split <> 'train' OR o.o_custkey % 3 = 0 GROUP BY a.split""")
def restrict_train(spark, d):
    """ACT-04, FLT-05: fewer train groups, the other splits whole."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey").join(stratified_split(spark, d).select("o_custkey", "split"), "o_custkey")
    chosen = _customers(spark, d).filter("o_custkey % 3 = 0")
    return release.restrict_train(rows, chosen, "o_custkey").groupBy("split").agg(F.count("*").alias("n"))


ARMS = "arms AS (SELECT user_id % 12 AS seed, event_type AS arm, avg(round(value * 100)::BIGINT) AS metric FROM events GROUP BY ALL)"


def _arms(spark, d):
    cents = F.round(F.col("value") * 100).cast("long")
    return table(spark, d, "events").groupBy((F.col("user_id") % 12).alias("seed"), F.col("event_type").alias("arm")).agg(F.avg(cents).alias("metric"))


def _experiment(spark, d):
    """embeddings as items of groups (40 by their number), split by group; label: an odd label."""
    rows = table(spark, d, "embeddings").select((F.col("vec_id") % 40).alias("group"), F.col("vec_id").alias("key"), F.col("embedding").alias("vector"), (F.col("label") % 2).alias("label"))
    groups = rows.groupBy("group").agg(F.max("label").alias("flag"))
    splits = release.stratified_split(groups, "group", "flag", SEED, 0.6, 0.1)
    return experiments.run(rows.join(splits.select("group", "split"), "group"), budget=4)


@query()
def experiment_arms(spark, d):
    """ACT-06, SNK-09: size and test AUROC of every seed, arm and round."""
    return at6(_experiment(spark, d)[0], "auroc")


@query()
def experiment_choices(spark, d):
    """ACT-06: the groups that each arm had labelled."""
    return _experiment(spark, d)[1]


@query()
def experiment_report(spark, d):
    """ACT-07: the arms of the last round over seeds, and what choosing by doubt gains over drawing."""
    results = _experiment(spark, d)[0]
    last = results.filter(F.col("round") == results.agg(F.max("round").alias("r")).first()["r"])
    paired = active.paired_statistics(active.paired_deltas(last, "seed", "arm", "auroc", "uncertainty", "random"))
    arms = active.arm_summary(last, "arm", "auroc").select(F.col("arm").alias("what"), F.col("n_seeds").alias("n"), "mean", F.col("min").alias("low"), F.col("max").alias("high"))
    return at6(arms.union(paired.select(F.lit("gain"), "n_pairs", "mean_delta", "ci_low", "ci_high")), "mean", "low", "high")


@query(f"WITH {ARMS} SELECT arm, count(*) AS n_seeds, {r6('avg(metric)')} AS mean, {r6('stddev_samp(metric)')} AS std, {r6('min(metric)')} AS min, {r6('max(metric)')} AS max FROM arms GROUP BY arm")
def arm_summary(spark, d):
    """ACT-07, AGG-15: spread of each arm over seeds."""
    return at6(active.arm_summary(_arms(spark, d), "arm", "metric"), "mean", "std", "min", "max")


T_SQL = "coalesce([12.706e0, 4.303e0, 3.182e0, 2.776e0, 2.571e0, 2.447e0, 2.365e0, 2.306e0, 2.262e0][n - 1], 1.96e0)"


@query(f"""WITH {ARMS}, p AS (SELECT seed, avg(CASE WHEN arm = 'click' THEN metric END) - avg(CASE WHEN arm = 'view' THEN metric END) AS delta FROM arms GROUP BY seed), q AS (SELECT delta FROM p WHERE delta IS NOT NULL),
 s AS (SELECT count(*) AS n, avg(delta) AS m, stddev_samp(delta) AS sd, count_if(delta > 0)::BIGINT AS wins, count_if(delta < 0)::BIGINT AS losses, count_if(delta = 0)::BIGINT AS ties FROM q)
 SELECT n AS n_pairs, {r6('m')} AS mean_delta, {r6('sd')} AS std_delta, {r6(f'm - {T_SQL} * (sd / sqrt(n))')} AS ci_low, {r6(f'm + {T_SQL} * (sd / sqrt(n))')} AS ci_high, abs(m) > {T_SQL} * (sd / sqrt(n)) AS significant, {r6('2.9e0 * (sd / sqrt(n))')} AS minimum_detectable_effect, wins, losses, ties FROM s""")
def paired_statistics(spark, d):
    """ACT-07, JN-18, AGG-16, AGG-17: arms paired by seed."""
    out = active.paired_statistics(active.paired_deltas(_arms(spark, d), "seed", "arm", "metric", "click", "view"))
    return at6(out, "mean_delta", "std_delta", "ci_low", "ci_high", "minimum_detectable_effect")


@query(f"WITH {CHAIN} SELECT seq, prev_hash, record_hash FROM chained")
def audit_chain_build(spark, d):
    """FN-04: a log in which every record's hash rests on all before it."""
    return b.chained(spark, d).select("seq", "prev_hash", "record_hash")


#: The log with row 501 edited and 501 and 502 sealed again, and row 700 removed.
FORGED = """forged AS (SELECT l.pos, sha256('leaf' || chr(10) || concat_ws('|', (event_id + 1)::VARCHAR, user_id::VARCHAR, CASE WHEN event_id = 500 THEN 'edited' ELSE event_type END, props)) AS hash FROM leaves l JOIN events ON event_id = l.pos)"""


@query(f"""WITH {CHAIN}, {FORGED},
 again AS (WITH leaves AS (SELECT * FROM forged WHERE pos < 502), {TREE}, peaks AS (SELECT l.pos + 1 AS n, b.k AS level, (((l.pos + 1) >> b.k) - 1)::BIGINT AS idx FROM leaves l, (SELECT unnest(range(40)) AS k) b WHERE ((l.pos + 1) >> b.k) % 2 = 1)
  SELECT n, list_reduce(list(hash ORDER BY level), lambda acc, x: sha256('node' || chr(10) || x || chr(10) || acc)) AS root FROM peaks JOIN nodes USING (level, idx) GROUP BY n),
 stored AS (SELECT seq, CASE WHEN seq = 502 THEN (SELECT root FROM again WHERE n = 501) ELSE prev_hash END AS prev_hash, CASE WHEN seq IN (501, 502) THEN (SELECT root FROM again WHERE n = seq) ELSE record_hash END AS record_hash FROM chained WHERE seq <> 700),
 checked AS (SELECT seq, CASE WHEN seq <> 1 AND lag(seq) OVER w IS DISTINCT FROM seq - 1 THEN 'sequence gap' WHEN seq = 503 THEN 'prev_hash mismatch'
  WHEN seq < 501 AND lag(record_hash) OVER w <> prev_hash THEN 'prev_hash mismatch' WHEN seq <= 502 AND record_hash <> (SELECT root FROM again WHERE n = seq) THEN 'record_hash mismatch' END AS detail FROM stored WINDOW w AS (ORDER BY seq))
 SELECT count(detail) = 0 AS ok, count(*) AS n_records, min(CASE WHEN detail IS NOT NULL THEN seq END)::BIGINT AS broken_at, min_by(detail, seq) FILTER (detail IS NOT NULL) AS detail FROM checked""")
def audit_chain_verify(spark, d):
    """AUD-03, WIN-03: the first break of a log in which an edited row and the next were sealed anew,
    and a later row removed. The two fit each other; the row after them doesn't."""
    edit = lambda log: log.withColumn("event_type", F.when(F.col("seq") == 501, "edited").otherwise(F.col("event_type")))
    # a row's hashes rest on the rows up to it, so no later one is needed for sealing 501 and 502
    sealed = audit.linked(edit(b.logged(spark, d).filter("seq <= 502")), b.payload(), "seq").select("seq", F.col("prev_hash").alias("p"), F.col("record_hash").alias("r")).filter("seq in (501, 502)")
    both = edit(b.chained(spark, d)).join(F.broadcast(sealed), "seq", "left")
    log = both.select("seq", "user_id", "event_type", "props", F.coalesce("p", "prev_hash").alias("prev_hash"), F.coalesce("r", "record_hash").alias("record_hash")).filter("seq <> 700")
    log = materialize(log, "forged")  # it is read several times
    return audit.verify(audit.breaks(log, b.payload()), log.agg(F.count("*").alias("n_records")))


@query(f"""WITH {CHAIN}, sides AS (SELECT pos, k, pos >> k AS place, ((pos >> k) // 2) * 2 + 1 - (pos >> k) % 2 AS idx FROM leaves, (SELECT unnest(range(40)) AS k) b),
 steps AS (SELECT pos, k, CASE WHEN place % 2 = 1 THEN 'L' ELSE 'R' END || hash AS step FROM sides JOIN nodes n ON n.level = k AND n.idx = sides.idx)
 SELECT pos + 1 AS seq, l.hash AS leaf, coalesce(list_aggregate(list(step ORDER BY k) FILTER (step IS NOT NULL), 'string_agg', ','), '') AS path, (SELECT hash FROM nodes WHERE width = 1) AS root
 FROM leaves l LEFT JOIN steps USING (pos) GROUP BY pos, l.hash""")
def audit_inclusion(spark, d):
    """AUD-03: for every record the hashes that show it to be part of the log."""
    return audit.inclusion(b.logged(spark, d), b.payload()).withColumn("path", F.array_join("path", ","))


@query(f"""WITH {INV}, {OLD} SELECT coalesce(i.rel_path, o.rel_path) AS rel_path, CASE WHEN o.rel_path IS NULL THEN 'created' WHEN i.rel_path IS NULL THEN 'deleted' ELSE 'modified' END AS change FROM inv i FULL JOIN old o ON i.rel_path = o.rel_path
 WHERE o.rel_path IS NULL OR i.rel_path IS NULL OR o.size_bytes <> i.size_bytes""")
def audit_dir_diff(spark, d):
    """AUD-02: created, deleted and modified files of two listings."""
    inv = b.inventory(spark, d).withColumn("mtime", F.lit(0))
    return audit.directory_diff(b.altered(inv.drop("mtime")).withColumn("mtime", F.lit(0)), inv)


@query("""WITH runs AS (SELECT o_orderkey AS seq, 'run-' || o_orderkey AS run_id, 'datasets/v' || (o_custkey % 40) || CASE WHEN o_orderkey % 3 = 0 THEN '/index.csv' ELSE '' END AS changed FROM orders),
 targets AS (SELECT 'datasets/v' || i AS target, 4000 + i * 100 AS before_seq FROM range(45) t(i)),
 hits AS (SELECT target, run_id, seq, row_number() OVER (PARTITION BY target ORDER BY seq DESC) AS n FROM targets JOIN runs ON seq < before_seq AND (changed = target OR starts_with(changed, target || '/') OR starts_with(target, changed || '/')))
 SELECT target, run_id, seq FROM hits WHERE n = 1""")
def lineage_producer(spark, d):
    """AUD-04, AUD-05, JN-19: the newest earlier run that changed each target."""
    order, version = F.col("o_orderkey"), (F.col("o_custkey") % 40).cast("string")
    tail = F.when(order % 3 == 0, "/index.csv").otherwise("")
    runs = table(spark, d, "orders").select(order.alias("seq"), F.concat(F.lit("run-"), order.cast("string")).alias("run_id"), F.concat(F.lit("datasets/v"), version, tail).alias("changed"))
    targets = spark.range(45).select(F.concat(F.lit("datasets/v"), F.col("id").cast("string")).alias("target"), (4000 + F.col("id") * 100).alias("before_seq"))
    return audit.producers(runs, targets)


@query("""WITH edges AS (SELECT DISTINCT 'part' || l_partkey AS child, 'supplier' || l_suppkey AS parent FROM lineitem UNION SELECT 'order' || l_orderkey, 'part' || l_partkey FROM lineitem),
 l0 AS (SELECT DISTINCT 'order' || l_orderkey AS node FROM lineitem),
 l1 AS (SELECT DISTINCT parent AS node FROM l0 JOIN edges ON node = child), l2 AS (SELECT DISTINCT parent AS node FROM l1 JOIN edges ON node = child)
 SELECT node, 0 AS level FROM l0 UNION ALL SELECT node, 1 FROM l1 UNION ALL SELECT node, 2 FROM l2""")
def lineage_trace(spark, d):
    """AUD-05, JN-20: everything that orders rest on, by level."""
    lines = table(spark, d, "lineitem")
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    edges = lines.select(name("part", "l_partkey").alias("child"), name("supplier", "l_suppkey").alias("parent")).union(lines.select(name("order", "l_orderkey"), name("part", "l_partkey")))
    return audit.trace(lines.select(name("order", "l_orderkey").alias("node")), edges)


@query()
def logistic_baseline(spark, d):
    """TRN-02 substitute, ACT-05: a logistic model on vectors, scored on rows that it didn't learn."""
    from quern.operators import training

    rows = table(spark, d, "embeddings").select("vec_id", "embedding", (F.col("label") % 2).alias("label"))
    model = training.train(rows.filter("vec_id % 5 <> 0"), "embedding")
    return training.predict(model, rows.filter("vec_id % 5 = 0"), "embedding", ["vec_id", "label"])


@query()
def image_validate(spark, d):
    """CUR-01, AGG-19, FN-23 on pixels: vectors as small gray images, some blank and some cut."""
    from quern.operators import imaging

    digits = F.array_join(F.transform(b.pixels(), lambda p: F.lpad(F.hex(F.when(F.col("vec_id") % 25 == 0, 0).otherwise(p)), 2, "0")), "")
    bad = F.col("vec_id") % 40 == 3
    images = table(spark, d, "embeddings").select(
        F.concat(F.lit("img/"), F.col("vec_id").cast("string")).alias("path"), F.when(bad, -1).otherwise(8).alias("width"), F.when(bad, -1).otherwise(8).alias("height"), F.lit(1).alias("channels"), F.unhex(digits).alias("data")
    )
    return imaging.validate(images, (8, 8)).select("path", "width", "height", F.array_join("reasons", "; ").alias("reasons"), "dhash")
