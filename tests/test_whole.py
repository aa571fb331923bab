"""Queries whose registered SQL tells less than the whole job, against SQL over whole tables."""

import os

import pytest

from test_queries import ORACLES, QUERIES, SF, duck, rows  # noqa: F401

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


def same(name, sql, spark, duck):  # noqa: F811
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
    return got


def test_qc_gate_counts_all_five_checks(spark, duck):  # noqa: F811
    parts = ["qc_window_counts", "qc_orphans", "qc_mask_label", "qc_coverage", "qc_plausibility"]
    found = [f'SELECT "check", severity FROM ({ORACLES[p]})' for p in parts]
    found += [f"SELECT 'demographics', 'ERROR' FROM ({ORACLES['qc_label_agreement']})", f"SELECT 'leakage', 'ERROR' FROM ({ORACLES['leakage_confirmed']})"]
    sql = f"""WITH f AS ({" UNION ALL ".join(found)}), t AS (SELECT c."check", count_if(severity = 'ERROR')::BIGINT AS errors, count_if(severity = 'WARNING')::BIGINT AS warnings
     FROM (SELECT unnest(['slice-counts', 'orphans', 'mask-label-agreement', 'demographics', 'leakage']) AS "check") c LEFT JOIN f ON c."check" = f."check" GROUP BY ALL)
     SELECT *, CASE WHEN errors > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'WARN' ELSE 'PASS' END AS result FROM t"""
    got = same("qc_gate", sql, spark, duck)
    assert got.set_index("check").loc["demographics", "errors"] > 0


def test_lineage_of_all_orders(spark, duck):  # noqa: F811
    sql = """SELECT DISTINCT 'order' || l_orderkey AS node, 0 AS level FROM lineitem UNION ALL SELECT DISTINCT 'part' || l_partkey, 1 FROM lineitem
     UNION ALL SELECT DISTINCT 'supplier' || l_suppkey, 2 FROM lineitem"""
    same("lineage_trace", sql, spark, duck)


def test_release_leaks_of_all_sources(spark, duck):  # noqa: F811
    found = set(same("release_leaks", ORACLES["release_leaks"].replace(" WHERE source LIKE 'src1%'", ""), spark, duck)["identifier"])
    assert found == {r[0] for r in duck.execute("SELECT DISTINCT source FROM documents").fetchall()}


def test_privacy_gate_makes_every_check(spark, duck):  # noqa: F811
    got = QUERIES["privacy_gate"](spark, SF).toPandas().set_index("check")
    leaks = duck.execute(f"SELECT count(*) FROM ({ORACLES['id_leak_fraction']}) WHERE leaks").fetchone()[0]
    assert leaks > 0 and got.loc["no-real-ids-in-exports"].tolist() == [leaks, "FAIL"]
    marks = duck.execute(f"SELECT count(*) FROM ({ORACLES['image_metadata']})").fetchone()[0]
    assert marks > 0 and got.loc["image-metadata"].tolist() == [marks, "FAIL"]
    assert len(got) == 5
