"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from geotaxa.plans.checks import plan_summary  # noqa: E402
from oracle_check import digest, duck, type_mismatches  # noqa: E402

SF = os.environ.get("GEOTAXA_TEST_SF", "/root/testdata/sf0.001")
KEYS = sorted(entry.registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(entry.registry.oracle_sql()) == set(entry.registry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    summary = plan_summary(df)
    assert "BatchEvalPython" not in summary["python"] and not summary["cartesian"]
    cur = con.execute(entry.oracle_sql()[key])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert type_mismatches(df, cur) == {}
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "source", "name", "date"]
    assert df.count() > 0


@pytest.mark.parametrize("conf", [{"spark.sql.ansi.enabled": "false"},
                                  {"spark.sql.adaptive.enabled": "false",
                                   "spark.sql.shuffle.partitions": "200"}])
@pytest.mark.parametrize("key", ["read_occurrences", "feature_requests", "merge_features",
                                 "incremental_pull", "normalize_names", "batched_requests"])
def test_results_do_not_depend_on_session_settings(spark, con, conf, key):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = entry.queries()[key](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    cur = con.execute(entry.oracle_sql()[key])
    assert digest(df.columns, rows)[0] == digest([c[0] for c in cur.description], cur.fetchall())[0]
