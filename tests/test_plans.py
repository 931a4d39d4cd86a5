"""Plan checks: the physical plans are the ones we designed for."""

import pytest

import __spark_entry__ as entry
from geotaxa.plans.checks import plan_summary, plan_text

SF = "/root/testdata/sf0.001"


def plan(df):
    return plan_text(df, "formatted")


def test_latest_version_partial_window_group_limit(spark):
    p = plan(entry.queries()["latest_version"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_taxa_threshold_is_count_plus_semi_join(spark):
    p = plan(entry.queries()["taxa_threshold"](spark, SF))
    assert "LeftSemi" in p
    assert "HashAggregate" in p


def test_incremental_pull_applies_the_smallest_mark_at_the_scan(spark, tmp_path):
    import datetime as dt

    from geotaxa.sources.sync import incremental_pull
    from helpers import T0, occ_df, row
    path = str(tmp_path / "records")
    occ_df(spark, [row(1, updated=T0 + dt.timedelta(days=1))]).write.parquet(path)
    history = spark.createDataFrame([("gbif", "AMANITACEAE", T0)], "source string, family string, fetched_at timestamp_ntz")
    p = plan(incremental_pull(spark.read.parquet(path), history))
    assert "BroadcastNestedLoopJoin" not in p and "LeftSemi" in p
    filters = [line for line in p.splitlines() if line.startswith("Condition") or "DataFilters" in line]
    assert any("updated_at" in line and "ubquery" in line for line in filters)


def test_sync_queue_reads_the_history_only(spark, tmp_path):
    from geotaxa.sources.sync import sync_queue
    path = str(tmp_path / "history")
    spark.createDataFrame([("gbif", "A", None)], "source string, family string, fetched_at timestamp_ntz").write.parquet(path)
    p = plan(sync_queue(spark.read.parquet(path)))
    assert p.count("Scan parquet") <= 2 and "Join" not in p and "Exchange" not in p


def test_scan_prunes_columns(spark):
    p = plan(entry.queries()["source_list"](spark, SF))
    # lineitem scan reads only the join keys, not every column
    line = [l for l in p.splitlines() if l.startswith("ReadSchema") and "l_orderkey" in l][0]
    assert "l_quantity" not in line and "l_returnflag" not in line


# Queries over tables of their own run jobs while they are built: test_oracle
# looks at the plans of those it runs anyway.
@pytest.mark.parametrize("key", sorted(entry.registry.QUERIES))
def test_no_row_at_a_time_python_and_no_cartesian(spark, key):
    s = plan_summary(entry.queries()[key](spark, SF))
    assert "BatchEvalPython" not in s["python"]
    assert not s["cartesian"]
    if key not in ("fetch_missing_features", "asof_features"):
        assert s["python"] == []


def test_pull_is_one_semi_join_with_the_marks(spark):
    s = plan_summary(entry.queries()["incremental_pull"](spark, SF))
    assert any(j.endswith("LeftSemi") for j in s["joins"]) and not any("NestedLoop" in j for j in s["joins"])


@pytest.mark.parametrize("key", ["join_existing_features", "complete_rows", "missing_feature_keys", "merge_features",
                                 "merged_without_feature", "grouped_occurrences", "combine_features", "fetched_flag",
                                 "feature_rows_to_append", "job_counters"])
def test_feature_tables_are_picked_without_sort_aggregates(spark, key):
    assert "SortAggregate" not in plan(entry.queries()[key](spark, SF))


def test_sampling_batches_numbers_only_what_it_keeps(spark):
    p = plan(entry.queries()["sample_batches"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_counters_take_one_pass_a_frame(spark):
    p = plan_text(entry.queries()["job_counters"](spark, SF))
    assert p.count("Union") <= 4 and p.count("explode(") == 3


def test_windows_join_one_row_a_cell_without_a_range(spark):
    p = plan(entry.queries()["feature_windows"](spark, SF))
    assert "NestedLoop" not in p and p.count("LeftOuter") <= 2   # the tree and its details
