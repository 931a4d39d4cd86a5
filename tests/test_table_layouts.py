"""Clustered records, state of latest versions, committed appends."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from geotaxa.operators.state import LatestState
from geotaxa.operators.versions import latest_version
from geotaxa.plans.checks import plan_text
from geotaxa.sinks import commits
from geotaxa.sources.clustered import NEVER, PERIOD, pruned_pull, read_clustered, write_clustered
from geotaxa.sources.sync import incremental_pull
from helpers import OCC_SCHEMA, as_set, occ_df, row

SOURCES = ["gbif", "idigbio", "2020", "mycoportal"]


def month(i):
    return dt.datetime(2016 + i // 12, i % 12 + 1, 3, 12)


def records(spark, n=600):
    rng = random.Random(4)
    rows = [row(i, source="gbif" if i % 3 == 0 else rng.choice(SOURCES), family=f"F{rng.randrange(6)}",
                updated=month(rng.randrange(12)), price=float(i)) for i in range(n)]
    rows += [row(n + 1, updated=None), row(n + 2, source=None), row(n + 3, family=None)]
    return occ_df(spark, rows)


def history_table(spark, path, marks):
    spark.createDataFrame(marks, "source string, family string, fetched_at timestamp_ntz").write.parquet(path)
    return spark.read.parquet(path)


def files_read(df):
    """Data files of the record table that an executed plan has opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().executedPlan()
    nodes, total = [plan], 0
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.getClass().getSimpleName() == "FileSourceScanExec" and PERIOD in node.relation().schema().simpleString():
            total += node.metrics().apply("numFiles").value()
    return total


def test_pull_over_the_layout_equals_the_plain_pull_and_skips_files(spark, tmp_path):
    raw, path = records(spark), str(tmp_path / "records")
    write_clustered(raw, path, files=6)
    table = read_clustered(spark, path)
    assert dict(table.dtypes)["source"] == "string" and dict(table.dtypes)[PERIOD] == "date"
    assert table.count() == raw.count()
    read = []
    for name, last in (("a", month(0)), ("b", month(7)), ("c", month(11))):
        marks = [(s, f"F{i}", last) for s in SOURCES for i in range(6)] + [("gbif", "F1", month(2)), (None, "F2", month(0))]
        history = history_table(spark, str(tmp_path / name), marks)
        got = pruned_pull(table, history, observed_after=None, observed_before=None)
        want = incremental_pull(raw, history, observed_after=None, observed_before=None)
        assert as_set(got, "id", "source") == as_set(want, "id", "source")
        assert set(got.columns) == set(raw.columns)
        read.append(files_read(got))
    assert read[0] > read[1] > read[2]


def test_sources_without_a_mark_are_pruned_by_the_join(spark, tmp_path):
    raw, path = records(spark), str(tmp_path / "records")
    write_clustered(raw, path, files=6)
    table = read_clustered(spark, path)
    every = history_table(spark, str(tmp_path / "all"), [(s, "F1", month(5)) for s in SOURCES])
    one = history_table(spark, str(tmp_path / "one"), [("mycoportal", "F1", month(5)), ("gbif", "F1", dt.datetime.fromisoformat(NEVER))])
    few, many = (pruned_pull(table, h, observed_after=None, observed_before=None) for h in (one, every))
    assert files_read(few) < files_read(many) / 2
    plan = plan_text(few, "formatted")
    assert "dynamicpruning" in plan.lower()
    filters = [line for line in plan.splitlines() if line.startswith("PushedFilters") and "updated_at" in line]
    assert filters and "family" in filters[0]
    want = incremental_pull(raw, one, observed_after=None, observed_before=None)
    assert as_set(few, "id") == as_set(want, "id") and few.count() > 0


def test_pull_options_and_empty_layouts(spark, tmp_path):
    raw, path = records(spark, 400), str(tmp_path / "records")
    write_clustered(raw, path)
    history = history_table(spark, str(tmp_path / "h"), [(s, f"F{i}", month(3)) for s in SOURCES for i in range(6)])
    options = dict(observed_after=None, observed_before=None, modified_before=month(8), restrict_sources=["2020", "gbif"], restrict_families=["F1", "F2"])
    assert as_set(pruned_pull(read_clustered(spark, path), history, **options), "id") == as_set(incremental_pull(raw, history, **options), "id")
    none = history_table(spark, str(tmp_path / "none"), [])
    assert pruned_pull(read_clustered(spark, path), none, observed_after=None, observed_before=None).count() == 0
    write_clustered(occ_df(spark, [row(9001, updated=month(11), family="F1")]), path)      # a later append
    assert as_set(pruned_pull(read_clustered(spark, path), history, observed_after=None, observed_before=None), "id") >= {(9001,)}


# ---------------------------------------------------------------- state
TIE = ("price",)


def state_of(spark, path, **options):
    return LatestState(spark, str(path), OCC_SCHEMA, TIE, buckets=8, **options)


def versions(rng, n, ids):
    return [row(rng.randrange(ids), source=rng.choice(SOURCES), updated=rng.choice([None, *map(month, range(5))]), price=float(i) + rng.random())
            for i in range(n)]


def test_merged_batches_equal_the_full_recompute(spark, tmp_path):
    rng, state, seen = random.Random(8), state_of(spark, tmp_path / "s", generations=3), []
    assert state.read().count() == 0
    for i in range(6):
        rows = versions(rng, 150 if i % 2 else 3, 60)
        seen += rows
        touched = state.merge(occ_df(spark, rows), f"b{i}")
        assert touched and len(state.live()) <= 4
        if i in (3, 5):
            want = latest_version(occ_df(spark, seen), tie_break=TIE)
            assert sorted(map(str, state.read().collect())) == sorted(map(str, want.collect()))
    assert state.merge(occ_df(spark, rows), "b5") == []                 # a repeated batch
    again = state_of(spark, tmp_path / "s").read()                      # another session's view
    assert again.count() == latest_version(occ_df(spark, seen), tie_break=TIE).count()
    assert state.merge(occ_df(spark, []), "empty") == []


def test_untouched_buckets_are_left_alone_and_dead_merges_do_not_show(spark, tmp_path):
    state = state_of(spark, tmp_path / "s")
    state.merge(occ_df(spark, [row(i, price=float(i)) for i in range(200)]), "b0")
    before = state.live()
    assert [len(b) for b in before.values()] == [8]
    touched = state.merge(occ_df(spark, [row(7, updated=month(40), price=900.0)]), "b1")
    assert len(touched) == 1 and sorted(len(b) for b in state.live().values()) == [1, 7]
    # A merge that died before its manifest: files are there, nobody names them.
    dead = occ_df(spark, [row(3, updated=month(41), price=1000.0)])
    rows = state.newest(dead)
    rows.select(*state.columns, "_bucket").write.insertInto(state._table("dead"))
    assert state.read().where("id = 3").first()["price"] == 3.0
    assert state.merge(dead, "b2") and state.read().where("id = 3").first()["price"] == 1000.0
    with pytest.raises(Exception, match="null source in a state batch"):
        state.merge(occ_df(spark, [row(1, source=None)]), "b3")


def test_the_state_is_not_shuffled(spark, tmp_path):
    state = state_of(spark, tmp_path / "s")
    state.merge(occ_df(spark, [row(i, source=SOURCES[i % 4], price=float(i)) for i in range(500)]), "b0")
    (attempt, buckets), = state.live().items()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = str(tmp_path / "batch")
        state.newest(occ_df(spark, [row(i, source=SOURCES[i % 4], price=1000.0 + i) for i in range(900)])).write.parquet(batch)
        df = state.winners(attempt, spark.read.parquet(batch), buckets)
        df.collect()
        lines = plan_text(df).split("Initial Plan")[0].splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
        depth, above = lines[scan].index("FileScan"), []
        for line in reversed(lines[:scan]):                             # from the scan up to the join
            at = len(line) - len(line.lstrip(" :+-"))
            if at < depth:
                depth = at
                above.append(line)
                if "Join" in line:
                    break
        assert "Join" in above[-1] and not any("Exchange" in line or "ShuffleQueryStage" in line for line in above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---------------------------------------------------------------- commits
def numbers(spark, *values):
    return spark.createDataFrame([(v, f"s{v % 2}") for v in values], "v long, source string")


def test_append_shows_whole_once_or_not_at_all(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = numbers(spark, 1).schema
    assert commits.read_committed(spark, table, schema).count() == 0
    assert commits.append_batch(numbers(spark, 1, 2, 3), table, "b1", ["source"])
    assert not commits.append_batch(numbers(spark, 1, 2, 3), table, "b1", ["source"])
    # A run that dies half-way: one task of the write fails after others wrote files.
    broken = numbers(spark, *range(10, 60)).repartition(5).withColumn(
        "v", F.when(F.col("v") == 40, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        commits.append_batch(broken, table, "b2", ["source"])
    assert as_set(commits.read_committed(spark, table), "v") == {(1,), (2,), (3,)}
    # A run that dies between staging and its manifest, then is repeated.
    commits.stage(numbers(spark, 7, 8), table, ["source"])
    assert commits.read_committed(spark, table).count() == 3
    assert commits.append_batch(numbers(spark, 7, 8), table, "b2", ["source"])
    assert as_set(commits.read_committed(spark, table), "v", "source") == {(1, "s1"), (2, "s0"), (3, "s1"), (7, "s1"), (8, "s0")}
    assert as_set(commits.read_committed(spark, table, batches=["b2"]), "v") == {(7,), (8,)}
    assert commits.unnamed_attempts(spark, table).count() == 1


def test_two_runs_of_one_batch_and_odd_batches(spark, tmp_path):
    table = str(tmp_path / "t")
    first, second = (commits.stage(numbers(spark, 1), table) for _ in range(2))
    commits.commit(spark, table, "b", *first, numbers(spark, 1).schema)
    with pytest.raises(AnalysisException):
        commits.commit(spark, table, "b", *second, numbers(spark, 1).schema)
    assert commits.read_committed(spark, table).count() == 1
    assert commits.append_batch(numbers(spark).limit(0), table, "empty")
    assert commits.append_batch(numbers(spark, 5).withColumn("more", F.lit(2)), table, "wider")
    assert as_set(commits.read_committed(spark, table), "v", "more") == {(1, None), (5, 2)}
    for bad in ("", "../x", "a/b", "a b"):
        with pytest.raises(ValueError):
            commits.append_batch(numbers(spark, 1), table, bad)
    with pytest.raises(ValueError):
        commits.read_committed(spark, str(tmp_path / "none"))


def test_occurrences_append_by_batch(spark, tmp_path):
    from geotaxa.sinks.writers import append_occurrences
    table = str(tmp_path / "occ")
    df = occ_df(spark, [row(1), row(2, source="x"), row(3, name=None)]).withColumn("scientific_name", F.col("name"))
    for _ in range(2):                                       # a repeated run
        append_occurrences(df, table, batch="2020-01-01")
    append_occurrences(df.where("id = 2").withColumn("id", F.lit(9)), table, batch="2020-01-02")
    assert as_set(commits.read_committed(spark, table), "id", "source") == {(1, "gbif"), (2, "x"), (9, "x")}
    assert commits.read_committed(spark, table).count() == 3
