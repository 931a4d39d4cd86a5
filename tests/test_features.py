import datetime as dt
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

from geotaxa.operators import features as fx
from geotaxa.operators.features import FeatureSpec
from geotaxa.plans.jobs import enrich_features
from helpers import as_set, occ_df, row

cloudpickle.register_pickle_by_value(sys.modules[__name__])

D1, D2 = dt.date(2016, 1, 1), dt.date(2016, 2, 1)
SPEC = FeatureSpec(name="landcover")


def stored_df(spark, rows):
    return spark.createDataFrame(rows, "cell_id long, date date, landcover long")


def occs(spark):
    return occ_df(spark, [row(1, cell=1, date=D1), row(2, cell=1, date=D1), row(3, cell=2, date=D1),
                          row(4, cell=3, date=D2), row(5, cell=4, date=D2)])


def feature_rows(grouped):
    rows = grouped.collect()
    assert all(r["c"] == len(r["rows"]) for r in rows)
    return {r["id"]: [tuple(x) for x in r["rows"]] for r in rows}


def fetch_even_cells(keys: pd.DataFrame) -> pd.DataFrame:
    found = keys[keys["cell_id"] % 2 == 0].copy()
    found["landcover"] = found["cell_id"] * 10
    return found


def test_split_is_complete_plus_incomplete(spark):
    occ = occs(spark)
    j = fx.join_existing_features(occ, stored_df(spark, [(1, D1, 5), (3, D2, None)]), SPEC)
    c, i = fx.complete_rows(j, SPEC), fx.incomplete_rows(j, SPEC)
    assert c.count() + i.count() == occ.count()
    assert as_set(c, "id") == {(1,), (2,)}                        # NULL value counts as incomplete
    parts = {r["complete"]: r["c"] for r in fx.completeness_partition(j, SPEC).collect()}
    assert parts == {True: 2, False: 3}


def test_missing_groups_count_each_key_once(spark):
    g = fx.missing_feature_groups(occs(spark), stored_df(spark, [(2, D1, 1)]), SPEC)
    assert as_set(g, "cell_id", "c") == {(1, 2), (3, 1), (4, 1)}


def test_fetch_function_called_on_distinct_keys_with_flag(spark):
    spec = FeatureSpec(name="landcover", fetch=fetch_even_cells, batch_size=2)
    keys = fx.missing_feature_keys(occs(spark), stored_df(spark, []), spec)
    got = fx.fetch_missing_features(keys, spec)
    assert as_set(got, "cell_id", "landcover", "fetched") == {
        (1, None, True), (2, 20, True), (3, None, True), (4, 40, True)}


def test_merge_returns_each_occurrence_once(spark):
    occ = occs(spark)
    stored = stored_df(spark, [(1, D1, 5)])
    lookup = stored_df(spark, [(2, D1, 7), (3, D2, 8), (1, D1, 99)])
    spec = FeatureSpec(name="landcover", lookup=lookup)
    fetched = fx.fetch_missing_features(fx.missing_feature_keys(occ, stored, spec), spec)
    merged = fx.merge_features(occ, stored, fetched, spec)
    assert merged.count() == occ.count()
    assert as_set(merged, "id", "landcover") == {(1, 5), (2, 5), (3, 7), (4, 8), (5, None)}
    grouped = fx.grouped_occurrences(merged, [spec])
    assert feature_rows(grouped) == {1: [("landcover", "5")], 2: [("landcover", "5")],
                                     3: [("landcover", "7")], 4: [("landcover", "8")]}


def test_second_enrichment_fetches_nothing(spark, tmp_path):
    occ = occs(spark)
    spec = FeatureSpec(name="landcover", fetch=fetch_even_cells)
    store = str(tmp_path / "landcover")
    empty = stored_df(spark, [])
    result = enrich_features(occ, empty, spec, store_path=store, batch_id="b1")
    merged, grouped = result.merged, result.grouped
    merged.write.format("noop").mode("overwrite").save()
    assert result.counters() == {"landcover.records_fetched": 4, "landcover.values_found": 2,
                                 "landcover.complete": 0, "landcover.incomplete": 5,
                                 "landcover.with_value": 2, "landcover.without_key": 0}
    assert merged.count() == 5
    assert as_set(merged, "id", "landcover") == {(1, None), (2, None), (3, 20), (4, None), (5, 40)}
    table = spark.read.parquet(store)
    assert table.count() == 4                                    # one row per key, found or not
    # next run: everything is known (found, or fetched and empty)
    assert fx.missing_feature_keys(occ, table, spec).count() == 0
    again = enrich_features(occ, table, spec, store_path=str(tmp_path / "again"), batch_id="b2")
    again.merged.write.format("noop").mode("overwrite").save()
    c = again.counters()
    assert c["landcover.records_fetched"] == 0 and c["landcover.complete"] == 5


def test_vectors_sorted_by_date_and_validity(spark):
    t = stored_df(spark, [(1, D2, 2), (1, D1, 1), (2, D1, 3)])
    v = {r["cell_id"]: r["v"] for r in fx.feature_vectors(t, SPEC).collect()}
    assert v == {1: "1,2", 2: "3"}
    assert as_set(fx.valid_feature_vectors(t, SPEC, 2), "cell_id") == {(1,)}


def test_combine_several_features(spark):
    occ = occs(spark)
    a = stored_df(spark, [(1, D1, 5)])
    b = spark.createDataFrame([(1, D1, 0.5)], "cell_id long, date date, ndvi double")
    out = fx.combine_features(occ, [(SPEC, a), (FeatureSpec(name="ndvi", value_cols=("ndvi",)), b)])
    assert as_set(out.where(F.col("id") == 1), "landcover", "ndvi") == {(5, 0.5)}
    assert out.count() == occ.count()


def test_key_stored_without_value_is_refetched_once(spark):
    occ = occs(spark)
    stored = stored_df(spark, [(1, D1, None), (2, D1, 3)])
    lookup = stored_df(spark, [(1, D1, 11)])
    spec = FeatureSpec(name="landcover", lookup=lookup)
    fetched = fx.fetch_missing_features(fx.missing_feature_keys(occ, stored, spec), spec)
    merged = fx.merge_features(occ, stored, fetched, spec)
    assert merged.count() == occ.count()
    assert as_set(merged, "id", "landcover") == {(1, 11), (2, 11), (3, 3), (4, None), (5, None)}
    grouped = fx.grouped_occurrences(merged, [spec])
    assert feature_rows(grouped) == {1: [("landcover", "11")], 2: [("landcover", "11")], 3: [("landcover", "3")]}


def test_nothing_missing_means_nothing_fetched(spark):
    occ = occs(spark)
    stored = stored_df(spark, [(1, D1, 1), (2, D1, 2), (3, D2, 3), (4, D2, 4)])
    spec = FeatureSpec(name="landcover", fetch=fetch_even_cells)
    keys = fx.missing_feature_keys(occ, stored, spec)
    assert keys.count() == 0
    fetched = fx.fetch_missing_features(keys, spec)
    assert fetched.count() == 0
    merged = fx.merge_features(occ, stored, fetched, spec)
    assert as_set(merged, "id", "landcover") == {(1, 1), (2, 1), (3, 2), (4, 3), (5, 4)}


def test_fetched_but_empty_counts_as_complete(spark):
    occ = occs(spark)
    stored = spark.createDataFrame([(1, D1, None, True), (2, D1, 3, False)],
                                   "cell_id long, date date, landcover long, fetched boolean")
    j = fx.join_existing_features(occ, stored, SPEC)
    assert as_set(fx.complete_rows(j, SPEC), "id") == {(1,), (2,), (3,)}
    assert as_set(fx.missing_feature_keys(occ, stored, SPEC), "cell_id") == {(3,), (4,)}


def test_enrichment_runs_against_its_own_table(spark, tmp_path):
    from geotaxa.operators.features import feature_table_schema
    spec = FeatureSpec(name="landcover", fetch=fetch_even_cells)
    table = str(tmp_path / "landcover")
    occ = occs(spark)
    first = enrich_features(occ, spark.createDataFrame([], feature_table_schema(spec)), spec,
                            store_path=table)
    first.merged.write.format("noop").mode("overwrite").save()
    more = occ.unionByName(occ_df(spark, [row(9, cell=6, date=D1)]))
    second = enrich_features(more, spark.read.parquet(table), spec, store_path=table)
    second.merged.write.format("noop").mode("overwrite").save()
    assert second.counters()["landcover.records_fetched"] == 1        # only the new key
    assert as_set(second.merged, "id", "landcover") >= {(9, 60), (3, 20), (5, 40)}
    assert spark.read.parquet(table).count() == 5


class EvenCellSource:
    """A fetch client with set-up cost: counts its own instances."""

    created = 0

    def __init__(self):
        EvenCellSource.created += 1

    def fetch(self, keys):
        return fetch_even_cells(keys)


def test_fetch_accepts_a_client_class(spark):
    spec = FeatureSpec(name="landcover", fetch=EvenCellSource, batch_size=1)
    keys = fx.missing_feature_keys(occs(spark).coalesce(1), stored_df(spark, []), spec).coalesce(1)
    got = fx.fetch_missing_features(keys, spec)
    assert as_set(got, "cell_id", "landcover") == {(1, None), (2, 20), (3, None), (4, 40)}


def test_enriching_already_enriched_rows_replaces_values(spark):
    from pyspark.sql import functions as F
    occ = occs(spark).withColumn("landcover", F.lit(-1).cast("long"))
    stored = stored_df(spark, [(1, D1, 5)])
    j = fx.join_existing_features(occ, stored, SPEC)
    assert j.columns.count("landcover") == 1
    assert as_set(j.where(F.col("id") == 1), "landcover") == {(5,)}
    m = fx.merge_features(occ, stored, stored_df(spark, []), SPEC)
    assert m.columns.count("landcover") == 1 and m.count() == 5
    c = fx.combine_features(occ, [(SPEC, stored)])
    assert c.columns.count("landcover") == 1


D3 = dt.date(2016, 3, 1)
STORED = "cell_id long, date date, landcover long, fetched boolean, appended_at timestamp"


def at(day):
    return dt.datetime(2020, 1, day)


def test_repeated_stored_keys_do_not_multiply_occurrences(spark):
    occ = occs(spark)
    stored = spark.createDataFrame([(1, D1, None, True, at(3)), (1, D1, 5, False, at(1)), (1, D1, 4, False, at(2)),
                                    (2, D1, 6, False, at(1)), (2, D1, 7, False, at(2))], STORED)
    assert as_set(fx.one_row_per_key(stored, SPEC), "cell_id", "landcover", "fetched") == {
        (1, 4, True), (2, 7, False)}          # a value before none, then the latest
    j = fx.join_existing_features(occ, stored, SPEC)
    assert j.count() == occ.count()
    fetched = spark.createDataFrame([(3, D2, 8, True, at(1)), (3, D2, 8, True, at(1))], STORED)
    merged = fx.merge_features(occ, stored, fetched, SPEC)
    assert merged.count() == occ.count()
    assert as_set(merged, "id", "landcover") == {(1, 4), (2, 4), (3, 7), (4, 8), (5, None)}
    lookup = spark.createDataFrame([(4, D2, 9), (4, D2, 9), (4, D2, None)], "cell_id long, date date, landcover long")
    spec = FeatureSpec(name="landcover", lookup=lookup)
    assert fx.fetch_missing_features(fx.missing_feature_keys(occ, stored, spec), spec).count() == 2


def test_rows_without_a_key_are_never_fetched(spark, tmp_path):
    occ = occ_df(spark, [row(1, cell=None, date=D1), row(2, cell=2, date=D1)])
    spec = FeatureSpec(name="landcover", fetch=fetch_even_cells)
    table = str(tmp_path / "landcover")
    from geotaxa.operators.features import feature_table_schema
    stored = spark.createDataFrame([], feature_table_schema(spec))
    for fetched in (1, 0):
        result = enrich_features(occ, stored, spec, store_path=table)
        result.merged.write.format("noop").mode("overwrite").save()
        c = result.counters()
        assert c["landcover.records_fetched"] == fetched and c["landcover.without_key"] == 1
        stored = spark.read.parquet(table)
    assert stored.count() == 1
    assert fx.missing_feature_groups(occ, stored_df(spark, []), SPEC).count() == 1


def test_counters_of_an_empty_enrichment_are_zero(spark, tmp_path):
    spec = FeatureSpec(name="landcover", fetch=fetch_even_cells)
    result = enrich_features(occ_df(spark, []), stored_df(spark, []), spec, store_path=str(tmp_path / "t"))
    result.merged.write.format("noop").mode("overwrite").save()
    assert set(result.counters().values()) == {0}


def test_function_backed_feature_needs_a_store(spark):
    import pytest
    with pytest.raises(ValueError, match="store_path"):
        enrich_features(occs(spark), stored_df(spark, []), FeatureSpec(name="landcover", fetch=fetch_even_cells))


def count_calls(folder):
    def fetch(keys):
        import os
        import time
        import uuid
        time.sleep(0.1)
        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(f"{os.getpid()} {c}" for c in keys["cell_id"]))
        return fetch_even_cells(keys)
    return fetch


def test_fetch_calls_each_key_once_in_many_tasks(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    occ = occ_df(spark, [row(i, cell=i % 40, date=D1) for i in range(200)])
    spec = FeatureSpec(name="landcover", fetch=count_calls(str(calls)), fetch_tasks=8)
    result = enrich_features(occ, stored_df(spark, []), spec, store_path=str(tmp_path / "t"))
    result.merged.write.format("noop").mode("overwrite").save()
    result.grouped.write.format("noop").mode("overwrite").save()
    lines = [x.split() for p in calls.iterdir() for x in p.read_text().split("\n") if x]
    assert sorted(int(c) for _, c in lines) == list(range(40))
    keys = fx.missing_feature_keys(occ, stored_df(spark, []), spec)
    parts = fx.fetch_missing_features(keys, spec).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_completeness_rule_belongs_to_the_feature(spark):
    occ = occs(spark)
    stored = stored_df(spark, [(1, D1, 0), (2, D1, 3)])
    spec = FeatureSpec(name="landcover", complete=lambda: F.col("landcover") > 0)
    j = fx.join_existing_features(occ, stored, spec)
    assert as_set(fx.complete_rows(j, spec), "id") == {(3,)}
    assert as_set(fx.missing_feature_keys(occ, stored, spec), "cell_id") == {(1,), (3,), (4,)}


def test_vectors_keep_the_place_of_missing_values(spark):
    t = stored_df(spark, [(1, D1, 1), (1, D2, None), (1, D3, 3), (1, D3, 3)])
    assert fx.feature_vectors(t, SPEC).first()["v"] == "1,null,3"
    assert fx.feature_vectors(t, SPEC, as_text=False).first()["v"] == [1, None, 3]
    assert fx.valid_feature_vectors(t, SPEC, 2).first()["n"] == 2
    assert fx.valid_feature_vectors(t, SPEC, 3).count() == 0


def test_grouped_occurrences_returns_every_feature_row(spark):
    merged = fx.combine_features(occs(spark), [
        (SPEC, stored_df(spark, [(1, D1, 5), (3, D2, 6)])),
        (FeatureSpec(name="ndvi", value_cols=("ndvi",)),
         spark.createDataFrame([(1, D1, 2), (2, D1, 3)], "cell_id long, date date, ndvi long"))])
    grouped = fx.grouped_occurrences(merged, [SPEC, FeatureSpec(name="ndvi", value_cols=("ndvi",))])
    two = [("landcover", "5"), ("ndvi", "2")]
    assert feature_rows(grouped) == {1: two, 2: two, 3: [("ndvi", "3")], 4: [("landcover", "6")]}
