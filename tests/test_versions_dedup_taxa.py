import datetime as dt


from geotaxa.functions.words import is_multiword, word_count
from geotaxa.operators.dedup import one_request_per_cell, spatial_dedup
from geotaxa.operators.taxa import name_distribution, taxa_threshold, top_names, valid_names
from geotaxa.operators.versions import latest_version
from geotaxa.plans.jobs import read_occurrences
from helpers import T0, as_set, occ_df, row


def test_latest_version_keeps_newest_and_breaks_ties_by_price(spark):
    later = T0 + dt.timedelta(days=1)
    df = occ_df(spark, [
        row(1, updated=T0, price=5.0),
        row(1, updated=later, price=1.0),        # newest wins
        row(2, updated=T0, price=1.0),
        row(2, updated=T0, price=3.0),           # equal time: higher price wins
        row(2, source="idigbio", updated=T0),    # other identity
    ])
    out = latest_version(df, tie_break=["price"])
    assert out.columns == df.columns              # no helper column leaks
    assert as_set(out, "id", "source", "price") == {(1, "gbif", 1.0), (2, "gbif", 3.0), (2, "idigbio", 1.0)}


def test_latest_version_is_idempotent(spark):
    df = occ_df(spark, [row(i % 3, price=float(i)) for i in range(9)])
    once = latest_version(df)
    assert as_set(latest_version(once), *df.columns) == as_set(once, *df.columns)


def test_spatial_dedup_groups_null_uncertainty_and_is_idempotent(spark):
    df = occ_df(spark, [
        row(1, unc=None), row(2, unc=None),      # NULL uncertainty: one group
        row(3, unc=30.0), row(4, unc=30.0, source="aaa"),
        row(5, lat=float("nan")), row(6, lat=float("nan")),   # NaN: one group
        row(7, lat=0.0), row(8, lat=-0.0),       # -0.0 equals 0.0
    ])
    out = spatial_dedup(df)
    assert as_set(out, "id") == {(1,), (4,), (5,), (7,)}
    assert as_set(spatial_dedup(out), "id") == as_set(out, "id")


def test_one_request_per_cell(spark):
    df = occ_df(spark, [row(3, cell=1), row(2, cell=1), row(9, cell=2, source="a")])
    assert as_set(one_request_per_cell(df), "cell_id", "id") == {(1, 2), (2, 9)}


def test_word_test_matches_python_split(spark):
    names = ["Amanita muscaria", "Amanita", "  Amanita  ", "Amanita muscaria",
             "a\tb", "a\x1cb", "", "   ", None, "  x  y  z "]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: (r["wc"], r["mw"]) for r in
           df.select("name", word_count("name").alias("wc"), is_multiword("name").alias("mw")).collect()}
    for n in names:
        if n is None:
            assert got[None][1] is False
        else:
            assert got[n] == (len(n.split()), len(n.split()) > 1), repr(n)


def test_taxa_threshold_is_strict_and_needs_two_words(spark):
    rows = ([row(i, name="Amanita muscaria", lat=float(i)) for i in range(4)]      # 4 rows
            + [row(10 + i, name="Boletus edulis", lat=float(i)) for i in range(3)]  # exactly 3
            + [row(20 + i, name="Amanita", lat=float(i)) for i in range(5)]         # one word
            + [row(30 + i, name=None, lat=float(i)) for i in range(5)])             # null
    df = occ_df(spark, rows)
    out = taxa_threshold(df, threshold=3)
    assert {r["name"] for r in out.select("name").distinct().collect()} == {"Amanita muscaria"}
    assert out.count() == 4
    # subset of the input
    assert as_set(out, "id") <= as_set(df, "id")
    # inclusive variant counts null as a group and has no word test
    vn = {r["name"]: r["c"] for r in valid_names(df, threshold=3).collect()}
    assert vn == {"Amanita muscaria": 4, "Boletus edulis": 3, "Amanita": 5, None: 5}


def test_name_distribution_and_top_names(spark):
    df = occ_df(spark, [row(i, name=n) for i, n in enumerate(["a b", "a b", "c d", None, None, None])])
    assert as_set(name_distribution(df), "name", "c") == {("a b", 2), ("c d", 1), (None, 3)}
    assert [tuple(r) for r in top_names(df, n=1).collect()] == [("a b", 2)]


def test_read_occurrences_flagship(spark):
    later = T0 + dt.timedelta(days=1)
    rows = [row(i, name="Amanita muscaria", lat=float(i)) for i in range(3)]
    rows += [row(0, name="Amanita muscaria", lat=0.0, updated=later, price=0.0)]   # newer version
    rows += [row(100, name="Amanita muscaria", lat=1.0, source="zzz")]             # duplicate place
    out = read_occurrences(occ_df(spark, rows), threshold=2)
    assert as_set(out, "id", "source") == {(0, "gbif"), (1, "gbif"), (2, "gbif")}
    assert out.count() == 3


def test_empty_inputs(spark):
    empty = occ_df(spark, [])
    assert read_occurrences(empty).count() == 0
    assert spatial_dedup(empty).count() == 0
    assert latest_version(empty).count() == 0


def test_latest_version_settles_full_ties_by_values(spark):
    a = row(1, name="b b", updated=T0, price=1.0)
    b = row(1, name="a a", updated=T0, price=1.0)
    for rows in ([a, b], [b, a]):
        out = latest_version(occ_df(spark, rows))
        assert [r["name"] for r in out.collect()] == ["a a"]


def test_taxa_threshold_keeps_columns_and_all_rows_of_a_popular_name(spark):
    rows = [row(i, name="Hot taxon", lat=float(i % 50), price=float(i)) for i in range(400)]
    rows += [row(1000 + i, name=f"Other n{i % 7}", lat=float(i)) for i in range(70)]
    df = occ_df(spark, rows)
    out = taxa_threshold(df, threshold=9)
    assert out.columns == df.columns and out.count() == 470


def test_records_without_a_price_column(spark):
    later = T0 + dt.timedelta(days=1)
    df = occ_df(spark, [row(1, updated=T0, name="a b"), row(1, updated=later, name="c d")]).drop("price")
    out = latest_version(df)
    assert [r["name"] for r in out.collect()] == ["c d"]
    assert read_occurrences(df, threshold=0).count() == 1


def test_two_projections_pick_one_version(spark):
    import pytest
    df = occ_df(spark, [row(1, name="zz old", cell=1, price=2.0), row(1, name="aa new", cell=9, price=1.0),
                        row(2, name="b c", cell=3, price=1.0)])
    keys = ["id", "source", "updated_at", "price"]
    a = latest_version(df.select(*keys, "name"), tie_break=["price"])
    b = latest_version(df.select(*keys, "cell_id"), tie_break=["price"])
    assert as_set(a, "id", "name") == {(1, "zz old"), (2, "b c")}
    assert as_set(b, "id", "cell_id") == {(1, 1), (2, 3)}
    with pytest.raises(ValueError, match="tie-break"):
        latest_version(df.select("id", "source", "updated_at"), tie_break=["price"])


def test_read_occurrences_dedups_by_the_given_name_column(spark):
    from pyspark.sql import functions as F
    df = occ_df(spark, [row(1, name="given one"), row(2, name="given two")]).withColumn("scientific_name", F.lit("Amanita muscaria"))
    assert read_occurrences(df, threshold=0, name_col="scientific_name").count() == 1
    assert read_occurrences(df, threshold=0).count() == 2
