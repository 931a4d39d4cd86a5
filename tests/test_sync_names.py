import datetime as dt

from pyspark.sql import types as T

from geotaxa.operators.names import normalize_names
from geotaxa.sources import sync
from helpers import T0, as_set, occ_df, row

HIST = T.StructType([T.StructField("source", T.StringType()), T.StructField("family", T.StringType()),
                     T.StructField("fetched_at", T.TimestampNTZType())])


def hist(spark, rows):
    return spark.createDataFrame(rows, HIST)


def test_incremental_pull_strictly_after_mark_and_windowed(spark):
    mark = T0
    raw = occ_df(spark, [
        row(1, updated=mark),                                   # equal to the mark: not pulled
        row(2, updated=mark + dt.timedelta(seconds=1)),         # after: pulled
        row(3, updated=mark + dt.timedelta(days=1), observed=dt.datetime(2014, 12, 31)),  # before window
        row(4, updated=mark + dt.timedelta(days=1), observed=dt.datetime(2019, 1, 1)),    # window is half-open
        row(5, source="nohistory", updated=mark + dt.timedelta(days=1)),                  # no history
        row(6, family="OTHER", updated=mark + dt.timedelta(days=1)),                      # other family
    ])
    h = hist(spark, [("gbif", "AMANITACEAE", mark), ("gbif", "OTHER", mark + dt.timedelta(days=2))])
    out = sync.incremental_pull(raw, h)
    assert as_set(out, "id") == {(2,)}


def test_overlapping_history_rows_do_not_duplicate(spark):
    raw = occ_df(spark, [row(1, updated=T0 + dt.timedelta(days=3))])
    h = hist(spark, [("gbif", "AMANITACEAE", T0), ("gbif", "AMANITACEAE", T0 + dt.timedelta(days=1))])
    assert sync.incremental_pull(raw, h).count() == 1
    # the latest mark applies
    h2 = hist(spark, [("gbif", "AMANITACEAE", T0), ("gbif", "AMANITACEAE", T0 + dt.timedelta(days=5))])
    assert sync.incremental_pull(raw, h2).count() == 0


def test_restrictions_and_upper_bound(spark):
    raw = occ_df(spark, [row(1, updated=T0 + dt.timedelta(days=1)),
                         row(2, source="idigbio", updated=T0 + dt.timedelta(days=1)),
                         row(3, updated=T0 + dt.timedelta(days=10))])
    h = hist(spark, [("gbif", "AMANITACEAE", T0), ("idigbio", "AMANITACEAE", T0)])
    out = sync.incremental_pull(raw, h, restrict_sources=["gbif"],
                                modified_before=T0 + dt.timedelta(days=5))
    assert as_set(out, "id") == {(1,)}
    assert sync.pending_pull_count(h, restrict_sources=["gbif"]).first()["n"] == 1


def test_sync_queue_provider_without_history_yields_nothing(spark):
    h = hist(spark, [("idigbio", "A", T0), ("idigbio", "B", T0), ("other", "A", T0), (None, "A", T0)])
    assert as_set(sync.sync_queue(h), "source", "family") == {("idigbio", "A"), ("idigbio", "B")}
    assert as_set(sync.sync_queue(h, ["gbif", "other"]), "source", "family") == {("other", "A")}


def test_empty_history_pulls_nothing(spark):
    raw = occ_df(spark, [row(1)])
    assert sync.incremental_pull(raw, hist(spark, [])).count() == 0


def test_normalize_names_once_per_name(spark):
    occ = occ_df(spark, [row(1, name="amanita muscaria"), row(2, name="amanita muscaria"),
                         row(3, name="unknown thing"), row(4, name=None)])
    lookup = spark.createDataFrame([("amanita muscaria", "Amanita muscaria L.")],
                                   "given_name string, scientific_name string")
    out = normalize_names(occ, lookup)
    assert out.count() == 4
    assert as_set(out, "id", "scientific_name") == {
        (1, "Amanita muscaria L."), (2, "Amanita muscaria L."), (3, None), (4, None)}
    assert normalize_names(occ, lookup, drop_unresolved=True).count() == 2


def test_normalize_names_spreads_a_popular_name(spark):
    occ = occ_df(spark, [row(i, name="amanita muscaria" if i % 3 else "other name") for i in range(60)])
    lookup = spark.createDataFrame([("amanita muscaria", "A"), ("other name", "O"), ("x y", "X")],
                                   "given_name string, scientific_name string")
    big = normalize_names(occ, lookup)
    assert as_set(big, "id", "scientific_name") == {(i, "A" if i % 3 else "O") for i in range(60)}
    assert big.count() == 60 and big.columns == [*occ.columns, "scientific_name"]


def test_pull_across_a_clock_change_in_another_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Europe/Berlin", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            mark = dt.datetime(2021, 3, 14, 2, 10)
            raw = occ_df(spark, [row(1, updated=dt.datetime(2021, 3, 14, 2, 45)), row(2, updated=mark)])
            h = hist(spark, [("gbif", "AMANITACEAE", mark)])
            assert as_set(sync.incremental_pull(raw, h), "id") == {(1,)}
            zoned = raw.withColumn("updated_at", raw["updated_at"].cast("timestamp"))
            hz = h.withColumn("fetched_at", h["fetched_at"].cast("timestamp"))
            want = as_set(sync.incremental_pull(zoned, hz, prune_with_min_mark=False), "id")
            assert as_set(sync.incremental_pull(zoned, hz), "id") == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_pull_with_nulls_in_the_history(spark):
    raw = occ_df(spark, [row(1, updated=T0 + dt.timedelta(days=1)), row(2, source=None, updated=T0 + dt.timedelta(days=1))])
    h = hist(spark, [(None, "AMANITACEAE", T0), ("gbif", None, T0), ("gbif", "AMANITACEAE", T0), ("x", "Y", None)])
    assert as_set(sync.incremental_pull(raw, h), "id") == {(1,)}
    assert sync.incremental_pull(raw, hist(spark, [("gbif", "AMANITACEAE", None)])).count() == 0


def test_building_a_pull_runs_no_job_and_leaves_no_cache(spark):
    status = spark.sparkContext.statusTracker()
    raw = occ_df(spark, [row(1)])
    h = hist(spark, [("gbif", "AMANITACEAE", T0)])
    spark.sparkContext.setJobGroup("build", "build")
    normalize_names(sync.incremental_pull(raw, h), spark.createDataFrame([("a", "b")], "given_name string, scientific_name string"))
    assert not status.getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("", "")
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_marks_stay_before_unwritten_records(spark):
    from pyspark.sql import functions as F
    days = [T0 + dt.timedelta(days=d) for d in range(6)]
    pulled = occ_df(spark, [row(1, updated=days[1]), row(2, updated=days[3], name=None), row(3, updated=days[4]),
                            row(4, source="x", updated=days[2], name=None)])
    h = hist(spark, [("gbif", "AMANITACEAE", T0), ("x", "AMANITACEAE", T0)])
    got = as_set(sync.next_marks(pulled, h, F.col("name").isNull()), "source", "fetched_at")
    assert got == {("gbif", days[1]), ("x", T0)}


def test_default_window_is_2015_to_2019(spark):
    from geotaxa.sources import fixture
    sf = "/root/testdata/sf0.001"
    # the fixture's observations run 1995..2001: the default window pulls nothing
    assert sync.incremental_pull(fixture.occ(spark, sf), fixture.sync_history(spark, sf)).count() == 0
    inside = occ_df(spark, [row(1, observed=dt.datetime(2015, 1, 1), updated=T0 + dt.timedelta(days=1)),
                            row(2, observed=dt.datetime(2018, 12, 31, 23, 59), updated=T0 + dt.timedelta(days=1))])
    assert sync.incremental_pull(inside, hist(spark, [("gbif", "AMANITACEAE", T0)])).count() == 2


def test_normalize_names_replaces_an_existing_scientific_name(spark):
    from pyspark.sql import functions as F
    occ = occ_df(spark, [row(1, name="amanita muscaria")]).withColumn("scientific_name", F.lit("old"))
    lookup = spark.createDataFrame([("amanita muscaria", "new")], "given_name string, scientific_name string")
    out = normalize_names(occ, lookup)
    assert out.columns.count("scientific_name") == 1
    assert out.first()["scientific_name"] == "new"


def test_pull_without_observation_times(spark):
    raw = occ_df(spark, [row(1, updated=T0 + dt.timedelta(days=1))]).drop("observed_at")
    h = hist(spark, [("gbif", "AMANITACEAE", T0)])
    assert sync.incremental_pull(raw, h, observed_after=None, observed_before=None).count() == 1
