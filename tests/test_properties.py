"""Property tests on random small inputs (few examples: each runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from geotaxa.operators.dedup import spatial_dedup
from geotaxa.operators.ranking import ordered_rank
from geotaxa.operators.taxa import taxa_threshold
from geotaxa.operators.versions import latest_version
from helpers import as_set, occ_df, row

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

groups = st.sampled_from(["a", "b", None, "hot", "hot", "hot"])
rank_rows = st.lists(st.tuples(groups, st.integers(0, 50)), min_size=0, max_size=120)


@SETTINGS
@given(rank_rows, st.integers(1, 9))
def test_ordered_rank_matches_row_number(spark, rows, parts):
    data = [(g, o, i) for i, (g, o) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, o long, k long")
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("o", "k")))
    got = ordered_rank(df, ["g"], ["o", "k"], num_partitions=parts)
    assert as_set(got, "g", "o", "k", "rank") == as_set(want, "g", "o", "k", "rank")


names = st.sampled_from(["A b", "A b", "C d", "E", None, " F  g "])
occ_rows = st.lists(st.tuples(st.integers(0, 15), names, st.integers(0, 3), st.integers(0, 4)),
                    min_size=0, max_size=80)


def build(spark, rows):
    return occ_df(spark, [row(i, name=n, lat=float(la), price=float(p)) for i, n, la, p in rows])


@SETTINGS
@given(occ_rows)
def test_latest_then_dedup_idempotent_and_subset(spark, rows):
    df = build(spark, rows)
    latest = latest_version(df)
    cols = latest.columns
    assert as_set(latest_version(latest), *cols) == as_set(latest, *cols)
    d = spatial_dedup(latest)
    assert as_set(spatial_dedup(d), *cols) == as_set(d, *cols)
    assert as_set(d, *cols) <= as_set(latest, *cols)
    # one row per identity after latest; one row per dedup key after dedup
    assert latest.count() == latest.select("id", "source").distinct().count()


@SETTINGS
@given(occ_rows, st.integers(0, 6))
def test_taxa_threshold_matches_python(spark, rows, t):
    df = build(spark, rows)
    got = as_set(taxa_threshold(df, threshold=t), "id", "name", "latitude", "price")
    counts = {}
    for _, n, _, _ in rows:
        counts[n] = counts.get(n, 0) + 1
    want = {(i, n, float(la), float(p)) for i, n, la, p in rows
            if n is not None and len(n.split()) > 1 and counts[n] > t}
    assert got == want


place_rows = st.lists(st.tuples(st.integers(0, 2), st.sampled_from([None, 30.0]), st.integers(0, 400)),
                      min_size=0, max_size=90, unique_by=lambda t: t[2])


@SETTINGS
@given(place_rows, st.integers(1, 7))
def test_feature_requests_match_python_groups(spark, rows, size):
    from geotaxa.operators.requests import feature_request_members, feature_requests
    df = occ_df(spark, [row(i, lat=float(la), unc=u) for la, u, i in rows])
    places = {}
    for la, u, i in rows:
        places.setdefault((float(la), u), []).append(i)
    headers = {(r["latitude"], r["coordinate_uncertainty"]): r["n"] for r in feature_requests(df).collect()}
    assert headers == {k: len(v) for k, v in places.items()}
    got = {(r["latitude"], r["coordinate_uncertainty"], r["id"], r["b"])
           for r in feature_request_members(df, batch_size=size).collect()}
    assert got == {(*k, i, n // size) for k, v in places.items() for n, i in enumerate(sorted(v))}


pull_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["F", "G"]),
                               st.integers(0, 10), st.integers(0, 10)), min_size=0, max_size=40)
marks = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["F", "G"]), st.integers(0, 10)),
                 min_size=0, max_size=6)


@SETTINGS
@given(pull_rows, marks, st.sampled_from([None, ["a"], ["a", "c"]]), st.sampled_from([None, 7]))
def test_incremental_pull_matches_python(spark, rows, hist_rows, sources, before):
    import datetime as dt

    from pyspark.sql import types as T

    from geotaxa.sources.sync import incremental_pull
    day = lambda n: dt.datetime(2016, 1, 1) + dt.timedelta(days=n)
    df = occ_df(spark, [row(i, source=s, family=f, updated=day(u), observed=day(o))
                        for i, (s, f, u, o) in enumerate(rows)])
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("family", T.StringType()),
                           T.StructField("fetched_at", T.TimestampNTZType())])
    hist = spark.createDataFrame([(s, f, day(m)) for s, f, m in hist_rows], schema)
    got = as_set(incremental_pull(df, hist, observed_after=day(2), observed_before=day(9),
                                  restrict_sources=sources,
                                  modified_before=day(before) if before is not None else None), "id")
    mark = {}
    for s, f, m in hist_rows:
        mark[(s, f)] = max(m, mark.get((s, f), m))
    want = {(i,) for i, (s, f, u, o) in enumerate(rows)
            if (s, f) in mark and u > mark[(s, f)] and 2 <= o < 9
            and (sources is None or s in sources) and (before is None or u < before)}
    assert got == want


merge_cases = st.tuples(
    st.lists(st.integers(0, 6), min_size=0, max_size=30),                       # occurrence cells
    st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 9))),  # stored value per cell
    st.dictionaries(st.integers(0, 6), st.integers(10, 19)))                      # lookup value per cell


@SETTINGS
@given(merge_cases)
def test_merge_matches_python(spark, case):
    import datetime as dt

    from geotaxa.operators import features as fx
    from geotaxa.operators.features import FeatureSpec
    cells, stored, lookup = case
    d = dt.date(2016, 1, 1)
    occ = occ_df(spark, [row(i, cell=c, date=d) for i, c in enumerate(cells)])
    schema = "cell_id long, date date, landcover long"
    st_df = spark.createDataFrame([(c, d, v) for c, v in stored.items()], schema)
    spec = FeatureSpec(name="landcover", lookup=spark.createDataFrame([(c, d, v) for c, v in lookup.items()], schema))
    fetched = fx.fetch_missing_features(fx.missing_feature_keys(occ, st_df, spec), spec)
    merged = fx.merge_features(occ, st_df, fetched, spec)
    want = {(i, stored[c] if stored.get(c) is not None else lookup.get(c)) for i, c in enumerate(cells)}
    assert merged.count() == len(cells)
    assert as_set(merged, "id", "landcover") == want
