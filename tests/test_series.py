"""As-of features and fixed-length windows against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from geotaxa.operators import features as fx
from geotaxa.operators.features import FeatureSpec
from geotaxa.operators.requests import batched_requests, covering_cells, first_batches, sample_batches
from geotaxa.operators.series import asof_features, dense_series, feature_windows
from helpers import as_set, occ_df, row

SPEC = FeatureSpec(name="landcover")
D = dt.date(2016, 1, 1)


def day(n):
    return D + dt.timedelta(days=n)


def table_df(spark, rows):
    return spark.createDataFrame(rows, "cell_id long, date date, landcover long")


def random_case(seed, n=3000, cells=12):
    rng = random.Random(seed)
    occ = [row(i, cell=None if i % 97 == 0 else 1 if i % 3 == 0 else rng.randrange(cells), date=None if i % 89 == 0 else day(rng.randrange(400)))
           for i in range(n)]
    feats = [(rng.randrange(cells + 2), day(rng.randrange(400)), rng.choice([None, *range(9)])) for _ in range(150)]
    return occ, feats + [(None, D, 1), (1, None, 2), feats[0]]


def picked(feats):
    """One value per key: a value before none, then the largest."""
    out = {}
    for c, d, v in feats:
        if c is not None and d is not None:
            old = out.get((c, d))
            out[c, d] = v if old is None else max(old, v) if v is not None else old
    return out


def test_asof_equals_a_plain_search(spark):
    for seed, tolerance in ((1, None), (2, 20), (3, 0)):
        occ, feats = random_case(seed)
        best = picked(feats)
        want = set()
        for r in occ:
            c, d = r[11], r[8 - 1]
            near = None if c is None or d is None else max((fd for fc, fd in best if fc == c and fd <= d), default=None)
            if near is not None and tolerance is not None and (d - near).days > tolerance:
                near = None
            want.add((r[0], best[c, near] if near else None, near))
        df = asof_features(occ_df(spark, occ).repartition(3), table_df(spark, feats), SPEC, tolerance)
        assert df.count() == len(occ)
        assert as_set(df, "id", "landcover", "feature_date") == want


def test_asof_carries_across_ranges_batches_and_empty_sides(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    occ = [row(i, cell=1, date=day(i % 300)) for i in range(900)]
    feats = [(1, day(0), 5), (0, day(0), 1), (2, day(0), 2)]           # one feature serves every range
    try:
        for size in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            out = asof_features(occ_df(spark, occ), table_df(spark, feats), SPEC)
            assert as_set(out, "landcover", "feature_date") == {(5, D)} and out.count() == 900
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert as_set(asof_features(occ_df(spark, occ[:3]), table_df(spark, []), SPEC), "id", "landcover") == {(0, None), (1, None), (2, None)}
    assert asof_features(occ_df(spark, []), table_df(spark, feats), SPEC).count() == 0
    clash = occ_df(spark, occ[:5]).withColumn("landcover", F.lit("x")).withColumn("feature_date", F.lit("x")).withColumn("_pid", F.lit("x"))
    assert as_set(asof_features(clash, table_df(spark, feats), SPEC), "landcover") == {(5,)}


def test_asof_with_several_keys_and_values(spark):
    spec = FeatureSpec(name="climate", key_cols=("cell_id", "source", "date"), value_cols=("t", "rain"))
    feats = spark.createDataFrame([(1, "gbif", day(1), 1.5, "a"), (1, "gbif", day(3), 2.5, None), (1, "x", day(2), 9.0, "z")],
                                  "cell_id long, source string, date date, t double, rain string")
    out = asof_features(occ_df(spark, [row(i, cell=1, date=day(i)) for i in range(5)]), feats, spec)
    assert as_set(out, "id", "t", "rain") == {(0, None, None), (1, 1.5, "a"), (2, 1.5, "a"), (3, 2.5, None), (4, 2.5, None)}


def test_windows_equal_plain_slices(spark):
    for step, number in (("day", lambda d: d.toordinal()), ("month", lambda d: d.year * 12 + d.month)):
        occ, feats = random_case(7, 600)
        best = {k: v for k, v in picked(feats).items() if v is not None}
        latest = {}
        for (c, d), v in sorted(best.items()):
            latest[c, number(d)] = v
        want = set()
        for r in occ:
            c, d = r[11], r[7]
            cut = [None] * 5 if c is None or d is None else [latest.get((c, number(d) - 4 + k)) for k in range(5)]
            want.add((r[0], str(cut), sum(v is not None for v in cut)))
        got = feature_windows(occ_df(spark, occ), table_df(spark, feats), SPEC, 5, step).collect()
        assert {(r["id"], str(r["window"]), r["n_values"]) for r in got} == want and len(got) == len(occ)


def test_dense_series_is_as_long_as_its_calendar(spark):
    rows = [(1, day(0), 4), (1, day(1), None), (1, day(3), 6), (2, day(9), 1)]
    got = {r["cell_id"]: (r["first"], r["series"]) for r in dense_series(table_df(spark, rows), SPEC).collect()}
    start = (D - dt.date(1970, 1, 1)).days
    assert got == {1: (start, [4, None, None, 6]), 2: (start + 9, [1])}
    assert dense_series(table_df(spark, []), SPEC).count() == 0


def test_one_row_per_key_of_each_kind(spark):
    at = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    rows = [(1, D, 3, False, at(0)), (1, D, 9, False, at(0)), (1, D, 1, True, at(1)), (1, D, None, False, at(5)),
            (2, D, None, False, None), (2, D, None, True, at(1)), (3, D, 7, None, None), (3, D, 8, None, at(-90000)), (None, D, 1, True, at(0))]
    schema = "cell_id long, date date, landcover {}, fetched boolean, appended_at timestamp_ntz"
    want = {(1, "1", True), (2, None, True), (3, "8", False)}
    for kind, make in (("long", int), ("double", float), ("string", str)):
        typed = [(c, d, None if v is None else make(v), f, a) for c, d, v, f, a in rows]
        got = fx.one_row_per_key(spark.createDataFrame(typed, schema.format(kind)), SPEC)
        assert {(r["cell_id"], None if r["landcover"] is None else str(r["landcover"]).removesuffix(".0"), r["fetched"]) for r in got.collect()} == want
    two = FeatureSpec(name="two", value_cols=("a", "b"))
    pairs = spark.createDataFrame([(1, D, 2, 1), (1, D, 2, 5), (1, D, 1, 9), (1, D, None, 10), (2, D, None, 4)], "cell_id long, date date, a long, b long")
    assert as_set(fx.one_row_per_key(pairs, two), "cell_id", "a", "b", "fetched") == {(1, 2, 5, False), (2, None, 4, False)}


def test_first_batches_are_the_sampled_ones(spark):
    rng = random.Random(3)
    occ = occ_df(spark, [row(i, family=rng.choice([None, "A", "B", "C"])) for i in range(70)])
    for n, size in ((1, 5), (3, 7), (6, 9), (50, 4)):
        want = sample_batches(batched_requests(occ, batch_size=size), n)
        got = first_batches(occ, n, batch_size=size)
        assert as_set(got, "family", "b", "id") == as_set(want, "family", "b", "id")


def test_covering_holds_every_cell_a_circle_touches(spark):
    """Points around wide circles far from the equator lie in covered cells."""
    import math

    step, rng = 0.5, random.Random(2)
    rows = [row(i, lat=rng.choice([60.0, -60.0, 45.2, 75.0, 3.0]), lon=rng.uniform(-179, 179), unc=rng.uniform(1e3, 2.0e6)) for i in range(40)]
    got = {}
    for r in covering_cells(occ_df(spark, rows), step).collect():
        got.setdefault(r["id"], set()).add(r["cell"])
    ncols = int(360 / step)
    for r in rows:
        lat, lon, d = math.radians(r[4]), math.radians(r[5]), math.radians(r[6] / 111_320.0)
        for k in range(720):
            bearing = math.radians(k / 2)
            la = math.asin(math.sin(lat) * math.cos(d) + math.cos(lat) * math.sin(d) * math.cos(bearing))
            lo = lon + math.atan2(math.sin(bearing) * math.sin(d) * math.cos(lat), math.cos(d) - math.sin(lat) * math.sin(la))
            la, lo = math.degrees(la) * (1 - 1e-9), (math.degrees(lo) + 180) % 360 - 180
            lo = lo - (lo - r[5]) * 1e-9 if abs(lo - r[5]) < 180 else lo
            cell = (math.floor(la / step) + int(90 / step)) * ncols + (math.floor(lo / step) + int(180 / step)) % ncols
            assert cell in got[r[0]], (r[4:7], k)
