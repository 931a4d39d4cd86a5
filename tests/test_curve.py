"""Cells on the curve: ids, coverings with a bounded error, containment joins."""

import math
import random

from pyspark.sql import functions as F

from geotaxa.operators import curve
from helpers import as_set, occ_df, row


def plain_cell(x, y, level):
    code = 0
    for i in range(level):
        code |= (x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1
    return 1 << 2 * level | code


def place(lat, lon, level):
    n = 1 << level
    return math.floor((lon + 180) / 360 * n) % n, min(math.floor((lat + 90) / 180 * n), n - 1)


def test_ids_levels_and_ancestors(spark):
    rng = random.Random(1)
    rows = [(lv := rng.randrange(30), rng.randrange(1 << lv), rng.randrange(1 << lv)) for _ in range(300)]
    df = spark.createDataFrame(rows, "l int, x long, y long").withColumn("c", curve.cell_of(F.col("x"), F.col("y"), F.col("l")))
    df = df.select("*", curve.level_of("c").alias("back"), curve.ancestor("c", F.lit(3)).alias("up"))
    for r in df.collect():
        assert r["c"] == plain_cell(r["x"], r["y"], r["l"]) and r["back"] == r["l"]
        shift = r["l"] - 3
        assert r["up"] == (plain_cell(r["x"] >> shift, r["y"] >> shift, 3) if shift >= 0 else None)


def test_points(spark):
    rows = [(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0), (90.1, 3.0), (10.0, 540.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double").select(curve.point_cell("latitude", "longitude", 5).alias("c"))
    want = [None if la is None or lo is None or abs(la) > 90 else plain_cell(*place(la, lo, 5), 5) for la, lo in rows]
    assert [r["c"] for r in df.collect()] == want


def circle(lat, lon, metres, points=360):
    """Points on the circle around a location."""
    la0, d = math.radians(lat), math.radians(metres / 111_320.0)
    for k in range(points):
        bearing = 2 * math.pi * k / points
        la = math.asin(math.sin(la0) * math.cos(d) + math.cos(la0) * math.sin(d) * math.cos(bearing))
        lo = math.atan2(math.sin(bearing) * math.sin(d) * math.cos(la0), math.cos(d) - math.sin(la0) * math.sin(la))
        yield math.degrees(la), (lon + math.degrees(lo) + 180) % 360 - 180


def test_covering_holds_the_circle_and_little_more(spark):
    rng = random.Random(6)
    rows = [row(i, lat=rng.choice([0.2, 45.3, 60.1, -71.7, 89.9, -89.95, 83.0]), lon=rng.choice([rng.uniform(-180, 180), 179.9999, -179.9999]),
                unc=10 ** rng.uniform(0, 6)) for i in range(120)]
    rows += [row(500, lat=90.5), row(501, lat=1.0, lon=None), row(502, lat=None), row(503, lat=10.0, unc=None)]
    got = {}
    for r in curve.curve_covering(occ_df(spark, rows)).collect():
        got.setdefault(r["id"], []).append(r["cell"])
    assert not {500, 501, 502} & set(got) and got[503]
    for r in rows[:120]:
        cells = set(got[r[0]])
        assert len(cells) == len(got[r[0]]) <= 25
        level, = {(c.bit_length() - 1) // 2 for c in cells}
        # Every cell of a brute-force covering of the circle is there.
        for la, lo in [(r[4], r[5]), *circle(r[4], r[5], max(r[6], 30.0) * (1 - 1e-9))]:
            assert plain_cell(*place(la, lo, level), level) in cells, (r[4:7], la, lo)
        half = max(r[6], 30.0) / 111_320.0
        if abs(r[4]) + half < 90 and level < curve.FINEST:      # bounded error, in the direction that set the level
            wide = math.degrees(math.asin(math.sin(math.radians(half)) / math.cos(math.radians(r[4]))))
            assert 180 / (1 << level) < half * (1 + 1e-9) or 360 / (1 << level) < wide * (1 + 1e-9)


def test_containing_pairs_and_finest_feature(spark):
    rng = random.Random(4)
    cells = [plain_cell(rng.randrange(1 << lv), rng.randrange(1 << lv), lv) for lv in (0, 1, 2, 3, 4) for _ in range(12)]
    left = spark.createDataFrame(list(enumerate(cells)), "id long, cell long")
    right = spark.createDataFrame([(c, i) for i, c in enumerate(sorted(set(cells[::2] + cells[5:20])))], "feature_cell long, value long")
    level = lambda c: (c.bit_length() - 1) // 2
    holds = lambda a, b: level(a) <= level(b) and b >> 2 * (level(b) - level(a)) == a
    features = {r["feature_cell"]: r["value"] for r in right.collect()}
    want = {(i, c, f, v) for i, c in enumerate(cells) for f, v in features.items() if holds(c, f) or holds(f, c)}
    got = curve.containing(left, right, range(5), range(5))
    assert as_set(got, "id", "cell", "feature_cell", "value") == want and got.count() == len(want)
    near = curve.finest_feature(left, right, range(5))
    best = {i: max((f for f in features if holds(f, c)), key=level, default=None) for i, c in enumerate(cells)}
    assert as_set(near, "id", "feature_cell", "value") == {(i, f, features.get(f)) for i, f in best.items()}
    assert near.count() == len(cells)
    assert curve.containing(left.limit(0), right, range(5), range(5)).count() == 0


def test_the_covered_side_is_looked_up_once(spark):
    """Its bits are moved without a lambda a cell, and one join finds both kinds of pairs."""
    from geotaxa.plans.checks import plan_text
    rows = [row(i, lat=(0.3, 60.0, 89.95, -90.0)[i % 4], lon=(-180.0, 179.9, 10.0)[i % 3], unc=10.0 ** (i % 7)) for i in range(40)]
    covering = curve.curve_covering(occ_df(spark, rows))
    plan = plan_text(covering)
    assert "lambda" not in plan and "namedlambdavariable" not in plan.lower()
    features = covering.select(F.col("cell").alias("feature_cell")).distinct().withColumn("value", F.col("feature_cell") % 7)
    pairs = curve.containing(covering, features, range(curve.FINEST + 1), range(curve.FINEST + 1))
    plan = plan_text(pairs)
    assert sum(plan.count(kind) for kind in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")) == 1
    cells = [(r["id"], r["cell"]) for r in covering.collect()]
    level = lambda c: (c.bit_length() - 1) // 2
    holds = lambda a, b: level(a) <= level(b) and b >> 2 * (level(b) - level(a)) == a
    want = {(i, c, f) for i, c in cells for f in {c for _, c in cells} if holds(c, f) or holds(f, c)}
    assert as_set(pairs, "id", "cell", "feature_cell") == want and pairs.count() == len(want)


def test_joins_are_equalities(spark):
    from geotaxa.plans.checks import plan_text
    left = spark.range(5).select("id", (F.col("id") + 4).alias("cell"))
    right = spark.range(5).select((F.col("id") + 4).alias("feature_cell"), F.col("id").alias("value"))
    for df in (curve.containing(left, right, [1], [1]), curve.finest_feature(left, right, [1])):
        plan = plan_text(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
