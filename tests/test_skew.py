"""Hot keys: a third or more of the rows on one key.

Joins are forced to shuffle (broadcast off) and AQE's skew thresholds are
lowered to test size, then the final plans are read."""

import datetime as dt

import pytest

from geotaxa.operators import features as fx
from geotaxa.operators.features import FeatureSpec
from geotaxa.operators.names import normalize_names
from geotaxa.operators.taxa import taxa_threshold
from geotaxa.plans.checks import plan_text
from helpers import occ_df, row

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
D1 = dt.date(2016, 1, 1)


@pytest.fixture
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    p = plan_text(df)
    return p[:p.find("Initial Plan")]


def test_feature_join_and_merge_split_a_hot_cell(skew_session):
    spark = skew_session
    rows = [row(i, cell=1, date=D1, price=float(i)) for i in range(20000)]
    rows += [row(100000 + i, cell=i % 50 + 2, date=D1) for i in range(2000)]
    occ = occ_df(spark, rows)
    stored = spark.createDataFrame([(c, D1, c % 7) for c in range(40)], "cell_id long, date date, landcover long")
    lookup = spark.createDataFrame([(c, D1, c % 5) for c in range(60)], "cell_id long, date date, landcover long")
    spec = FeatureSpec(name="landcover", lookup=lookup)
    joined = fx.join_existing_features(occ, stored, spec)
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    fetched = fx.fetch_missing_features(fx.missing_feature_keys(occ, stored, spec), spec)
    merged = fx.merge_features(occ, stored, fetched, spec)
    assert "SortMergeJoin(skew=true)" in final_plan(merged)
    assert merged.count() == len(rows)


def test_combining_two_features_splits_a_hot_cell(skew_session):
    spark = skew_session
    rows = [row(i, cell=1, date=D1, price=float(i)) for i in range(20000)]
    rows += [row(100000 + i, cell=i % 50 + 2, date=D1) for i in range(2000)]
    occ = occ_df(spark, rows)
    schema = "cell_id long, date date, {} long"
    a = spark.createDataFrame([(c, D1, c % 7) for c in range(60)], schema.format("landcover"))
    b = spark.createDataFrame([(c, D1, c % 5) for c in range(60)], schema.format("ndvi"))
    out = fx.combine_features(occ, [(FeatureSpec(name="landcover"), a), (FeatureSpec(name="ndvi", value_cols=("ndvi",)), b)])
    p = final_plan(out)
    # one join of the occurrences, and it is split
    assert p.count("SortMergeJoin(skew=true)") == 1
    assert out.count() == len(rows)


def name_rows():
    rows = [row(i, name="Hot taxon", lat=float(i % 500), price=float(i)) for i in range(20000)]
    return rows + [row(100000 + i, name=f"Other n{i % 40}", lat=float(i)) for i in range(3000)]


def test_hot_name_is_split_in_the_taxa_filter_and_the_lookup(skew_session):
    spark = skew_session
    df = occ_df(spark, name_rows())
    out = taxa_threshold(df, threshold=10)
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    assert out.count() == df.count()
    lookup = spark.createDataFrame([("Hot taxon", "H")] + [(f"Other n{i}", "O") for i in range(30)], "given_name string, scientific_name string")
    named = normalize_names(df, lookup)
    assert "SortMergeJoin(skew=true)" in final_plan(named)
    assert named.where("scientific_name = 'H'").count() == 20000 and named.count() == df.count()


def test_key_side_does_not_grow_with_the_partitions(skew_session):
    """With 2,000 shuffle partitions the names that enter the join are as many
    as there are names."""
    spark = skew_session
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        df = occ_df(spark, name_rows())
        for out in (taxa_threshold(df, threshold=10), normalize_names(df, spark.createDataFrame([("Hot taxon", "H")], "given_name string, scientific_name string"))):
            plan = final_plan(out)
            assert "Generate" not in plan and "explode" not in plan and "_salt" not in plan
            assert out.count() == df.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_asof_splits_a_hot_cell_of_one_date(spark):
    """Ranges of the sorted order, no window over the cell and no join on it."""
    from geotaxa.operators.series import asof_features
    rows = [row(i, cell=1, date=D1) for i in range(20000)] + [row(100000 + i, cell=i % 50 + 2, date=D1) for i in range(2000)]
    feats = spark.createDataFrame([(c, D1 - dt.timedelta(days=c), c) for c in range(1, 40)], "cell_id long, date date, landcover long")
    out = asof_features(occ_df(spark, rows), feats, FeatureSpec(name="landcover"))
    assert out.where("cell_id = 1 and landcover = 1").count() == 20000 and out.count() == len(rows)
    path = [f for f in out.inputFiles()][0].rsplit("/", 1)[0]
    held = spark.read.parquet(path).where("cell_id = 1").groupBy("_pid").count().collect()
    assert len(held) >= 6 and max(r["count"] for r in held) < 6000
