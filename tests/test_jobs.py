import datetime as dt
import json

from pyspark.sql import types as T

from geotaxa.operators.metrics import job_counters, observe_counters
from geotaxa.plans.jobs import harvest
from geotaxa.session import ensure_checkpoint_dir
from geotaxa.sources import sync
from helpers import T0, as_set, occ_df, row

HIST = T.StructType([T.StructField("source", T.StringType()), T.StructField("family", T.StringType()),
                     T.StructField("fetched_at", T.TimestampNTZType())])


def test_harvest_pulls_normalizes_and_writes_json(spark, tmp_path):
    later = T0 + dt.timedelta(days=1)
    raw = occ_df(spark, [row(1, name="amanita muscaria", updated=later),
                         row(2, name="nothing known", updated=later),
                         row(3, name="amanita muscaria", updated=T0)])          # not after the mark
    history = spark.createDataFrame([("gbif", "AMANITACEAE", T0)], HIST)
    names = spark.createDataFrame([("amanita muscaria", "Amanita muscaria")],
                                  "given_name string, scientific_name string")
    out = str(tmp_path / "occurrences")
    got = harvest(raw, history, names, out_path=out)
    assert as_set(got, "id", "scientific_name") == {(1, "Amanita muscaria"), (2, None)}
    lines = [json.loads(l) for p in (tmp_path / "occurrences").glob("part-*.json") for l in p.read_text().splitlines()]
    assert [(d["id"], d["name"]) for d in lines] == [(1, "Amanita muscaria")]   # unresolved row not written
    assert set(lines[0]) >= {"id", "source", "latitude", "date", "updated_at"}


def test_next_marks_advance_per_source_family(spark):
    later = T0 + dt.timedelta(days=2)
    pulled = occ_df(spark, [row(1, updated=T0), row(2, updated=later), row(3, source="x", updated=T0)])
    assert as_set(sync.next_marks(pulled), "source", "fetched_at") == {("gbif", later), ("x", T0)}


def test_next_marks_keep_old_mark_when_nothing_pulled(spark):
    later = T0 + dt.timedelta(days=2)
    pulled = occ_df(spark, [row(1, updated=later)])
    history = spark.createDataFrame([("gbif", "AMANITACEAE", T0), ("gbif", "OTHER", T0)], HIST)
    got = as_set(sync.next_marks(pulled, history), "family", "fetched_at")
    assert got == {("AMANITACEAE", later), ("OTHER", T0)}


def test_counters(spark):
    df = occ_df(spark, [row(1, name=None, unc=None), row(2), row(3)])
    named = job_counters({"rows": df, "without_name": df.where("name is null")})
    assert as_set(named, "counter", "value") == {("rows", 3), ("without_name", 1)}
    observed, obs = observe_counters(df, "read")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"read.rows": 3}


def test_checkpoint_dir_is_taken_from_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_counters_on_empty_input_are_zero(spark):
    assert as_set(job_counters({"rows": occ_df(spark, [])}), "counter", "value") == {("rows", 0)}
