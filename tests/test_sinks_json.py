import pytest
from pyspark.sql import functions as F

from geotaxa.functions.json import from_json_record, strict_json, to_json_record
from geotaxa.schemas import OCCURRENCE_SCHEMA, decode_rows, schema_from_fields
from geotaxa.sinks.writers import append_table, enforce_schema, occurrence_rows, write_json_lines
from helpers import occ_df, row

FIELDS = [("id", "INTEGER", "REQUIRED"), ("name", "STRING", "NULLABLE"), ("latitude", "FLOAT", "REQUIRED")]


def test_json_keeps_nulls_and_roundtrips(spark):
    df = occ_df(spark, [row(1, name=None, unc=None)]).select("id", "name", "coordinate_uncertainty")
    text = df.select(to_json_record(df.columns).alias("j")).first()["j"]
    assert text == '{"id":1,"name":null,"coordinate_uncertainty":null}'
    schema = "id long, name string, coordinate_uncertainty double"
    back = spark.createDataFrame([(text,)], "j string").select(from_json_record("j", schema).alias("r")).select("r.*")
    assert back.first().asDict() == {"id": 1, "name": None, "coordinate_uncertainty": None}


def test_strict_json_rejects_nan(spark):
    df = occ_df(spark, [row(1, lat=float("nan"))]).select("id", "latitude")
    with pytest.raises(Exception, match="JSON cannot write"):
        df.select(strict_json(df)).collect()


def test_json_decode_rejects_bare_nan(spark):
    df = spark.createDataFrame([('{"x": NaN}',)], "j string")
    with pytest.raises(Exception):
        df.select(from_json_record("j", "x double").alias("r")).collect()


def test_enforce_schema_casts_and_guards_required(spark):
    df = spark.createDataFrame([("1", "a", "2.5")], "id string, name string, latitude string")
    out = enforce_schema(df, FIELDS)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "string", "double"]
    assert out.first().asDict() == {"id": 1, "name": "a", "latitude": 2.5}
    bad = spark.createDataFrame([("1", None, None)], "id string, name string, latitude string")
    with pytest.raises(Exception, match="REQUIRED column latitude"):
        enforce_schema(bad, FIELDS).collect()


def test_schema_triples():
    s = schema_from_fields([("a", "STRING", "REQUIRED"), ("b", "FLOAT", "REPEATED")])
    assert not s["a"].nullable and s["b"].dataType.simpleString() == "array<double>"


def test_decode_rows_declared_order(spark):
    df = occ_df(spark, [row(1)])
    assert decode_rows(df).columns == OCCURRENCE_SCHEMA.fieldNames()


def test_occurrence_rows_drop_unformattable(spark):
    df = occ_df(spark, [row(1), row(2)]).withColumn(
        "scientific_name", F.when(F.col("id") == 1, F.lit("A b")).otherwise(F.lit(None)))
    out = occurrence_rows(df, fields=FIELDS)
    assert [tuple(r) for r in out.collect()] == [(1, "A b", 1.0)]


def test_json_lines_writer_and_append(spark, tmp_path):
    df = occ_df(spark, [row(1, name=None), row(2)]).select("id", "name")
    path = str(tmp_path / "json")
    write_json_lines(df, path)
    files = [p.name for p in (tmp_path / "json").iterdir() if p.name.startswith("part-")]
    assert files and all(f.endswith(".json") for f in files)
    lines = sorted(l for f in files for l in (tmp_path / "json" / f).read_text().splitlines())
    assert lines == ['{"id":1,"name":null}', '{"id":2,"name":"Amanita muscaria"}']
    nan = occ_df(spark, [row(3, lat=float("nan"))]).select("id", "latitude")
    with pytest.raises(Exception):
        write_json_lines(nan, str(tmp_path / "nan"))
    tpath = str(tmp_path / "t")
    append_table(df, tpath)
    append_table(df, tpath)
    assert spark.read.parquet(tpath).count() == 4


def test_append_occurrences_partitioned_by_source_prunes(spark, tmp_path):
    from geotaxa.plans.checks import plan_text
    from geotaxa.sinks.writers import append_occurrences
    df = occ_df(spark, [row(1), row(2, source="idigbio"), row(3)]).withColumn(
        "scientific_name", F.when(F.col("id") == 3, F.lit(None)).otherwise(F.col("name")))
    path = str(tmp_path / "occ")
    append_occurrences(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 2
    assert sorted(p.name for p in (tmp_path / "occ").iterdir() if p.is_dir()) == ["source=gbif", "source=idigbio"]
    q = back.where(F.col("source") == "gbif")
    assert "PartitionFilters: [isnotnull(source" in plan_text(q) and q.count() == 1


def test_json_lines_file_roundtrip(spark, tmp_path):
    from geotaxa.sources.files import read_json_records
    df = enforce_schema(occ_df(spark, [row(1, name=None, unc=None), row(2)]), FIELDS)
    path = str(tmp_path / "rt")
    write_json_lines(df, path)
    back = read_json_records(spark, path, schema_from_fields(FIELDS))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.json").write_text('{"id": 1, "name": "x", "latitude": NaN}\n')
    with pytest.raises(Exception):
        read_json_records(spark, str(bad), schema_from_fields(FIELDS)).collect()


def test_feature_table_schema():
    from geotaxa.operators.features import FeatureSpec, feature_table_schema
    s = feature_table_schema(FeatureSpec(name="landcover"))
    assert s.fieldNames() == ["cell_id", "date", "landcover", "fetched", "appended_at"]


def test_strict_json_rejects_infinities(spark):
    for v in (float("inf"), float("-inf")):
        df = occ_df(spark, [row(1, unc=v)]).select("id", "coordinate_uncertainty")
        with pytest.raises(Exception, match="JSON cannot write"):
            df.select(strict_json(df)).collect()


def test_json_reader_fails_on_malformed_line(spark, tmp_path):
    from geotaxa.sources.files import read_json_records
    d = tmp_path / "bad"
    d.mkdir()
    (d / "part-0.json").write_text('{"id": 1, "name": "x", "latitude": 1.0}\n{"id": 2, "name": \n')
    with pytest.raises(Exception):
        read_json_records(spark, str(d), schema_from_fields(FIELDS)).collect()


def test_enforce_schema_repeated_field(spark):
    df = spark.createDataFrame([(1, [1, 2])], "id long, cells array<long>")
    out = enforce_schema(df, [("id", "INTEGER", "REQUIRED"), ("cells", "INTEGER", "REPEATED")])
    assert out.schema["cells"].dataType.simpleString() == "array<bigint>"
    assert out.first()["cells"] == [1, 2]


def test_missing_columns(spark):
    df = occ_df(spark, [row(1)]).drop("cell_id", "coordinate_uncertainty")
    assert decode_rows(df).first()["cell_id"] is None
    out = enforce_schema(df, [("id", "INTEGER", "REQUIRED"), ("coordinate_uncertainty", "FLOAT", "NULLABLE")])
    assert tuple(out.first()) == (1, None)
    with pytest.raises(ValueError, match="missing REQUIRED"):
        enforce_schema(df.drop("latitude"), FIELDS)
