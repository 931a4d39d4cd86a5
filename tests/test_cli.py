import json

from geotaxa.__main__ import run
from geotaxa.sources import fixture

SF = "/root/testdata/sf0.001"


def test_cli_jobs_on_fixture(spark, tmp_path):
    paths = {}
    for name, df in [("records", fixture.occ(spark, SF)), ("history", fixture.sync_history(spark, SF)),
                     ("names", fixture.names(spark, SF)), ("stored", fixture.features(spark, SF)),
                     ("lookup", fixture.raster(spark, SF))]:
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    out = str(tmp_path / "read")
    c = run(["read", "--records", paths["records"], "--out", out, "--threshold", "20",
             "--tie-break", "price,version"], spark)
    assert c == {"valid_taxa": 88, "valid_occurrences": 3068}
    assert spark.read.parquet(out).count() == 3068

    jl = str(tmp_path / "json")
    c = run(["harvest", "--records", paths["records"], "--history", paths["history"], "--names", paths["names"],
         "--out", jl, "--observed-after", "1997-01-01 00:00:00", "--observed-before", "2001-01-01 00:00:00",
         "--marks-out", str(tmp_path / "marks")], spark)
    marks = spark.read.parquet(str(tmp_path / "marks"))
    assert marks.count() == spark.read.parquet(paths["history"]).count()
    lines = [json.loads(l) for p in (tmp_path / "json").glob("part-*.json") for l in p.read_text().splitlines()]
    assert lines and all(d["name"] for d in lines)
    assert c["occurrences_written"] == len(lines) <= c["occurrences_fetched"]

    merged = str(tmp_path / "merged")
    c = run(["enrich", "--records", paths["records"], "--stored", paths["stored"], "--lookup", paths["lookup"],
             "--store-path", str(tmp_path / "store"), "--out", merged], spark)
    assert spark.read.parquet(merged).count() == spark.read.parquet(paths["records"]).count()
    assert c["landcover.records_fetched"] > 0 and c["landcover.complete"] + c["landcover.incomplete"] > 0


def test_cli_restricted_harvest_and_fetch_function(spark, tmp_path):
    paths = {}
    for name, df in [("records", fixture.occ(spark, SF)), ("history", fixture.sync_history(spark, SF)),
                     ("names", fixture.names(spark, SF)), ("stored", fixture.features(spark, SF))]:
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    c = run(["harvest", "--records", paths["records"], "--history", paths["history"], "--names", paths["names"],
             "--out", str(tmp_path / "json"), "--observed-after", "1995-01-01 00:00:00",
             "--observed-before", "2002-01-01 00:00:00", "--sources", "idigbio", "--families", "PROMO"], spark)
    lines = [json.loads(l) for p in (tmp_path / "json").glob("part-*.json") for l in p.read_text().splitlines()]
    assert {(d["source"], d["family"]) for d in lines} <= {("idigbio", "PROMO")}
    assert c["occurrences_fetched"] >= len(lines) > 0
    c = run(["enrich", "--records", paths["records"], "--stored", paths["stored"],
             "--fetch", "geotaxa.plans.registry:_landcover_by_formula",
             "--store-path", str(tmp_path / "store"), "--out", str(tmp_path / "merged")], spark)
    assert c["landcover.records_fetched"] > c["landcover.values_found"] > 0
