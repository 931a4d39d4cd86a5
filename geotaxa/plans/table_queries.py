"""Queries over tables that the library lays out itself: the clustered record
layout, the state of latest versions, committed appends, stored sketches, VARIANT
records and pulls through the data source.

Each one writes the whole fixture into a new folder below the shared checkpoint
directory and reads it back through the layout under test."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from geotaxa.functions.geo import timestamp_literal
from geotaxa.operators import sketches, variants
from geotaxa.operators.state import LatestState
from geotaxa.plans.registry import _ORACLE, OUTPUT_FIELDS, PULL_WINDOW, TOP_N
from geotaxa.session import materialize, shared_dir
from geotaxa.sinks import commits
from geotaxa.sinks.writers import enforce_schema
from geotaxa.sources import fixture
from geotaxa.sources.pull_source import ParquetClient, pull_source, read_due
from geotaxa.sources.clustered import pruned_pull, read_clustered, write_clustered

STATE_BUCKETS = 16


def _folder(spark, name: str) -> str:
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


def _clustered(spark, d, **options):
    """The records in the clustered layout and the stored history, pulled."""
    path, raw = _folder(spark, "records"), fixture.occ(spark, d)
    write_clustered(raw, path)
    history = materialize(fixture.sync_history(spark, d), "history")
    return pruned_pull(read_clustered(spark, path, raw.schema), history, **options)


def q_clustered_pull(spark, d):
    return _clustered(spark, d, observed_after=PULL_WINDOW[0], observed_before=PULL_WINDOW[1]).select("id", "source", "updated_at")


def q_clustered_restricted_pull(spark, d):
    return _clustered(spark, d, observed_after=None, observed_before=None, modified_before="2000-01-01 00:00:00",
                      restrict_sources=["idigbio", "gbif"], restrict_families=["LARGE"]).select("id", "source", "updated_at")


def q_clustered_single_pull(spark, d):
    return _clustered(spark, d, observed_after=None, observed_before=None, restrict_sources=["idigbio"],
                      restrict_families=["PROMO"]).select("id", "updated_at")


def q_incremental_latest(spark, d):
    """Latest versions by merging batches out of order; one of them twice."""
    raw = fixture.occ(spark, d)
    state = LatestState(spark, _folder(spark, "state"), raw.schema, fixture.TIE_BREAK, buckets=STATE_BUCKETS)
    third = F.pmod(F.col("version"), F.lit(3))
    for part in (1, 0, 2, 1):
        state.merge(raw.where(third == part), f"b{part}")
    return state.read()


def q_committed_appends(spark, d):
    """Records appended in three batches, one of them repeated, beside an
    attempt that was staged and never committed."""
    table, latest = _folder(spark, "committed"), fixture.latest(spark, d)
    rows = enforce_schema(latest, OUTPUT_FIELDS)
    for part in (0, 1, 2, 1):
        commits.append_batch(rows.where(F.pmod(F.col("id"), F.lit(3)) == part), table, f"b{part}", partition_by=["source"])
    commits.stage(rows.where("id % 3 = 0"), table, partition_by=["source"])
    return commits.read_committed(spark, table)


def q_frequent_names(spark, d):
    """The most frequent names from one stored sketch a batch."""
    table, latest = _folder(spark, "sketches"), fixture.latest(spark, d, ["name"])
    for part in (0, 1, 2):
        batch = latest.where(F.pmod(F.col("id"), F.lit(3)) == part)
        commits.append_batch(sketches.name_sketch(batch, f"b{part}"), table, f"b{part}")
    return sketches.frequent_names(sketches.merge_sketches(commits.read_committed(spark, table)), TOP_N)


def q_pull_source(spark, d):
    """The incremental pull through the data source, one partition a due pair."""
    raw = fixture.occ(spark, d)
    path = _folder(spark, "provider")
    raw.write.parquet(path)
    spark.dataSource.register(pull_source(ParquetClient))
    found = read_due(spark, fixture.sync_history(spark, d), raw.schema, path=path)
    after, before = (timestamp_literal(t, raw.schema["observed_at"].dataType) for t in PULL_WINDOW)
    return found.where((F.col("observed_at") >= after) & (F.col("observed_at") < before)).select("id", "source", "updated_at")


def q_variant_rows(spark, d):
    """Records as undeclared JSON, with missing, additional and differently typed
    fields, stored as VARIANT and read as declared."""
    latest = fixture.latest(spark, d, ["name", "latitude", "coordinate_uncertainty", "date"])
    i = F.col("id")
    mixed = latest.select(
        F.when(i % 2 == 0, F.to_json(F.struct("id"))).otherwise(F.to_json(F.struct(i.cast("string").alias("id")))).alias("a"),
        F.to_json(F.struct("source", "name", "latitude", "coordinate_uncertainty", "date"),
                  {"ignoreNullFields": "true"}).alias("b"),
        F.when(i % 3 == 0, F.to_json(F.struct(F.array(i, i + 1).alias("tags"), F.struct(F.lit("x").alias("y")).alias("deep")))).alias("c"))
    body = lambda c: F.expr(f"substring({c}, 2, length({c}) - 2)")
    lines = mixed.select(F.concat(F.lit("{"), F.concat_ws(",", body("a"), body("b"), body("c")), F.lit("}")).alias("line"))
    stored = materialize(variants.parse_variant(lines, "line"), "variant")
    return variants.extract_fields(stored, OUTPUT_FIELDS)


QUERIES = {
    "pull_source": q_pull_source,
    "variant_rows": q_variant_rows,
    "frequent_names": q_frequent_names,
    "clustered_pull": q_clustered_pull,
    "clustered_restricted_pull": q_clustered_restricted_pull,
    "clustered_single_pull": q_clustered_single_pull,
    "incremental_latest": q_incremental_latest,
    "committed_appends": q_committed_appends,
}
ORACLE = {
    "pull_source": _ORACLE["incremental_pull"],
    "variant_rows": _ORACLE["enforce_schema"],
    "frequent_names": _ORACLE["top_names"],
    "clustered_pull": _ORACLE["incremental_pull"],
    "clustered_restricted_pull": _ORACLE["restricted_pull"],
    "clustered_single_pull": _ORACLE["single_family_pull"],
    "incremental_latest": _ORACLE["latest_version"],
    "committed_appends": _ORACLE["enforce_schema"],
}
