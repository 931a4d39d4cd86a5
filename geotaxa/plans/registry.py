"""Registered queries and their DuckDB oracle SQL.

Every query reads the driver's tables (``lineitem``, ``orders``, ``part``)
through the fixture views of ``geotaxa.sources.fixture`` and runs on the whole
tables.  Each callable takes ``(spark, sf_dir)`` and returns a DataFrame; the
oracle text computes the same columns (same names) in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotaxa.functions.json import from_json_record, strict_json, to_json_record
from geotaxa.operators import curve, dedup, features, metrics, names, requests, resolve, series, taxa, tiles, versions
from geotaxa.operators.features import FeatureSpec
from geotaxa.plans.jobs import read_occurrences
from geotaxa.schemas import decode_rows, schema_from_fields
from geotaxa.session import materialize
from geotaxa.sinks.writers import enforce_schema, occurrence_rows
from geotaxa.sources import fixture, sync
from geotaxa.sources.fixture import with_views

Query = Callable[[SparkSession, str], DataFrame]

LANDCOVER = FeatureSpec(name="landcover")
ELEVATION = FeatureSpec(name="elevation", value_cols=("elevation",))
# Parameters of the checks (FIXTURES.md): the fixture's dates run 1995..2001,
# so the pull window is four years inside them (the default 2015..2019 window
# would pull nothing); the top-k report keeps 10 names (the default 1000 is
# more than the fixture's 261 names, which would hide the limit); vectors
# need 83 dates to count as complete.
PULL_WINDOW = ("1997-01-01 00:00:00", "2001-01-01 00:00:00")
TOP_N = 10
VECTOR_MIN_LENGTH = 83
SAMPLE_BATCHES = 3
HOT_CELL, ASOF_DAYS, WINDOW_MONTHS = 3, 70, 6
COARSE, FINE, TILE_BITS = 6, 12, 4          # levels of the feature cells
GRID_STEP = 0.25
# Grid of GRID_STEP degrees: rows from the south pole, columns from the antimeridian.
ROW0, COL0, NCOLS = int(round(90 / GRID_STEP)), int(round(180 / GRID_STEP)), int(round(360 / GRID_STEP))
JSON_COLS = ["id", "source", "name", "latitude", "coordinate_uncertainty", "date"]
OUTPUT_FIELDS = [
    ("id", "INTEGER", "REQUIRED"),
    ("source", "STRING", "REQUIRED"),
    ("name", "STRING", "NULLABLE"),
    ("latitude", "FLOAT", "REQUIRED"),
    ("coordinate_uncertainty", "FLOAT", "NULLABLE"),
    ("date", "DATE", "REQUIRED"),
]

# DuckDB spelling of the word test (the data is ASCII; RE2's \s is ASCII).
_MULTIWORD = "len(list_filter(string_split_regex({c}, '[\\s\\x1c-\\x1f]+'), lambda w: w <> '')) > 1"


def _multiword_sql(c: str) -> str:
    return _MULTIWORD.format(c=c)


# ---------------------------------------------------------------- helpers
def _latest(spark, d, *cols):
    """Latest records; with ``cols``, carrying only those columns."""
    return fixture.latest(spark, d, list(cols) if cols else None)


# Dedup key: name and place (latitude, longitude, uncertainty, date).
DEDUP_COLS = ["name", "latitude", "longitude", "coordinate_uncertainty", "date"]
FEATURE_KEY = ["cell_id", "date"]


def _landcover_by_formula(keys: pd.DataFrame) -> pd.DataFrame:
    """A stand-in remote feature source for the fetch path: land cover by the
    raster's rule (nothing for cells ending in 1, no value for multiples of 7)."""
    cells = keys["cell_id"].astype("int64")
    months = pd.to_datetime(keys["date"]).dt.month.astype("int64")
    found = keys.loc[cells % 10 != 1, ["cell_id", "date"]].copy()
    found["landcover"] = ((cells + months + 3) % 7).where(cells % 7 != 0).astype("Int64")[cells % 10 != 1]
    return found


# ---------------------------------------------------------------- queries
def q_latest_version(spark, d):
    return _latest(spark, d)


def q_latest_by_source_id(spark, d):
    o = fixture.occ(spark, d).withColumn("source_id", F.floor(F.col("id") / 10).cast("long"))
    return versions.latest_by_source_id(o, tie_break=fixture.TIE_BREAK).select("source_id", "id", "updated_at")


def q_spatial_dedup(spark, d):
    return dedup.spatial_dedup(_latest(spark, d, *DEDUP_COLS)).select("id", "source")


def q_taxa_threshold(spark, d):
    return taxa.taxa_threshold(_latest(spark, d, "name")).select("id", "source", "name")


def q_valid_names(spark, d):
    return taxa.valid_names(_latest(spark, d, "name"))


def q_valid_names_by_source_id(spark, d):
    """Counting variant over the latest version per ``source_id``: names with at
    least 200 such records (inclusive)."""
    o = fixture.occ(spark, d).withColumn("source_id", F.floor(F.col("id") / 10).cast("long"))
    return taxa.valid_names(versions.latest_by_source_id(o, tie_break=fixture.TIE_BREAK))


def q_read_occurrences(spark, d):
    raw = fixture.occ(spark, d).select("id", "source", "updated_at", *fixture.TIE_BREAK, *DEDUP_COLS)
    return read_occurrences(raw, tie_break=fixture.TIE_BREAK).select("id", "source", "name")


def q_name_distribution(spark, d):
    return taxa.name_distribution(_latest(spark, d, "name"))


def q_top_names(spark, d):
    return taxa.top_names(_latest(spark, d, "name"), n=TOP_N)


def q_source_list(spark, d):
    return sync.source_list(fixture.occ(spark, d))


def q_sync_queue(spark, d):
    return sync.sync_queue(fixture.sync_history(spark, d))


def q_incremental_pull(spark, d):
    return sync.incremental_pull(fixture.occ(spark, d), fixture.sync_history(spark, d),
                                 observed_after=PULL_WINDOW[0], observed_before=PULL_WINDOW[1]
                                 ).select("id", "source", "updated_at")


def q_restricted_pull(spark, d):
    return sync.incremental_pull(fixture.occ(spark, d), fixture.sync_history(spark, d),
                                 observed_after=None, observed_before=None,
                                 modified_before="2000-01-01 00:00:00",
                                 restrict_sources=["idigbio", "gbif"], restrict_families=["LARGE"]
                                 ).select("id", "source", "updated_at")


def q_single_family_pull(spark, d):
    return sync.incremental_pull(fixture.occ(spark, d), fixture.sync_history(spark, d),
                                 observed_after=None, observed_before=None,
                                 restrict_sources=["idigbio"], restrict_families=["PROMO"]
                                 ).select("id", "updated_at")


def q_pending_pull_count(spark, d):
    return sync.pending_pull_count(fixture.sync_history(spark, d),
                                   restrict_sources=["idigbio", "inaturalist"])


def q_normalize_names(spark, d):
    return names.normalize_names(_latest(spark, d, "name"), fixture.names(spark, d)
                                 ).select("id", "source", "scientific_name")


def q_normalize_names_resolved(spark, d):
    return names.normalize_names(_latest(spark, d, "name"), fixture.names(spark, d), drop_unresolved=True
                                 ).select("id", "source", "scientific_name")


def q_join_existing_features(spark, d):
    return features.join_existing_features(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), LANDCOVER
                                           ).select("id", "source", "landcover")


def q_complete_rows(spark, d):
    j = features.join_existing_features(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), LANDCOVER)
    return features.complete_rows(j, LANDCOVER).select("id", "source", "landcover")


def q_incomplete_rows(spark, d):
    j = features.join_existing_features(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), LANDCOVER)
    return features.incomplete_rows(j, LANDCOVER).select("id", "source")


def q_completeness_partition(spark, d):
    j = features.join_existing_features(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), LANDCOVER)
    return features.completeness_partition(j, LANDCOVER)


def q_missing_feature_groups(spark, d):
    return features.missing_feature_groups(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), LANDCOVER)


def q_missing_feature_keys(spark, d):
    return features.missing_feature_keys(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), LANDCOVER)


def _raster_spec(spark, d) -> FeatureSpec:
    return FeatureSpec(name="landcover", lookup=fixture.raster(spark, d))


def _fetch_spec() -> FeatureSpec:
    return FeatureSpec(name="landcover", fetch=_landcover_by_formula)


def q_feature_rows_to_append(spark, d):
    return features.feature_rows_to_append(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d),
                                           _raster_spec(spark, d))


def q_fetch_missing_features(spark, d):
    spec = _fetch_spec()
    keys = features.missing_feature_keys(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), spec)
    return features.fetch_missing_features(keys, spec)


def q_fetched_flag(spark, d):
    """The feature table after one enrichment: stored rows plus every fetched
    key with its ``fetched`` flag (NULL value = fetched, nothing there)."""
    spec = _raster_spec(spark, d)
    stored = fixture.features(spark, d)
    keys = features.missing_feature_keys(_latest(spark, d, *FEATURE_KEY), stored, spec)
    fetched = features.fetch_missing_features(keys, spec)
    return features.stored_values(stored, spec).unionByName(fetched)


def _fetched(spark, d):
    spec = _raster_spec(spark, d)
    keys = features.missing_feature_keys(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), spec)
    return features.fetch_missing_features(keys, spec)


def q_merge_features(spark, d):
    m = features.merge_features(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), _fetched(spark, d), LANDCOVER)
    return m.select("id", "source", F.col("landcover").alias("lc"))


def q_merged_without_feature(spark, d):
    m = features.merge_features(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), _fetched(spark, d), LANDCOVER)
    return m.where(F.col("landcover").isNull()).select("id", "source")


def _two_features(spark, d):
    merged = features.merge_features(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), _fetched(spark, d), LANDCOVER)
    return features.combine_features(merged, [(ELEVATION, fixture.elevation(spark, d))])


def q_grouped_occurrences(spark, d):
    """The rows of two features per occurrence, as ``feature=value`` text."""
    g = features.grouped_occurrences(_two_features(spark, d), [LANDCOVER, ELEVATION])
    text = F.array_join(F.transform("rows", lambda x: F.concat(x["feature"], F.lit("="), x["value"])), ",")
    return g.select("source", "id", "c", text.alias("rows"))


def q_combine_features(spark, d):
    return features.combine_features(_latest(spark, d, *FEATURE_KEY), [
        (LANDCOVER, fixture.raster(spark, d)), (ELEVATION, fixture.elevation(spark, d))]
    ).select("id", "source", "landcover", "elevation")


def q_feature_vectors(spark, d):
    return features.feature_vectors(fixture.raster(spark, d), LANDCOVER)


def q_valid_feature_vectors(spark, d):
    return features.valid_feature_vectors(fixture.raster(spark, d), LANDCOVER, VECTOR_MIN_LENGTH)


def _hot_cells(spark, d):
    """Latest records, a third of them in one cell."""
    hot = F.when(F.col("id") % 3 == 0, HOT_CELL).otherwise(F.col("cell_id")).cast("long")
    return _latest(spark, d, *FEATURE_KEY).withColumn("cell_id", hot).select("id", "source", *FEATURE_KEY)


def q_asof_features(spark, d):
    """Nearest earlier land cover within the tolerance; features of three months
    a year, so there are gaps."""
    sparse = fixture.raster(spark, d).where(F.month("date") % 4 == 1)
    return series.asof_features(_hot_cells(spark, d), sparse, LANDCOVER, ASOF_DAYS).select("id", "source", "landcover", "feature_date")


def q_feature_windows(spark, d):
    """The land cover of the last months of each occurrence's cell."""
    w = series.feature_windows(_hot_cells(spark, d), fixture.raster(spark, d), LANDCOVER, WINDOW_MONTHS, "month")
    text = F.array_join(F.transform("window", lambda x: x.cast("string")), ",", "null")
    return w.select("id", "source", text.alias("w"), F.col("n_values").alias("n"))


def _spread_locations(spark, d):
    """Latest records moved apart, with uncertainties from 30 m to 1,000 km; one in
    fifty lies near or beyond a pole."""
    i = F.col("id")
    lat = F.when(i % 50 == 7, F.col("latitude") * 2.2).otherwise(F.col("latitude") + (i % 997) / 1000.0)
    return _latest(spark, d, "latitude", "longitude").select(
        "id", "source", lat.alias("latitude"), (F.col("longitude") + (i % 1009) / 500.0).alias("longitude"),
        F.when(i % 11 != 0, F.lit(30.0) * F.element_at(F.array(*[F.lit(float(10 ** k)) for k in range(5)]), (i % 5 + 1).cast("int")))
         .alias("coordinate_uncertainty"))


def q_curve_covering(spark, d):
    """Covering cells of a level that follows from the precision."""
    return curve.curve_covering(_spread_locations(spark, d))


def _layers(locations):
    """Feature cells of a coarse and a fine level, both with gaps."""
    fine = locations.select(curve.point_cell("latitude", "longitude", FINE).alias("fine"))
    both = fine.select(F.explode(F.array(curve.ancestor("fine", F.lit(COARSE)), F.col("fine"))).alias("feature_cell"))
    cell, coarse = F.col("feature_cell"), curve.level_of("feature_cell") == COARSE
    kept = both.distinct().where(F.when(coarse, cell % 5 != 0).otherwise(cell % 3 == 0))
    return kept.withColumn("value", F.when(coarse, cell % 11).otherwise(cell % 13))


def q_finest_feature(spark, d):
    """The value of the smallest feature cell that holds each location."""
    points = _spread_locations(spark, d).select("id", "source", curve.point_cell("latitude", "longitude").alias("cell"))
    return curve.finest_feature(points, _layers(_spread_locations(spark, d)), [COARSE, FINE]).select("id", "source", "feature_cell", "value")


def q_containing_cells(spark, d):
    """Per location the feature cells that hold one of its covering cells, equal
    it or lie in it, and their values, counted."""
    locations = materialize(_spread_locations(spark, d), "locations")
    covering = curve.curve_covering(locations)
    pairs = curve.containing(covering, _layers(locations), range(curve.FINEST + 1), [COARSE, FINE])
    return pairs.groupBy("id", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def q_tile_values(spark, d):
    """The pixel each location lies in, looked up in tiles of 16 by 16 pixels."""
    at = _spread_locations(spark, d).select(curve.point_cell("latitude", "longitude", FINE).alias("pixel"), F.col("id").alias("i"))
    pixels = at.where("pixel % 4 <> 1 and i % 2 = 0").select("pixel", (F.col("pixel") % 17).alias("value"))
    return tiles.tile_values(_spread_locations(spark, d), tiles.build_tiles(pixels, TILE_BITS), FINE, TILE_BITS).select("id", "source", "value")


# What the last token of a fixture name stands for, so that names
# look like species with a variety.
VARIETIES = ["alba", "fusca", "rubescens", "viridis"]


def _spelled(name):
    """Fixture names as (genus, epithet, variety): ``old rod 2`` -> ``Old rod var. rubescens``."""
    parts = F.split(name, " ")
    variety = F.element_at(F.array(*[F.lit(v) for v in VARIETIES]), F.try_element_at(parts, F.lit(3)).cast("int") + 1)
    return F.when(F.size(parts) == 3, F.concat(F.initcap(parts[0]), F.lit(" "), parts[1], F.lit(" var. "), variety)).otherwise(F.initcap(name))


def q_resolve_names(spark, d):
    """Spellings with planted typos, authors and odd spacing, resolved."""
    latest = _latest(spark, d, "name")
    good, i = _spelled(F.col("name")), F.col("id")
    typed = (F.when(i % 8 == 1, F.concat(F.substring(good, 1, 3), F.substring(good, 5, 99)))             # a letter lost
              .when(i % 8 == 2, F.concat(F.substring(good, 1, 2), F.lit("q"), F.substring(good, 4, 99)))   # replaced
              .when(i % 8 == 3, F.concat(F.substring(good, 1, 2), F.lit("x"), F.substring(good, 3, 99)))   # added
              .when(i % 8 == 4, F.concat(F.upper(F.substring(good, 1, 1)), F.substring(good, 2, 99), F.lit("  (L.) Lam. 1783")))
              .when(i % 8 == 5, F.concat(F.substring(good, 1, 1), F.lit("zz"), F.substring(good, 4, 99)))  # two replaced
              .otherwise(good))
    reference = fixture.names(spark, d).select(
        resolve.parse_name(_spelled(F.col("given_name")))["canonical"].alias("canonical"), "scientific_name")
    return resolve.resolve_occurrences(latest.select("id", "source", typed.alias("name")), reference
                                       ).select("id", "source", "scientific_name", "name_distance")


def q_one_request_per_cell(spark, d):
    unwound = requests.unwind_cells(_latest(spark, d, "cell_id"), _cells())
    return dedup.one_request_per_cell(unwound, "c").select("c", "source", "id")


def _cells():
    return F.array(F.col("cell_id"), F.col("cell_id") + 1)


def q_unwind_cells(spark, d):
    return requests.unwind_cells(_latest(spark, d, "cell_id"), _cells())


def q_covering_cells(spark, d):
    """Unwind each occurrence into the grid cells its uncertainty box covers;
    one id in a hundred is moved to or beyond a pole."""
    df = _latest(spark, d, "latitude", "longitude", "coordinate_uncertainty")
    polar = F.when(F.col("id") % 100 == 11, F.col("latitude") * 2.5).otherwise(F.col("latitude"))
    return requests.covering_cells(df.withColumn("latitude", polar), GRID_STEP)


def q_cell_requests(spark, d):
    return requests.cell_requests(requests.unwind_cells(_latest(spark, d, "cell_id"), _cells()))


def q_cell_request_members(spark, d):
    return requests.cell_request_members(requests.unwind_cells(_latest(spark, d, "cell_id"), _cells()))


def q_feature_requests(spark, d):
    return requests.feature_requests(_latest(spark, d, *DEDUP_COLS[1:]))


def q_feature_request_members(spark, d):
    return requests.feature_request_members(_latest(spark, d, *DEDUP_COLS[1:]))


def q_batched_requests(spark, d):
    return requests.batched_requests(_latest(spark, d, "family").select("family", "source", "id")
                                     ).select("family", "b", "id")


def q_sample_batches(spark, d):
    rows = _latest(spark, d, "family").select("family", "source", "id")
    return requests.first_batches(rows, SAMPLE_BATCHES).select("family", "b", "id")


def q_grid_location(spark, d):
    df = _latest(spark, d, "latitude", "longitude", "coordinate_uncertainty")
    return requests.grid_location(df, GRID_STEP).select("id", "source", "la", "lo", "la_max", "lo_max", "u")


def q_job_counters(spark, d):
    """The named counters of the three jobs as one report."""
    raw = fixture.occ(spark, d)
    pulled = sync.incremental_pull(raw, fixture.sync_history(spark, d), observed_after=PULL_WINDOW[0], observed_before=PULL_WINDOW[1])
    valid = q_read_occurrences(spark, d)
    joined = features.join_existing_features(_latest(spark, d, *FEATURE_KEY), fixture.features(spark, d), LANDCOVER)
    complete, keyed = features.is_complete(LANDCOVER, features.FETCHED), features.has_key(LANDCOVER)
    rows = F.count(F.lit(1))
    return metrics.job_counters([
        (pulled, {"occurrences_fetched": rows, "names_fetched": F.count_distinct("name")}),
        (valid, {"valid_taxa": F.count_distinct("name"), "valid_occurrences": rows}),
        (joined, {"complete": metrics.count_where(complete), "incomplete": metrics.count_where(~complete),
                  "without_key": metrics.count_where(~keyed),
                  "token_groups": F.count_distinct(F.when(keyed & ~complete, F.struct(*FEATURE_KEY)))}),
    ])


def q_json_records(spark, d):
    l = _latest(spark, d, *JSON_COLS).where(F.col("name").isNotNull())
    return l.select(to_json_record(JSON_COLS).alias("j"))


def q_strict_json(spark, d):
    l = _latest(spark, d, *JSON_COLS).where(F.col("name").isNotNull()).select(*JSON_COLS)
    return l.select(strict_json(l).alias("j"))


def q_json_roundtrip(spark, d):
    schema = schema_from_fields(OUTPUT_FIELDS)
    l = _latest(spark, d, *JSON_COLS).where(F.col("name").isNotNull())
    text = l.select(to_json_record(JSON_COLS).alias("j"))
    return text.select(from_json_record("j", schema).alias("r")).select("r.*")


def q_decode_rows(spark, d):
    return decode_rows(_latest(spark, d))


def q_enforce_schema(spark, d):
    return enforce_schema(_latest(spark, d, *JSON_COLS), OUTPUT_FIELDS)


def q_occurrence_rows(spark, d):
    n = names.normalize_names(_latest(spark, d, *JSON_COLS), fixture.names(spark, d))
    return occurrence_rows(n, fields=OUTPUT_FIELDS)


QUERIES: dict[str, Query] = {
    "latest_version": q_latest_version,
    "latest_by_source_id": q_latest_by_source_id,
    "spatial_dedup": q_spatial_dedup,
    "taxa_threshold": q_taxa_threshold,
    "valid_names": q_valid_names,
    "valid_names_by_source_id": q_valid_names_by_source_id,
    "read_occurrences": q_read_occurrences,
    "name_distribution": q_name_distribution,
    "top_names": q_top_names,
    "source_list": q_source_list,
    "sync_queue": q_sync_queue,
    "incremental_pull": q_incremental_pull,
    "restricted_pull": q_restricted_pull,
    "single_family_pull": q_single_family_pull,
    "pending_pull_count": q_pending_pull_count,
    "normalize_names": q_normalize_names,
    "normalize_names_resolved": q_normalize_names_resolved,
    "join_existing_features": q_join_existing_features,
    "complete_rows": q_complete_rows,
    "incomplete_rows": q_incomplete_rows,
    "completeness_partition": q_completeness_partition,
    "missing_feature_groups": q_missing_feature_groups,
    "missing_feature_keys": q_missing_feature_keys,
    "feature_rows_to_append": q_feature_rows_to_append,
    "fetch_missing_features": q_fetch_missing_features,
    "fetched_flag": q_fetched_flag,
    "merge_features": q_merge_features,
    "merged_without_feature": q_merged_without_feature,
    "grouped_occurrences": q_grouped_occurrences,
    "combine_features": q_combine_features,
    "feature_vectors": q_feature_vectors,
    "valid_feature_vectors": q_valid_feature_vectors,
    "asof_features": q_asof_features,
    "feature_windows": q_feature_windows,
    "curve_covering": q_curve_covering,
    "finest_feature": q_finest_feature,
    "containing_cells": q_containing_cells,
    "tile_values": q_tile_values,
    "resolve_names": q_resolve_names,
    "one_request_per_cell": q_one_request_per_cell,
    "unwind_cells": q_unwind_cells,
    "covering_cells": q_covering_cells,
    "cell_requests": q_cell_requests,
    "cell_request_members": q_cell_request_members,
    "feature_requests": q_feature_requests,
    "feature_request_members": q_feature_request_members,
    "batched_requests": q_batched_requests,
    "sample_batches": q_sample_batches,
    "grid_location": q_grid_location,
    "job_counters": q_job_counters,
    "json_records": q_json_records,
    "strict_json": q_strict_json,
    "json_roundtrip": q_json_roundtrip,
    "decode_rows": q_decode_rows,
    "enforce_schema": q_enforce_schema,
    "occurrence_rows": q_occurrence_rows,
}


# ---------------------------------------------------------------- oracle
_DEDUP = """(select * from (select *, row_number() over (partition by name, latitude, longitude,
  coordinate_uncertainty, date order by source, id) as r from latest) where r = 1)"""
_BATCHED = """(select family, cast(floor((row_number() over (partition by family order by source, id) - 1)
  / 100) as bigint) as b, id from latest)"""
_JSON = ("cast(to_json({'id': id, 'source': source, 'name': name, 'latitude': latitude, "
         "'coordinate_uncertainty': coordinate_uncertainty, 'date': date}) as varchar)")



def _cell_sql(x: str, y: str, level: str) -> str:
    return f"((1::bigint << (2 * {level})) | bits({x}) | (bits({y}) << 1))"


# DuckDB has macros, but the oracle is one statement: bits() is spelled out.
def _with_bits(sql: str) -> str:
    import re
    while (m := re.search(r"bits\(([a-z0-9_]+)\)", sql)):
        v = m.group(1)
        steps = f"list_reduce([{v}, " + ", ".join(str(i) for i in range(len(curve.SPREAD))) + "], lambda v, i: (v | (v << [" + ", ".join(
            str(s) for s, _ in curve.SPREAD) + "][i + 1])) & [" + ", ".join(str(k) for _, k in curve.SPREAD) + "][i + 1])"
        sql = sql.replace(m.group(0), steps)
    return sql


_SPREAD = """spread as (select id, source, case when id % 50 = 7 then latitude * 2.2::double else latitude + (id % 997) / 1000.0::double end as la,
  longitude + (id % 1009) / 500.0::double as lo, case when id % 11 <> 0 then 30.0::double * (10 ** (id % 5))::double end as u from latest),
inside as (select * from spread where abs(la) <= 90)"""


def _point_sql(level: int) -> str:
    n = 1 << level
    return f"""(select id, source, {_cell_sql('x', 'y', str(level))} as cell from (select id, source,
  ((floor((lo + 180) / 360 * {n}.0::double)::bigint % {n}) + {n}) % {n} as x,
  least(floor((la + 90) / 180 * {n}.0::double), {n - 1})::bigint as y from inside))"""


_COVERING = f"""sized as (select *, dx, case when polar then 180.0::double else degrees(asin(sin(radians(dy)) / cos(radians(la)))) end as dx2
  from (select id, source, la, lo, greatest(coalesce(u, 30.0), 30.0) / 111320.0::double as dy, 0 as dx,
    abs(la) + greatest(coalesce(u, 30.0), 30.0) / 111320.0::double >= 90 as polar from inside)),
leveled as (select *, greatest(least(least(floor(log2(180 / dy)), floor(log2(360 / dx2))) + 1, {curve.FINEST}), 0)::int as l from sized),
boxed as (select id, source, l, n,
  greatest(least(floor((la - dy + 90) / 180 * n), n - 1), 0)::bigint as y0, greatest(least(floor((la + dy + 90) / 180 * n), n - 1), 0)::bigint as y1,
  case when polar then 0 else floor((lo - dx2 + 180) / 360 * n)::bigint end as x0,
  case when polar then n - 1 else floor((lo + dx2 + 180) / 360 * n)::bigint end as x1 from (select *, (1::bigint << l) as n from leveled)),
covering as (select id, source, {_cell_sql('x', 'y', 'l')} as cell from (select id, source, l, y, ((xx % n) + n) % n as x
  from (select id, source, l, n, y, unnest(generate_series(x0, least(x1, x0 + n - 1))) as xx
    from (select *, unnest(generate_series(y0, y1)) as y from boxed))))"""
_LAYERS = f"""layers as (select distinct cell as feature_cell, cell % 11 as value, {COARSE} as level from {_point_sql(COARSE)} where cell % 5 <> 0
  union all select distinct cell, cell % 13, {FINE} from {_point_sql(FINE)} where cell % 3 = 0)"""



def _spelled_sql(c: str) -> str:
    parts = f"string_split({c}, ' ')"
    cap = lambda w: f"(upper(({w})[1]) || lower(({w})[2:]))"
    varieties = ", ".join(f"'{v}'" for v in VARIETIES)
    return (f"case when len({parts}) = 3 then {cap(parts + '[1]')} || ' ' || {parts}[2] || ' var. ' || "
            f"[{varieties}][try_cast({parts}[3] as int) + 1] else {cap(c)} end")


def _canonical_sql(c: str) -> str:
    """The fixture's spellings hold no other rank mark than ``var.``."""
    text, p = f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))", resolve.PATTERN
    part = lambda i: f"regexp_extract({text}, '{p}', {i})"
    return (f"nullif(lower({part(1)}) || case when {part(2)} <> '' then ' ' || {part(2)} else '' end "
            f"|| case when {part(4)} <> '' then ' ' || {part(3)} || '. ' || {part(4)} else '' end, '')")


_ORACLE: dict[str, tuple[list[str], str]] = {
    "latest_version": (["latest"], "select * from latest"),
    "latest_by_source_id": (["occ"], """
select source_id, id, updated_at from (select *, row_number() over (partition by source_id
  order by updated_at desc, price desc, version desc, id) as r
  from (select *, cast(floor(id / 10) as bigint) as source_id from occ) x) y where r = 1"""),
    "spatial_dedup": (["latest"], f"select id, source from {_DEDUP}"),
    "taxa_threshold": (["latest"], f"""
select id, source, name from latest
where {_multiword_sql('name')}
  and name in (select name from latest where {_multiword_sql('name')} group by name having count(*) > 200)"""),
    "valid_names": (["latest"], "select name, count(*) as c from latest group by name having count(*) >= 200"),
    "valid_names_by_source_id": (["occ"], """
select name, count(*) as c from (select *, row_number() over (partition by source_id
  order by updated_at desc, price desc, version desc, id) as r
  from (select *, cast(floor(id / 10) as bigint) as source_id from occ) x) y
where r = 1 group by name having count(*) >= 200"""),
    "read_occurrences": (["latest"], f"""
select id, source, name from {_DEDUP} d
where {_multiword_sql('name')}
  and name in (select name from {_DEDUP} e where {_multiword_sql('name')} group by name having count(*) > 200)"""),
    "name_distribution": (["latest"], "select name, count(*) as c from latest group by name"),
    "top_names": (["latest"], f"""
select name, count(*) as c from latest where name is not null group by name
order by c desc, name limit {TOP_N}"""),
    "source_list": (["occ"], "select distinct source from occ"),
    "sync_queue": (["sync_history"], """
select source, family, fetched_at from sync_history
where source in ('idigbio', 'inaturalist', 'gbif', 'mycoportal', 'mushroomobserver')"""),
    "incremental_pull": (["occ", "sync_history"], """
select o.id, o.source, o.updated_at from occ o join sync_history h
  on o.source = h.source and o.family = h.family and o.updated_at > h.fetched_at
where o.observed_at >= timestamp '1997-01-01 00:00:00' and o.observed_at < timestamp '2001-01-01 00:00:00'"""),
    "restricted_pull": (["occ", "sync_history"], """
select o.id, o.source, o.updated_at from occ o join sync_history h
  on o.source = h.source and o.family = h.family and o.updated_at > h.fetched_at
where o.source in ('idigbio', 'gbif') and o.family in ('LARGE')
  and o.updated_at < timestamp '2000-01-01 00:00:00'"""),
    "single_family_pull": (["occ", "sync_history"], """
select o.id, o.updated_at from occ o join sync_history h
  on o.source = h.source and o.family = h.family and o.updated_at > h.fetched_at
where h.source = 'idigbio' and h.family = 'PROMO'"""),
    "pending_pull_count": (["sync_history"],
                           "select count(*) as n from sync_history where source in ('idigbio', 'inaturalist')"),
    "normalize_names": (["latest", "names"], """
select o.id, o.source, n.scientific_name from latest o left join names n on o.name = n.given_name"""),
    "normalize_names_resolved": (["latest", "names"], """
select o.id, o.source, n.scientific_name from latest o join names n on o.name = n.given_name"""),
    "join_existing_features": (["latest", "stored"], """
select o.id, o.source, f.landcover from latest o
left join stored f on o.cell_id = f.cell_id and o.date = f.date"""),
    "complete_rows": (["latest", "stored"], """
select o.id, o.source, f.landcover from latest o
left join stored f on o.cell_id = f.cell_id and o.date = f.date
where f.landcover is not null or coalesce(f.fetched, false)"""),
    "incomplete_rows": (["latest", "stored"], """
select o.id, o.source from latest o
left join stored f on o.cell_id = f.cell_id and o.date = f.date
where not (f.landcover is not null or coalesce(f.fetched, false))"""),
    "completeness_partition": (["latest", "stored"], """
select (f.landcover is not null or coalesce(f.fetched, false)) as complete, count(*) as c from latest o
left join stored f on o.cell_id = f.cell_id and o.date = f.date group by 1"""),
    "missing_feature_groups": (["latest", "missing"], """
select o.cell_id, o.date, count(*) as c from latest o
join missing m on o.cell_id = m.cell_id and o.date = m.date group by o.cell_id, o.date"""),
    "missing_feature_keys": (["missing"], "select * from missing"),
    "feature_rows_to_append": (["got"], "select cell_id, date, landcover from got where landcover is not null"),
    "fetch_missing_features": (["got"], "select * from got"),
    "fetched_flag": (["stored", "got"], """
select cell_id, date, landcover, fetched from stored
union all select * from got"""),
    "merge_features": (["merged"], "select id, source, lc from merged"),
    "merged_without_feature": (["merged"], "select id, source from merged where lc is null"),
    "grouped_occurrences": (["merged", "elevation"], """
select source, id, count(*) as c, string_agg(feature || '=' || cast(v as varchar), ',' order by feature) as rows from (
  select source, id, 'landcover' as feature, lc as v from merged where lc is not null
  union all
  select o.source, o.id, 'elevation', e.elevation from latest o
    join elevation e on o.cell_id = e.cell_id and o.date = e.date) u
group by source, id"""),
    "combine_features": (["latest", "found", "elevation"], """
select o.id, o.source, r.landcover, e.elevation from latest o
left join found r on o.date = r.date and o.cell_id = r.cell_id
left join elevation e on o.date = e.date and o.cell_id = e.cell_id"""),
    "feature_vectors": (["found"], """
select cell_id, string_agg(coalesce(cast(landcover as varchar), 'null'), ',' order by date) as v from found group by cell_id"""),
    "valid_feature_vectors": (["found"], f"""
select cell_id, count(landcover) as n from found group by cell_id having count(landcover) >= {VECTOR_MIN_LENGTH}"""),
    "asof_features": (["latest", "found"], f"""
, hot as (select id, source, date, case when id % 3 = 0 then {HOT_CELL} else cell_id end as cell_id from latest),
sparse as (select * from found where month(date) % 4 = 1)
select o.id, o.source, case when f.date >= o.date - {ASOF_DAYS} then f.landcover end as landcover,
  case when f.date >= o.date - {ASOF_DAYS} then f.date end as feature_date
from hot o asof left join sparse f on o.cell_id = f.cell_id and o.date >= f.date"""),
    "feature_windows": (["latest", "found"], f"""
, hot as (select id, source, date, case when id % 3 = 0 then {HOT_CELL} else cell_id end as cell_id from latest)
select o.id, o.source, string_agg(coalesce(cast(f.landcover as varchar), 'null'), ',' order by k desc) as w, count(f.landcover) as n
from hot o cross join range({WINDOW_MONTHS}) s(k)
  left join found f on f.cell_id = o.cell_id and f.date = o.date - to_months(cast(k as integer))
group by o.id, o.source"""),
    "curve_covering": (["latest"], _with_bits(f", {_SPREAD}, {_COVERING} select * from covering")),
    "finest_feature": (["latest"], _with_bits(f""", {_SPREAD}, {_LAYERS}, p as {_point_sql(curve.FINEST)}
select s.id, s.source, coalesce(f.feature_cell, c.feature_cell) as feature_cell, coalesce(f.value, c.value) as value
from spread s left join p on p.id = s.id and p.source = s.source
  left join layers f on f.level = {FINE} and f.feature_cell = p.cell >> {2 * (curve.FINEST - FINE)}
  left join layers c on c.level = {COARSE} and c.feature_cell = p.cell >> {2 * (curve.FINEST - COARSE)}""")),
    "containing_cells": (["latest"], _with_bits(f""", {_SPREAD}, {_COVERING}, {_LAYERS},
leveled_cells as (select *, ((length(bin(cell)) - 1) / 2)::int as l from covering),
pairs as (select id, source, value from leveled_cells join layers on l >= level and feature_cell = cell >> (2 * greatest(l - level, 0))
  union all
  select id, source, value from leveled_cells join layers on l < level and cell = feature_cell >> (2 * greatest(level - l, 0)))
select id, source, count(*) as n, cast(sum(value) as bigint) as total from pairs group by id, source""")),
    "tile_values": (["latest"], _with_bits(f""", {_SPREAD}, p as {_point_sql(FINE)},
raster as (select distinct cell, cell % 17 as value from p where cell % 4 <> 1 and id % 2 = 0)
select s.id, s.source, r.value from spread s left join p on p.id = s.id and p.source = s.source left join raster r on r.cell = p.cell""")),
    "resolve_names": (["latest", "names"], f"""
, spelled as (select id, source, name, {_spelled_sql('name')} as g from latest),
typed as (select id, source, case id % 8 when 1 then g[1:3] || g[5:99] when 2 then g[1:2] || 'q' || g[4:99] when 3 then g[1:2] || 'x' || g[3:99]
  when 4 then upper(g[1]) || g[2:99] || '  (L.) Lam. 1783' when 5 then g[1:1] || 'zz' || g[4:99] else g end as given from spelled),
known as (select {_canonical_sql(_spelled_sql('given_name'))} as canonical, max(scientific_name) as s from names group by 1),
asked as (select given, {_canonical_sql('given')} as canonical from (select distinct given from typed where given is not null)),
pairs as (select given, levenshtein(a.canonical, k.canonical) as d, min(s) as a, max(s) as b
  from asked a join known k on levenshtein(a.canonical, k.canonical) <= 1 group by given, d),
best as (select given, d, a, b from (select *, row_number() over (partition by given order by d) as r from pairs) where r = 1 and a = b)
select t.id, t.source, b.a as scientific_name, cast(b.d as integer) as name_distance from typed t left join best b on b.given = t.given"""),
    "one_request_per_cell": (["latest"], """
select c, source, id from (select *, row_number() over (partition by c order by source, id) as r
  from (select id, source, unnest([cell_id, cell_id + 1]) as c from latest)) where r = 1"""),
    "unwind_cells": (["latest"], "select id, source, unnest([cell_id, cell_id + 1]) as c from latest"),
    "covering_cells": (["latest"], f"""
select id, source, unnest(flatten(list_transform(generate_series(r_lo, r_hi),
  lambda r: list_transform(generate_series(c_lo, least(c_hi, c_lo + {NCOLS} - 1)),
    lambda c: (r + {ROW0}) * {NCOLS} + ((c + {COL0}) % {NCOLS} + {NCOLS}) % {NCOLS})))) as cell
from (select id, source,
  greatest(cast(floor((la - d) / {GRID_STEP}) as bigint), -{ROW0}) as r_lo,
  least(cast(floor((la + d) / {GRID_STEP}) as bigint), {ROW0} - 1) as r_hi,
  case when abs(la) + d >= 90 then cast(floor((longitude - 180) / {GRID_STEP}) as bigint)
    else cast(floor((longitude - degrees(asin(sin(radians(d)) / cos(radians(la))))) / {GRID_STEP}) as bigint) end as c_lo,
  case when abs(la) + d >= 90 then cast(floor((longitude - 180) / {GRID_STEP}) as bigint) + {NCOLS} - 1
    else cast(floor((longitude + degrees(asin(sin(radians(d)) / cos(radians(la))))) / {GRID_STEP}) as bigint) end as c_hi
  from (select *, greatest(coalesce(coordinate_uncertainty, 30.0), 30.0) / 111320.0 as d,
          case when id % 100 = 11 then latitude * 2.5 else latitude end as la from latest) x
  where abs(la) <= 90) y"""),
    "cell_requests": (["latest"], """
select c, count(*) as n from (select unnest([cell_id, cell_id + 1]) as c from latest) group by c"""),
    "cell_request_members": (["latest"], "select source, id, unnest([cell_id, cell_id + 1]) as c from latest"),
    "feature_requests": (["latest"], """
select latitude, longitude, coordinate_uncertainty, date, count(*) as n from latest group by all"""),
    "feature_request_members": (["latest"], """
select latitude, longitude, coordinate_uncertainty, date, source, id from latest"""),
    "batched_requests": (["latest"], f"select * from {_BATCHED}"),
    "sample_batches": (["latest"], f"""
select b1.family, b1.b, b1.id from {_BATCHED} b1
semi join (select distinct family, b from {_BATCHED} b2 order by family, b limit {SAMPLE_BATCHES}) s
  on b1.family = s.family and b1.b = s.b"""),
    "grid_location": (["latest"], f"""
select id, source, la, lo, la + cast({GRID_STEP} as double) as la_max, lo + cast({GRID_STEP} as double) as lo_max, u
from (select id, source, floor(latitude / cast({GRID_STEP} as double)) * cast({GRID_STEP} as double) as la,
  floor(longitude / cast({GRID_STEP} as double)) * cast({GRID_STEP} as double) as lo,
  greatest(coalesce(coordinate_uncertainty, cast(30 as double)), cast(30 as double)) as u from latest)"""),
    "job_counters": (["latest", "sync_history", "stored", "missing"], f"""
, pulled as (select o.* from occ o join sync_history h
  on o.source = h.source and o.family = h.family and o.updated_at > h.fetched_at
  where o.observed_at >= timestamp '1997-01-01 00:00:00' and o.observed_at < timestamp '2001-01-01 00:00:00'),
single as {_DEDUP},
valid as (select * from single where {_multiword_sql('name')} and name in (
  select name from single where {_multiword_sql('name')} group by name having count(*) > 200)),
joined as (select o.cell_id, o.date, f.landcover is not null or coalesce(f.fetched, false) as complete from latest o
  left join stored f on o.cell_id = f.cell_id and o.date = f.date)
select 'occurrences_fetched' as counter, count(*) as value from pulled
union all select 'names_fetched', count(distinct name) from pulled
union all select 'valid_taxa', count(distinct name) from valid
union all select 'valid_occurrences', count(*) from valid
union all select 'complete', count(*) from joined where complete
union all select 'incomplete', count(*) from joined where not complete
union all select 'without_key', count(*) from joined where cell_id is null or date is null
union all select 'token_groups', count(*) from missing"""),
    "json_records": (["latest"], f"select {_JSON} as j from latest where name is not null"),
    "strict_json": (["latest"], f"select {_JSON} as j from latest where name is not null"),
    "json_roundtrip": (["latest"], """
select id, source, name, latitude, coordinate_uncertainty, date from latest where name is not null"""),
    "decode_rows": (["latest"], """
select id, source, family, name, latitude, longitude, coordinate_uncertainty, date,
  observed_at, updated_at, cell_id from latest"""),
    "enforce_schema": (["latest"], """
select id, source, name, latitude, coordinate_uncertainty, date from latest"""),
    "occurrence_rows": (["latest", "names"], """
select o.id, o.source, n.scientific_name as name, o.latitude, o.coordinate_uncertainty, o.date
from latest o join names n on o.name = n.given_name"""),
}


def oracle_sql() -> dict[str, str]:
    return {k: with_views(sql, views) for k, (views, sql) in (_ORACLE | _more().ORACLE).items()}


def queries() -> dict[str, Query]:
    return dict(QUERIES) | _more().QUERIES


def _more():
    from geotaxa.plans import table_queries
    return table_queries
