"""The three end-to-end jobs, each a composition of the operators.

* ``read_occurrences``  latest version -> dedup by name/place/date -> taxa
                        filter (the flagship);
* ``harvest``           incremental pull against the sync history -> name
                        normalization -> JSON lines;
* ``enrich_features``   join stored features -> split complete / incomplete ->
                        fetch the missing keys once -> append them -> merge
                        and regroup per occurrence.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotaxa.operators.dedup import DEDUP_KEY, spatial_dedup
from geotaxa.operators.features import (APPENDED, FeatureSpec, fetch_missing_features,
                                        grouped_occurrences, has_key, is_complete, merge_features,
                                        missing_feature_keys)
from geotaxa.operators.metrics import count_where
from geotaxa.operators.names import normalize_names
from geotaxa.operators.taxa import DEFAULT_THRESHOLD, taxa_threshold
from geotaxa.operators.versions import latest_version
from geotaxa.session import materialize
from geotaxa.sinks.writers import append_table, occurrence_rows, write_json_lines
from geotaxa.sources.sync import incremental_pull


def read_occurrences(raw: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                     name_col: str = "name", observations: list | None = None,
                     tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest version of each record (``tie_break`` columns settle versions of
    one time), one per (name, place, date), only taxa with more than
    ``threshold`` rows and a multi-word name.

    With an ``observations`` list, two Observations are appended and filled
    by the first action on the result: ``read.taxa`` (``valid_taxa``) and
    ``read.rows`` (``valid_occurrences``)."""
    taxa_obs = Observation("read.taxa") if observations is not None else None
    single = spatial_dedup(latest_version(raw, tie_break=tie_break), (name_col, *DEDUP_KEY[1:]))
    out = taxa_threshold(single, threshold, name_col, taxa_observation=taxa_obs)
    if observations is not None:
        rows_obs = Observation("read.rows")
        out = out.observe(rows_obs, F.count(F.lit(1)).alias("valid_occurrences"))
        observations.extend([taxa_obs, rows_obs])
    return out


def harvest(raw: DataFrame, history: DataFrame, names: DataFrame,
            out_path: str | None = None, observations: list | None = None,
            **pull_options) -> DataFrame:
    """Pull what changed since each (source, family) mark, normalize names
    and (optionally) write the formattable records as JSON lines.  Returns the
    normalized records.

    With ``out_path`` and an ``observations`` list, the write fills
    ``harvest`` counters: ``occurrences_fetched`` (pulled records) and
    ``occurrences_written`` (records with a resolved name)."""
    pulled = incremental_pull(raw, history, **pull_options)
    normalized = normalize_names(pulled, names)
    if out_path is not None:
        # Pulled once: the lines and whatever the caller does with the result
        # read the same table.
        normalized = materialize(normalized, "harvest")
        rows = occurrence_rows(normalized)
        if observations is not None:
            obs = Observation("harvest")
            flagged = normalized.withColumn("_ok", F.col("scientific_name").isNotNull())
            rows = occurrence_rows(flagged.observe(
                obs, F.count(F.lit(1)).alias("occurrences_fetched"),
                count_where(F.col("_ok")).alias("occurrences_written")).drop("_ok"))
            observations.append(obs)
        write_json_lines(rows, out_path)
    return normalized


@dataclass
class Enrichment:
    """Outputs of ``enrich_features``.

    ``merged``   every occurrence once, with its feature values;
    ``grouped``  per occurrence: its feature rows and their number;
    ``counters`` named counters, filled by the passes that compute them
                 (the fetch counters by the append when ``store_path`` is
                 given, the others by the first action on ``merged``)."""

    merged: DataFrame
    grouped: DataFrame
    observations: list = field(default_factory=list)

    def counters(self) -> dict:
        out: dict = {}
        for obs in self.observations:
            out.update(obs.get)
        return out


def enrich_features(occ: DataFrame, stored: DataFrame, spec: FeatureSpec,
                    store_path: str | None = None, batch_id: str | None = None,
                    identity: Sequence[str] = ("source", "id")) -> Enrichment:
    """Fetches run once per missing key.  With ``store_path`` the fetched rows
    (values and the ``fetched`` flag, so empty answers are not fetched again)
    are appended to the feature table there, in a partition ``batch=<id>``,
    and that partition is read back: both outputs then use the written rows
    instead of calling the fetch a second time, and a lost executor re-reads
    files instead of re-fetching.

    Counters (``<feature>.`` prefix): ``records_fetched`` and ``values_found``
    (one per missing key), ``complete`` and ``incomplete`` occurrences before
    the fetch, ``with_value`` after the merge, ``without_key`` occurrences that
    no feature can have."""
    name = spec.name
    if spec.fetch is not None and store_path is None:
        raise ValueError(f"feature {name!r} is fetched by a function: give a store_path, so each key is fetched once")
    observations = []
    missing = missing_feature_keys(occ, stored, spec)
    fetched = fetch_missing_features(missing, spec)
    if store_path is not None:
        batch = batch_id or uuid.uuid4().hex
        fetch_obs = Observation(f"{name}.fetch")
        counted = fetched.observe(
            fetch_obs,
            F.count(F.lit(1)).alias(f"{name}.records_fetched"),
            count_where(is_complete(spec)).alias(f"{name}.values_found"))
        append_table(counted.withColumn(APPENDED, F.current_timestamp()).withColumn("batch", F.lit(batch)), store_path, partition_by=["batch"])
        observations.append(fetch_obs)
        # Read back with the known schema: a run that fetched nothing wrote
        # no data files to infer one from.
        schema = T.StructType(fetched.schema.fields + [T.StructField("batch", T.StringType())])
        fetched = (occ.sparkSession.read.schema(schema).parquet(store_path)
                   .where(F.col("batch") == batch).drop("batch"))
    merged = merge_features(occ, stored, fetched, spec, origin_col="_origin")
    # Counted on the merged rows in the pass that computes them: a value kept
    # from the store means the occurrence was complete before the fetch.
    merge_obs = Observation(f"{name}.merge")
    from_store = F.coalesce(F.col("_origin") == "stored", F.lit(False))
    merged = merged.observe(
        merge_obs,
        count_where(from_store).alias(f"{name}.complete"),
        count_where(~from_store).alias(f"{name}.incomplete"),
        count_where(is_complete(spec)).alias(f"{name}.with_value"),
        count_where(~has_key(spec)).alias(f"{name}.without_key"),
    ).drop("_origin")
    observations.append(merge_obs)
    grouped = grouped_occurrences(merged, [spec], identity)
    return Enrichment(merged, grouped, observations)

