"""Feature enrichment: join stored features, split complete / incomplete,
fetch what is missing once per key, append it, merge both halves back.

A feature is described by a ``FeatureSpec``.  Its values come either from a
lookup table (a join) or from a user function that is called on batches of
*distinct missing keys* inside ``mapInPandas`` -- never on whole groups of
occurrences, so a key shared by a third of all rows is still one call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotaxa.functions.joins import own_shuffle
from geotaxa.operators.versions import first_per_group

# Fixed value: keys per call of a user fetch function (upper end of the
# 50-100 batch size the source system used for remote requests).
DEFAULT_FETCH_BATCH = 100
FETCHED = "fetched"
APPENDED = "appended_at"


@dataclass
class FeatureSpec:
    """One environmental feature.

    name        table / counter name
    key_cols    columns a feature value depends on (e.g. cell and date)
    value_cols  the feature columns
    lookup      table with key_cols + value_cols to fetch from, or
    fetch       function(pandas keys) -> pandas keys + value_cols; key columns
                must come back unchanged; keys it does not return are
                "fetched, nothing there".  A class with a ``fetch`` method
                works too: it is instantiated once per task (e.g. to open a
                client) and reused for all of the task's key batches.
    value_types Spark types of value_cols (needed for ``fetch``)
    complete    function() -> condition on the value columns that makes a row
                complete (default: every value is present)
    fetch_tasks tasks that call ``fetch`` (default: the session's shuffle
                partitions)
    """

    name: str
    key_cols: Sequence[str] = ("cell_id", "date")
    value_cols: Sequence[str] = ("landcover",)
    lookup: DataFrame | None = None
    fetch: Callable[[pd.DataFrame], pd.DataFrame] | None = None
    value_types: Sequence[T.DataType] = field(default_factory=lambda: [T.LongType()])
    batch_size: int = DEFAULT_FETCH_BATCH
    complete: Callable[[], Column] | None = None
    fetch_tasks: int | None = None


def feature_table_schema(spec: FeatureSpec, key_types: Sequence[T.DataType] | None = None) -> T.StructType:
    """Declared schema of a feature table: keys, values, the ``fetched`` flag
    and the time of the append (key types default to the (cell id, date) key)."""
    kt = list(key_types) if key_types is not None else [T.LongType(), T.DateType()]
    fields = [T.StructField(k, t, False) for k, t in zip(spec.key_cols, kt)]
    fields += [T.StructField(v, t, True) for v, t in zip(spec.value_cols, spec.value_types)]
    fields.append(T.StructField(FETCHED, T.BooleanType(), True))
    fields.append(T.StructField(APPENDED, T.TimestampType(), True))
    return T.StructType(fields)


def _keys(spec: FeatureSpec) -> list[str]:
    return list(spec.key_cols)


def _without_values(occ: DataFrame, spec: FeatureSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Occurrences without feature columns of their own (e.g. from an earlier
    enrichment): the join's values replace them instead of duplicating them."""
    drop = [c for c in (*spec.value_cols, *extra) if c in occ.columns]
    return occ.drop(*drop) if drop else occ


def has_key(spec: FeatureSpec) -> Column:
    """All key columns are there; a row without a key has no feature."""
    cond = None
    for k in spec.key_cols:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return cond


# Before every time: stands in for a row without a time of append.
_NO_TIME = "0001-01-01 00:00:00"
_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def one_row_per_key(table: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Keys, values and ``fetched`` of a feature table, one row per key: a
    complete row before an incomplete one, then the latest append, then the
    largest values (so the pick depends on the rows alone).  ``fetched`` is
    true if any of the key's rows has it; rows without a key are left out.

    A key stored very often shrinks in the map tasks.  A single value of fixed
    width is picked by two hash aggregates (per key and time of append, then per
    key); other values by rank, whose partial limit does the same."""
    keys, values = _keys(spec), list(spec.value_cols)
    flag = F.coalesce(F.col(FETCHED), F.lit(False)) if FETCHED in table.columns else F.lit(False)
    kind = table.schema[APPENDED].dataType if APPENDED in table.columns else T.TimestampNTZType()
    none = F.lit(_NO_TIME).cast(kind)
    at = F.coalesce(F.col(APPENDED), none) if APPENDED in table.columns else none
    rows = table.where(has_key(spec)).select(*keys, *values, is_complete(spec).alias("_full"), at.alias("_at"), flag.alias(FETCHED))
    if len(values) == 1 and isinstance(table.schema[values[0]].dataType, _FIXED_WIDTH):
        v = values[0]
        timed = rows.groupBy(*keys, "_full", "_at").agg(F.max(v).alias(v), F.max(FETCHED).alias(FETCHED))
        of = lambda full: F.max_by(F.when(F.col("_full") == full, F.col(v)), F.when(F.col("_full") == full, F.col("_at")))
        best = timed.groupBy(*keys).agg(F.max("_full").alias("_full"), of(True).alias("_a"), of(False).alias("_b"), F.max(FETCHED).alias(FETCHED))
        return best.select(*keys, F.when(F.col("_full"), F.col("_a")).otherwise(F.col("_b")).alias(v), FETCHED)
    order = [F.col("_full").desc(), F.col("_at").desc(), *[F.col(v).desc() for v in values]]
    best = first_per_group(rows.drop(FETCHED), keys, order).select(*keys, *values)
    if FETCHED not in table.columns:
        return best.withColumn(FETCHED, F.lit(False))
    known = rows.where(FETCHED).select(*keys).distinct().withColumn(FETCHED, F.lit(True))
    return best.join(known, on=keys, how="left").withColumn(FETCHED, F.coalesce(FETCHED, F.lit(False)))


def stored_values(stored: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Key, value and ``fetched`` columns of a stored feature table, one row
    per key (tables written before the flag existed count as not fetched)."""
    return one_row_per_key(stored, spec)


def join_existing_features(occ: DataFrame, stored: DataFrame, spec: FeatureSpec,
                           with_flag: bool = True) -> DataFrame:
    """Occurrences LEFT JOIN stored features on the feature key, with the
    ``fetched`` flag (so fetched-but-empty keys count as complete in the
    split, as they do in ``missing_feature_keys``).  The stored table grows
    with the data, so the planner chooses the strategy; AQE splits a hot key
    on the occurrence side."""
    right = stored_values(stored, spec)
    if not with_flag:
        right = right.drop(FETCHED)
    return _without_values(occ, spec, [FETCHED] if with_flag else []).join(own_shuffle(right), on=_keys(spec), how="left")


def is_complete(spec: FeatureSpec, flag: str | None = None) -> Column:
    """Complete = the feature's rule holds (every value present, by default),
    or already fetched (fetched-but-empty is not fetched again).  NULL counts
    as incomplete."""
    cond = None
    if spec.complete is not None:
        cond = F.coalesce(spec.complete(), F.lit(False))
    else:
        for v in spec.value_cols:
            c = F.col(v).isNotNull()
            cond = c if cond is None else (cond & c)
    if flag is not None:
        cond = cond | F.coalesce(F.col(flag), F.lit(False))
    return cond


def with_completeness(joined: DataFrame, spec: FeatureSpec, out: str = "complete") -> DataFrame:
    flag = FETCHED if FETCHED in joined.columns else None
    return joined.withColumn(out, is_complete(spec, flag))


def complete_rows(joined: DataFrame, spec: FeatureSpec) -> DataFrame:
    flag = FETCHED if FETCHED in joined.columns else None
    return joined.where(is_complete(spec, flag))


def incomplete_rows(joined: DataFrame, spec: FeatureSpec) -> DataFrame:
    flag = FETCHED if FETCHED in joined.columns else None
    return joined.where(~is_complete(spec, flag))


def completeness_partition(joined: DataFrame, spec: FeatureSpec,
                           out: str = "complete", count: str = "c") -> DataFrame:
    """Row count of each side of the complete / incomplete split."""
    return with_completeness(joined, spec, out).groupBy(out).agg(F.count(F.lit(1)).alias(count))


def _known_keys(stored: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Keys that need no fetch: a value is stored or they were fetched."""
    s = stored_values(stored, spec)
    return s.where(is_complete(spec, FETCHED)).select(*_keys(spec))


def missing_feature_groups(occ: DataFrame, stored: DataFrame, spec: FeatureSpec,
                           count: str = "c") -> DataFrame:
    """(key, number of occurrences) for keys without a stored feature.
    Counted first (partial aggregation), then anti-joined: only one row per
    key reaches the join.  Occurrences without a key are in no group."""
    groups = occ.where(has_key(spec)).groupBy(*_keys(spec)).agg(F.count(F.lit(1)).alias(count))
    return groups.join(_known_keys(stored, spec), on=_keys(spec), how="left_anti")


def missing_feature_keys(occ: DataFrame, stored: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Distinct keys without a stored feature (what a fetch must look up)."""
    return (occ.where(has_key(spec)).select(*_keys(spec)).distinct()
               .join(_known_keys(stored, spec), on=_keys(spec), how="left_anti"))


def _fetch_in_batches(spec: FeatureSpec, schema: T.StructType):
    keys, values, size = _keys(spec), list(spec.value_cols), spec.batch_size
    user_fetch = spec.fetch

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = user_fetch().fetch if isinstance(user_fetch, type) else user_fetch
        for pdf in batches:
            for start in range(0, len(pdf), size):
                chunk = pdf.iloc[start:start + size][keys].reset_index(drop=True)
                got = call(chunk)
                got = (got[keys + values].drop_duplicates(keys) if len(got)
                       else pd.DataFrame(columns=keys + values))
                out = chunk.merge(got, on=keys, how="left")
                out[FETCHED] = True
                yield out[[f.name for f in schema.fields]]
    return run


def fetch_missing_features(keys: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One row per missing key with the fetched values (NULL when the source
    has nothing) and ``fetched = true``.

    Lookup-backed: LEFT JOIN of the distinct keys with the lookup table (one
    row per key).  Function-backed: the keys are dealt to ``fetch_tasks`` tasks,
    which call the function on Arrow batches, once per ``batch_size`` keys; one
    call per key overall, and the calls of different tasks overlap."""
    k = keys.select(*_keys(spec))
    if spec.lookup is not None:
        return (k.join(one_row_per_key(spec.lookup, spec).drop(FETCHED), on=_keys(spec), how="left")
                 .withColumn(FETCHED, F.lit(True)))
    if spec.fetch is None:
        raise ValueError(f"feature {spec.name!r} has neither a lookup nor a fetch function")
    fields = [k.schema[c] for c in _keys(spec)]
    fields += [T.StructField(v, t, True) for v, t in zip(spec.value_cols, spec.value_types)]
    fields.append(T.StructField(FETCHED, T.BooleanType(), False))
    schema = T.StructType(fields)
    tasks = spec.fetch_tasks or int(k.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt row by row: a hash of the keys would be what they are shuffled by
    # already, and Spark would then leave them in the few partitions AQE made.
    return k.repartition(tasks).mapInPandas(_fetch_in_batches(spec, schema), schema)


def feature_rows_to_append(occ: DataFrame, stored: DataFrame, spec: FeatureSpec,
                           found_only: bool = True) -> DataFrame:
    """Rows to append to the feature table: the missing keys' fetched values
    (only those found, or all with the ``fetched`` flag)."""
    got = fetch_missing_features(missing_feature_keys(occ, stored, spec), spec)
    if found_only:
        return got.where(is_complete(spec)).select(*_keys(spec), *spec.value_cols)
    return got


def merge_features(occ: DataFrame, stored: DataFrame, fetched: DataFrame,
                   spec: FeatureSpec, origin_col: str | None = None) -> DataFrame:
    """Every occurrence once, with its fetched value where its key was fetched
    and its stored value otherwise.

    Stored and fetched rows are reduced to one row per key (a complete one
    first, then the fetched one) and joined back to the occurrences once: a
    single shuffle of the large side, and no key can multiply its rows.  With
    ``origin_col`` a column says where the value came from: ``stored``,
    ``fetched`` or NULL."""
    keys = _keys(spec)
    parts = []
    for name, table in (("_s", stored), ("_f", fetched)):
        one = one_row_per_key(table, spec)
        parts.append(one.select(*keys, F.struct(is_complete(spec).alias("full"), *spec.value_cols).alias(name)))
    both = parts[0].join(parts[1], on=keys, how="full")     # both are one row per key, dealt by key
    full = lambda side: F.coalesce(F.col(f"{side}.full"), F.lit(False))
    new = full("_f") | (~full("_s") & F.col("_f").isNotNull())
    merged = both.select(*keys, *[F.when(new, F.col(f"_f.{v}")).otherwise(F.col(f"_s.{v}")).alias(v) for v in spec.value_cols],
                         *([F.when(new, "fetched").otherwise("stored").alias(origin_col)] if origin_col else []))
    return _without_values(occ, spec, [origin_col] if origin_col else []).join(own_shuffle(merged), on=keys, how="left")


def grouped_occurrences(merged: DataFrame, specs: Sequence[FeatureSpec],
                        identity: Sequence[str] = ("source", "id"), count: str = "c",
                        rows: str = "rows") -> DataFrame:
    """Per occurrence its feature rows, (feature, value as text), in feature
    order, and their number; occurrences without any are left out.

    ``merged`` holds every occurrence once with the values of all ``specs``
    (``merge_features``, ``combine_features``), so the rows stand beside each
    other already: no grouping, and at most one row per value column."""
    parts = [(v if len(spec.value_cols) > 1 else spec.name, spec, v) for spec in specs for v in spec.value_cols]
    found = [F.when(is_complete(spec), F.struct(F.lit(name).alias("feature"), F.col(v).cast("string").alias("value")))
             for name, spec, v in sorted(parts, key=lambda x: x[0])]
    own = merged.select(*identity, F.filter(F.array(*found), lambda x: x.isNotNull()).alias(rows))
    return own.where(F.size(rows) > 0).select(*identity, F.size(rows).cast("long").alias(count), rows)


def combine_features(occ: DataFrame, specs: Sequence[tuple[FeatureSpec, DataFrame]]) -> DataFrame:
    """Put several features' values on the occurrences; one feature row serves
    many occurrences.

    Features with the same key are first put together per key; the occurrences
    are then joined once per distinct key, so a hot key's rows move once and
    AQE can split them."""
    by_key: dict[tuple[str, ...], list[tuple[FeatureSpec, DataFrame]]] = {}
    for spec, table in specs:
        by_key.setdefault(tuple(spec.key_cols), []).append((spec, table))
    out = occ
    for keys, parts in by_key.items():
        together = None
        for spec, table in parts:
            own = one_row_per_key(table, spec).drop(FETCHED)
            together = own if together is None else together.join(own, on=list(keys), how="full")
            out = _without_values(out, spec)
        out = out.join(own_shuffle(together), on=list(keys), how="left")
    return out


def feature_vectors(table: DataFrame, spec: FeatureSpec, series_key: str = "cell_id",
                    order_col: str = "date", value_col: str | None = None,
                    out: str = "v", as_text: bool = True) -> DataFrame:
    """Per series (e.g. cell), the values sorted by date as one vector; a
    missing value keeps its place (``null`` in the text form).

    The table is reduced to one row per key first, so a vector's length is
    bounded by the number of dates, not by the number of rows."""
    v = value_col or spec.value_cols[0]
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order_col), F.col(v))))
    values = F.transform(ordered, lambda x: x[v])
    if as_text:
        values = F.array_join(F.transform(values, lambda x: x.cast("string")), ",", "null")
    return one_row_per_key(table, spec).groupBy(series_key).agg(values.alias(out))


def valid_feature_vectors(table: DataFrame, spec: FeatureSpec, min_length: int, series_key: str = "cell_id",
                          value_col: str | None = None, count: str = "n") -> DataFrame:
    """Series whose vector holds at least ``min_length`` values (counted, not
    collected; a missing value is a place, not a value)."""
    v = value_col or spec.value_cols[0]
    return (one_row_per_key(table, spec).groupBy(series_key).agg(F.count(v).alias(count))
                 .where(F.col(count) >= min_length))
