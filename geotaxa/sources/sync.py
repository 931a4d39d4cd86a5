"""Sync-driven pulls: for every (source, family) in the sync history, the
records of that source and family updated after its high-water mark.

The history is a small dimension table (one mark per source and family).  It
is reduced to the latest mark per (source, family), so overlapping history
rows cannot duplicate records; the planner broadcasts it where it is small.
The smallest mark is also applied as a scalar subquery on ``updated_at``, in
the column's own type: it runs with the query, needs no session time zone, and
reaches the scan as a filter."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.functions.geo import timestamp_literal

# The default observation window, half-open [after, before).
OBSERVED_AFTER = _dt.date(2015, 1, 1)
OBSERVED_BEFORE = _dt.date(2019, 1, 1)
# The providers pulled by default.
DEFAULT_SOURCES = ["idigbio", "inaturalist", "gbif", "mycoportal", "mushroomobserver"]

_UNSET = object()


def source_list(raw: DataFrame, source_col: str = "source") -> DataFrame:
    """The providers present in the record table."""
    return raw.select(source_col).distinct()


def reduce_history(history: DataFrame, restrict_sources: Sequence[str] | None = None,
                   restrict_families: Sequence[str] | None = None) -> DataFrame:
    """Latest mark per (source, family), after the optional restrictions."""
    h = history
    if restrict_sources is not None:
        h = h.where(F.col("source").isin(list(restrict_sources)))
    if restrict_families is not None:
        h = h.where(F.col("family").isin(list(restrict_families)))
    return h.groupBy("source", "family").agg(F.max("fetched_at").alias("fetched_at"))


def sync_queue(history: DataFrame, sources: Sequence[str] = DEFAULT_SOURCES) -> DataFrame:
    """The providers expanded into their history rows; one without history
    yields nothing.  Reads the history only."""
    return history.where(F.col("source").isin(list(sources))).select("source", "family", "fetched_at")


def pending_pull_count(history: DataFrame, restrict_sources: Sequence[str] | None = None,
                       restrict_families: Sequence[str] | None = None, out: str = "n") -> DataFrame:
    """How many pulls are due: history rows left after the restrictions."""
    h = history
    if restrict_sources is not None:
        h = h.where(F.col("source").isin(list(restrict_sources)))
    if restrict_families is not None:
        h = h.where(F.col("family").isin(list(restrict_families)))
    return h.agg(F.count(F.lit(1)).alias(out))


def incremental_pull(raw: DataFrame, history: DataFrame,
                     observed_after=_UNSET, observed_before=_UNSET,
                     modified_before=None,
                     restrict_sources: Sequence[str] | None = None,
                     restrict_families: Sequence[str] | None = None,
                     prune_with_min_mark: bool = True) -> DataFrame:
    """Records with ``updated_at`` strictly after their (source, family) mark,
    observed in ``[observed_after, observed_before)`` and, if given, updated
    before ``modified_before``.  ``None`` for a bound means no predicate; the
    observed window defaults to 2015-01-01 .. 2019-01-01.  Restrictions limit
    sources and families.  Output: the record columns (a LEFT SEMI join, so
    each record is pulled once).  History rows with a NULL source, family or
    mark match nothing."""
    if observed_after is _UNSET:
        observed_after = OBSERVED_AFTER
    if observed_before is _UNSET:
        observed_before = OBSERVED_BEFORE
    upd_t = raw.schema["updated_at"].dataType
    obs_t = (raw.schema["observed_at"].dataType
             if observed_after is not None or observed_before is not None else None)
    r = raw
    if observed_after is not None:
        r = r.where(F.col("observed_at") >= timestamp_literal(observed_after, obs_t))
    if observed_before is not None:
        r = r.where(F.col("observed_at") < timestamp_literal(observed_before, obs_t))
    if modified_before is not None:
        r = r.where(F.col("updated_at") < timestamp_literal(modified_before, upd_t))
    if restrict_sources is not None:
        r = r.where(F.col("source").isin(list(restrict_sources)))
    if restrict_families is not None:
        r = r.where(F.col("family").isin(list(restrict_families)))

    marks = reduce_history(history, restrict_sources, restrict_families)
    marks = marks.select(F.col("source").alias("_h_source"), F.col("family").alias("_h_family"),
                         F.col("fetched_at").cast(upd_t).alias("_h_mark"))
    marks = marks.where("_h_source is not null and _h_family is not null and _h_mark is not null")
    if prune_with_min_mark:
        r = r.where(F.col("updated_at") > marks.agg(F.min("_h_mark")).scalar())
    cond = ((r["source"] == marks["_h_source"]) & (r["family"] == marks["_h_family"])
            & (r["updated_at"] > marks["_h_mark"]))
    return r.join(marks, cond, "left_semi")


def next_marks(pulled: DataFrame, history: DataFrame | None = None, unwritten: Column | None = None) -> DataFrame:
    """New high-water marks after a pull: latest ``updated_at`` per (source,
    family) among the pulled records.  With ``history``, pairs that pulled
    nothing keep their old mark (one row per pair either way).

    ``unwritten`` marks records that the job left out (e.g. an unresolved
    name): a pair's mark stays before its first such record, so the next pull
    sees it again."""
    pair = ["source", "family"]
    if unwritten is not None:
        held = pulled.where(unwritten).groupBy(*pair).agg(F.min("updated_at").alias("_held"))
        pulled = pulled.join(held, pair, "left").where("_held is null or updated_at < _held")
    new = pulled.groupBy(*pair).agg(F.max("updated_at").alias("fetched_at"))
    if history is None:
        return new
    old = reduce_history(history).select(
        *pair, F.col("fetched_at").cast(new.schema["fetched_at"].dataType).alias("fetched_at"))
    return old.unionByName(new).groupBy(*pair).agg(F.max("fetched_at").alias("fetched_at"))
