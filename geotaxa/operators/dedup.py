"""Deduplication of observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.operators.versions import first_per_group

# Two observations are the same when name, place, precision and date agree.
DEDUP_KEY = ("name", "latitude", "longitude", "coordinate_uncertainty", "date")


def dedup_order() -> list[Column]:
    """The source system keeps an arbitrary member; we keep the first by
    source, then id."""
    return [F.col("source").asc(), F.col("id").asc()]


def spatial_dedup(df: DataFrame, keys: Sequence[str] = DEDUP_KEY,
                  order: Sequence[Column] | None = None) -> DataFrame:
    """One row per (name, latitude, longitude, uncertainty, date).

    NULLs group together (a NULL uncertainty is one group), NaN is one group
    and -0.0 equals 0.0, as in GROUP BY.  Partial ``WindowGroupLimit`` keeps one
    row per key per map task, so a hot key shrinks before the shuffle."""
    return first_per_group(df, keys, order if order is not None else dedup_order())


def one_request_per_cell(df: DataFrame, cell_col: str = "cell_id",
                         order: Sequence[Column] | None = None) -> DataFrame:
    """First row per cell (the other rows of the cell are not kept: use
    ``cell_requests`` for the lossless form)."""
    return first_per_group(df, [cell_col], order if order is not None else dedup_order())
