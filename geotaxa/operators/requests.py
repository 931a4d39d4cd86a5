"""Feature requests built from occurrences: unwinding to cells, squashing by
place, batching, sampling batches, grid snapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotaxa.functions.geo import buffered_uncertainty, covering_box, grid_floor
from geotaxa.functions.joins import null_safe_condition
from geotaxa.operators.ranking import batch_ids

PLACE_KEY = ("latitude", "longitude", "coordinate_uncertainty", "date")
# Fixed value: requests of a batch (the upper end of the source system's 50-100).
BATCH_SIZE = 100


def unwind_cells(df: DataFrame, cells: Column, out: str = "c",
                 keep: Sequence[str] = ("id", "source")) -> DataFrame:
    """One row per cell covered by the occurrence (``cells`` is an array
    column: the covering cells of the uncertain location)."""
    return df.select(*keep, F.explode(cells).alias(out))


def covering_cells(df: DataFrame, step: float, lat: str = "latitude", lon: str = "longitude",
                   unc: str = "coordinate_uncertainty", out: str = "cell",
                   keep: Sequence[str] = ("id", "source")) -> DataFrame:
    """One row per grid cell that an uncertain location touches.  Cell id =
    row * columns + column, rows counted from the south pole and columns from
    the antimeridian, so ids are non-negative and unique per cell.

    Rows are exploded first and columns after, so no task ever holds a whole
    box as one value: a record with a huge uncertainty is a stream of rows."""
    ncols, row0, col0 = int(round(360.0 / step)), int(round(90.0 / step)), int(round(180.0 / step))
    r_lo, r_hi, c_lo, c_hi = covering_box(lat, lon, unc, step)
    boxed = df.select(*keep, r_lo.alias("_r_lo"), r_hi.alias("_r_hi"), c_lo.alias("_c_lo"), c_hi.alias("_c_hi"))
    rows = boxed.where("_r_lo <= _r_hi").select(
        *keep, "_c_lo", "_c_hi", F.explode(F.sequence("_r_lo", "_r_hi")).alias("_r"))
    cells = rows.select(*keep, "_r", F.explode(F.sequence("_c_lo", "_c_hi")).alias("_c"))
    cell = (F.col("_r") + row0) * ncols + F.pmod(F.col("_c") + col0, F.lit(ncols))
    return cells.select(*keep, cell.alias(out))


def cell_requests(unwound: DataFrame, cell_col: str = "c", count: str = "n") -> DataFrame:
    """The header of one request per cell: the cell and its number of
    occurrences.  ``cell_request_members`` has the occurrences themselves."""
    return unwound.groupBy(cell_col).agg(F.count(F.lit(1)).alias(count))


def cell_request_members(unwound: DataFrame, cell_col: str = "c",
                         identity: Sequence[str] = ("source", "id")) -> DataFrame:
    """The occurrences of each cell request, as plain rows: a cell with a third
    of all occurrences is spread over tasks like any other rows."""
    return unwound.select(cell_col, *identity)


def feature_requests(df: DataFrame, place: Sequence[str] = PLACE_KEY, count: str = "n") -> DataFrame:
    """One request per (latitude, longitude, uncertainty, date): the place and
    its number of occurrences.  NULL uncertainty is a place of its own.
    ``feature_request_members`` has the occurrences."""
    return df.groupBy(*place).agg(F.count(F.lit(1)).alias(count))


def feature_request_members(df: DataFrame, place: Sequence[str] = PLACE_KEY,
                            identity: Sequence[str] = ("source", "id"),
                            batch_size: int | None = None, batch_col: str = "b") -> DataFrame:
    """The occurrences of each request, as plain rows.  With ``batch_size``
    they are numbered in batches of that many consecutive occurrences a place."""
    rows = df.select(*place, *identity)
    return rows if batch_size is None else batch_ids(rows, place, identity, batch_size, batch_col)


def batched_requests(df: DataFrame, group_cols: Sequence[str] = ("family",),
                     order_cols: Sequence[str] = ("source", "id"),
                     batch_size: int = BATCH_SIZE, out: str = "b") -> DataFrame:
    """Batch number of each row: ``batch_size`` consecutive rows (by
    ``order_cols``) per group share a batch.  Exact, and skew-safe through
    ``ordered_rank``."""
    return batch_ids(df, group_cols, order_cols, batch_size, out)


def sample_batches(batched: DataFrame, n: int = 3, group_cols: Sequence[str] = ("family",),
                   batch_col: str = "b") -> DataFrame:
    """Keep ``n`` whole batches (the first by group and batch number) and
    flatten them back to rows: a sampling operator, so the limit is the
    feature.  Only the small list of batch ids is ordered and limited."""
    keys = [*group_cols, batch_col]
    chosen = (batched.select(*keys).distinct()
                     .orderBy(*[F.col(c).asc() for c in keys]).limit(n))
    chosen = chosen.select([F.col(c).alias(f"_k_{c}") for c in keys])
    return batched.join(chosen, null_safe_condition(batched, chosen, keys, [f"_k_{c}" for c in keys]), "left_semi")


def first_batches(df: DataFrame, n: int = 3, group_cols: Sequence[str] = ("family",),
                  order_cols: Sequence[str] = ("source", "id"), batch_size: int = BATCH_SIZE, out: str = "b") -> DataFrame:
    """The rows of ``sample_batches(batched_requests(df))`` without numbering
    all rows: the first ``n`` batches lie within the first ``n * batch_size``
    rows by group and order (a top-k), and only those are numbered."""
    order = [F.col(c).asc() for c in (*group_cols, *order_cols)]
    head = df.orderBy(*order).limit(n * batch_size)
    place = F.row_number().over(Window.partitionBy(*group_cols).orderBy(*[F.col(c).asc() for c in order_cols]))
    numbered = head.withColumn(out, F.floor((place - 1) / F.lit(batch_size)).cast("long"))
    batch = F.dense_rank().over(Window.orderBy(*[F.col(c).asc() for c in (*group_cols, out)]))   # of n * batch_size rows
    return numbered.withColumn("_n", batch).where(F.col("_n") <= n).drop("_n")


def grid_location(df: DataFrame, step: float = 0.25, lat: str = "latitude", lon: str = "longitude",
                  unc: str = "coordinate_uncertainty") -> DataFrame:
    """Snap a location to a ``step``-degree grid: the cell's south-west corner
    (``la``, ``lo``) and north-east corner (``la_max``, ``lo_max``), and the
    precision buffered to at least 30 m (``u``; a missing one becomes 30 m)."""
    return (df.withColumn("la", grid_floor(lat, step)).withColumn("lo", grid_floor(lon, step))
              .withColumn("la_max", F.col("la") + F.lit(float(step))).withColumn("lo_max", F.col("lo") + F.lit(float(step)))
              .withColumn("u", buffered_uncertainty(unc)))
