"""Location and time helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: smallest feature resolution, in metres; locations without a
# stated precision get it, and smaller uncertainties are buffered up to it.
MIN_RESOLUTION_M = 30.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid_floor(c: str | Column, step: float) -> Column:
    """Snap a coordinate down to a grid of ``step`` degrees (double maths;
    a bare decimal literal would turn the result into DECIMAL)."""
    s = F.lit(float(step)).cast("double")
    return F.floor(_col(c) / s) * s


def buffered_uncertainty(c: str | Column, minimum: float = MIN_RESOLUTION_M) -> Column:
    """Fill a missing precision and buffer it to at least ``minimum`` metres."""
    m = F.lit(float(minimum)).cast("double")
    return F.greatest(F.coalesce(_col(c).cast("double"), m), m)


def timestamp_literal(value: _dt.date | _dt.datetime | str,
                      like: T.DataType | None = None) -> Column:
    """A timestamp literal typed like the column it is compared with.

    Comparing a TIMESTAMP_NTZ column with a session-zone literal would make
    Spark shift one side; building the literal from text in the column's own
    type keeps the comparison exact (midnight for a bare date)."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    target = like if isinstance(like, (T.TimestampType, T.TimestampNTZType)) else T.TimestampType()
    return F.lit(text).cast(target)


# Fixed value: mean length of one degree of latitude, in metres.
METRES_PER_DEGREE = 111_320.0


def covering_box(lat: str | Column, lon: str | Column, unc: str | Column,
                 step: float, minimum: float = MIN_RESOLUTION_M) -> tuple[Column, Column, Column, Column]:
    """(first row, last row, first column, last column) of the ``step``-degree
    grid cells touched by the box around an uncertain location: half-width =
    the buffered uncertainty in metres; in longitude that of the circle,
    asin(sin(half-width) / cos(latitude)), which is reached off its own row.
    Rows count from the equator and stop at the poles; columns count from the
    prime meridian, may pass the antimeridian (wrap them) and never go round
    more than once.  A box that reaches a pole covers every column.  For a
    latitude beyond a pole, or a missing one, the last row is before the first."""
    la, lo = _col(lat), _col(lon)
    s = F.lit(float(step)).cast("double")
    metres = buffered_uncertainty(unc, minimum)
    dlat = metres / F.lit(METRES_PER_DEGREE)
    ncols = int(round(360.0 / step))
    row0 = int(round(90.0 / step))
    r_lo = F.greatest(F.floor((la - dlat) / s), F.lit(-row0))
    r_hi = F.least(F.floor((la + dlat) / s), F.lit(row0 - 1))
    valid = F.coalesce((F.abs(la) <= 90) & lo.isNotNull(), F.lit(False))
    polar = F.abs(la) + dlat >= 90
    dlon = F.when(~polar, F.degrees(F.asin(F.sin(F.radians(dlat)) / F.cos(F.radians(la)))))
    c_lo = F.when(polar, F.floor((lo - 180) / s)).otherwise(F.floor((lo - dlon) / s))
    c_hi = F.when(polar, c_lo + ncols - 1).otherwise(F.floor((lo + dlon) / s))
    return (F.when(valid, r_lo).otherwise(0), F.when(valid, r_hi).otherwise(-1),
            c_lo, F.least(c_hi, c_lo + ncols - 1))
