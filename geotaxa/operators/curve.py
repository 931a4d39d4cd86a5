"""Cells of many sizes on a space-filling curve.

Level L cuts the map into 2^L x 2^L cells.  A cell's id is a leading one bit and
then the interleaved bits of its column and row (a Z-order curve), so

* ids of different levels never meet, and the id holds its level;
* the ancestor of a cell k levels up is its id without the last 2k bits;
* cells near each other mostly have ids near each other, which keeps row-group
  statistics narrow in a table sorted by id.

``curve_covering`` picks the level from the precision of each location, so a
record has a handful of cells whether it is known to 30 metres or to a county.
``containing`` joins two sets of cells of mixed levels where one holds the
other: each side is looked up under its own ancestors at the levels the other
side uses, which is one equality join on ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.functions.geo import METRES_PER_DEGREE, buffered_uncertainty
from geotaxa.functions.joins import own_shuffle
from geotaxa.session import materialize

# Level 19 cells are 38 m high, level 14 cells 1.2 km.
FINEST = 19
# The steps that move the bits of a number apart (shift, mask).
SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
          (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _step(shift: int, mask: int):
    return lambda v: v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))


def _side(level: Column) -> Column:
    """Cells along one side of the map."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), level.cast("int"))


def _join_bits(x: Column, y: Column, level: Column) -> Column:
    """The id of ``level`` from a column and a row whose bits were moved apart."""
    lead = F.call_function("shiftleft", F.lit(1).cast("long"), (2 * level).cast("int"))
    return lead.bitwiseOR(x).bitwiseOR(F.shiftleft(y, 1))


def cell_of(x: Column, y: Column, level: Column) -> Column:
    # Binary digits that are read to base 4 are bits with a zero before each.
    apart = lambda v: F.conv(F.bin(v.cast("long")), 4, 10).cast("long")
    return _join_bits(apart(x), apart(y), level)


def level_of(cell: str | Column) -> Column:
    """Level of an id: half of the bits behind its leading one."""
    c = F.col(cell) if isinstance(cell, str) else cell
    return ((F.length(F.bin(c)) - 1) / 2).cast("int")


def ancestor(cell: str | Column, level: str | Column) -> Column:
    """The cell of ``level`` that holds ``cell``; null if ``cell`` is larger."""
    c = F.col(cell) if isinstance(cell, str) else cell
    to = F.col(level) if isinstance(level, str) else level
    up = level_of(c) - to
    return F.when(up >= 0, F.call_function("shiftright", c, (2 * up).cast("int")))


def point_cell(lat: str | Column, lon: str | Column, level: int = FINEST) -> Column:
    """The cell of a point; null without a latitude between the poles or
    without a longitude.  Longitudes wrap; a pole lies in the last row."""
    la, lo = (F.col(c) if isinstance(c, str) else c for c in (lat, lon))
    n = float(1 << level)
    y = F.least(F.floor((la + 90) / 180 * n), F.lit(n - 1)).cast("long")
    x = F.pmod(F.floor((lo + 180) / 360 * n).cast("long"), F.lit(1 << level))
    return F.when((F.abs(la) <= 90) & lo.isNotNull(), cell_of(x, y, F.lit(level)))


def curve_covering(df: DataFrame, lat: str = "latitude", lon: str = "longitude", unc: str = "coordinate_uncertainty",
                   out: str = "cell", keep: Sequence[str] = ("id", "source"), refine: int = 1, finest: int = FINEST) -> DataFrame:
    """One row per cell of the covering of each uncertain location.

    The covering holds the circle's box (see ``covering_box``).  Its level is
    the finest at which a cell is at least as wide and as high as half the box,
    plus ``refine``, at most ``finest``: so it has at most 2^(refine + 1) + 1
    cells a side, 25 cells by default, whatever the uncertainty, and reaches less
    than a cell beyond the box - less than 1 / 2^(refine - 1) of the box's half
    width in the direction that set the level.  A box that reaches a pole goes
    round the globe and takes at most 2^(refine + 1) columns.  Locations beyond
    a pole or without coordinates have no cells."""
    la, lo = F.col(lat), F.col(lon)
    dlat = buffered_uncertainty(unc) / F.lit(METRES_PER_DEGREE)
    polar = F.abs(la) + dlat >= 90
    dlon = F.when(polar, F.lit(180.0)).otherwise(F.degrees(F.asin(F.sin(F.radians(dlat)) / F.cos(F.radians(la)))))
    sized = df.where((F.abs(la) <= 90) & lo.isNotNull()).select(*keep, la.alias("_la"), lo.alias("_lo"), dlat.alias("_dy"), dlon.alias("_dx"), polar.alias("_polar"))
    level = F.least(F.floor(F.log2(180 / F.col("_dy"))), F.floor(F.log2(360 / F.col("_dx")))) + refine
    leveled = sized.withColumn("_l", F.greatest(F.least(level, F.lit(finest)), F.lit(0)).cast("int"))
    n = _side(F.col("_l"))
    row = lambda v: F.greatest(F.least(F.floor((v + 90) / 180 * n), n - 1), F.lit(0)).cast("long")
    column = lambda v: F.floor((v + 180) / 360 * n).cast("long")
    first = F.when(F.col("_polar"), F.lit(0)).otherwise(column(F.col("_lo") - F.col("_dx")))
    last = F.when(F.col("_polar"), n - 1).otherwise(column(F.col("_lo") + F.col("_dx")))
    boxed = leveled.select(*keep, "_l", row(F.col("_la") - F.col("_dy")).alias("_y0"), row(F.col("_la") + F.col("_dy")).alias("_y1"),
                           first.alias("_x0"), F.least(last, first + n - 1).alias("_x1"))
    rows = boxed.select(*keep, "_l", "_x0", "_x1", F.explode(F.sequence("_y0", "_y1")).alias("_y"))
    cells = rows.select(*keep, "_l", "_y", F.explode(F.sequence("_x0", "_x1")).alias("_x"))
    cells = cells.withColumn("_x", F.pmod(F.col("_x"), _side(F.col("_l"))))
    # A step names its value twice, so each is a projection of its own.
    for shift, mask in SPREAD:
        cells = cells.select(*keep, "_l", *[_step(shift, mask)(F.col(c)).alias(c) for c in ("_x", "_y")])
    return cells.select(*keep, _join_bits(F.col("_x"), F.col("_y"), F.col("_l")).alias(out))


def _keyed(df: DataFrame, cell: str, keys: Sequence[tuple[int, bool]], own: Column) -> DataFrame:
    """``df`` once for each of its keys ``_k``: ``own`` and, for every (level,
    strict) of ``keys``, the cell of that level at (strict: only above) its own,
    negated where strict.  A key of null is left out."""
    level, c = F.col("_l"), F.col(cell)
    up = lambda to: F.call_function("shiftright", c, (2 * (level - to)).cast("int"))
    above = [F.when(level > to, -up(to)) if strict else F.when(level >= to, up(to)) for to, strict in keys]
    rows = df.withColumn("_l", level_of(cell)).withColumn("_k", F.explode(F.array(own.cast("long"), *above)))
    return rows.where("_k is not null").drop("_l")


def containing(left: DataFrame, right: DataFrame, left_levels: Sequence[int], right_levels: Sequence[int],
               left_cell: str = "cell", right_cell: str = "feature_cell") -> DataFrame:
    """Pairs of rows whose cells are equal or hold one another.

    The levels in use on each side are arguments (a table states its own; all 20
    may be given).  One equality join finds both kinds of pairs: a left row is
    looked up under its ancestors at the right's levels among the right's own
    cells, and, unless it is too small to hold any of them, under its own cell
    among the right's ancestors; keys of the second kind are negative.  So the
    left is computed and, where the right is too large to send to every task,
    moved once.  The keyed right is written first: Spark then knows its size,
    and AQE splits a hot cell of the left.
    Column names must differ between the sides."""
    columns = [*left.columns, *right.columns]
    own, finest = F.col(left_cell), max(right_levels, default=0)
    asked = _keyed(left, left_cell, [(to, False) for to in sorted(set(right_levels))], F.when(F.col("_l") < finest, -own))
    held = _keyed(right, right_cell, [(to, True) for to in sorted(set(left_levels))], F.col(right_cell))
    return asked.join(materialize(held, "held"), "_k").select(*columns)


def finest_feature(points: DataFrame, features: DataFrame, levels: Sequence[int], cell: str = "cell",
                   feature_cell: str = "feature_cell") -> DataFrame:
    """Every point row once, with the columns of the smallest feature cell that
    holds its ``cell`` (null where none does).

    A point's cells at the ``levels`` of ``features`` (a handful) are looked up
    side by side, one equality join a level on that level's feature cells, so no
    row is multiplied and nothing is ranked.  ``features`` has one row a cell."""
    found, columns = points, [c for c in features.columns if c != feature_cell]
    for level in sorted(set(levels)):
        one = features.where(level_of(feature_cell) == level).select(
            F.col(feature_cell).alias("_k"), F.struct(F.col(feature_cell), *columns).alias(f"_f{level}"))
        found = found.withColumn("_k", ancestor(cell, F.lit(level))).join(own_shuffle(one), "_k", "left").drop("_k")
    best = F.coalesce(*[F.col(f"_f{level}") for level in sorted(set(levels), reverse=True)])
    return found.withColumn("_best", best).select(*points.columns, "_best.*")
