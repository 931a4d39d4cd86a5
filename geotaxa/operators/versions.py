"""Version selection: keep the latest version of each record.

``row_number() = 1`` over the identity lets Catalyst insert a partial
``WindowGroupLimit`` before the shuffle, so each map task already keeps only
one row per identity: a record with very many versions is reduced where it is
read and never piles up in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDENTITY = ("id", "source")


def version_order(tie_break: Sequence[str] = ()) -> list[Column]:
    """Newest first; equal times are settled by the ``tie_break`` columns,
    largest first."""
    return [F.col("updated_at").desc(), *[F.col(c).desc() for c in tie_break]]


_ORDERABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
              T.BooleanType, T.BinaryType)


def _with_tie_breaks(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> list[Column]:
    """``order`` followed by every other atomic column, ascending: when the
    declared order ties, the pick still depends only on the rows' values, so
    a recomputed partition (lost executor) picks the same row."""
    extra = [F.col(f.name).asc() for f in df.schema.fields
             if f.name not in keys and isinstance(f.dataType, _ORDERABLE)]
    return [*order, *extra]


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    rank_col: str = "_r", break_ties: bool = False) -> DataFrame:
    """One row per ``keys``: the first by ``order``.  NULL keys form one
    group, as in GROUP BY.  With ``break_ties`` the remaining columns settle
    ties (use it when ``order`` may not be unique; it keeps every column in
    the shuffle, so unique orders should not ask for it)."""
    full = _with_tie_breaks(df, keys, order) if break_ties else list(order)
    w = Window.partitionBy(*keys).orderBy(*full)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def latest_version(df: DataFrame, keys: Sequence[str] = IDENTITY, tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest version per identity.

    ``tie_break`` names the columns that settle versions of one time; they
    must be in ``df``, so every projection of a table that carries them picks
    the same version.  Without any, all other columns settle a tie: the pick
    then depends on the rows' values alone, but on all of them, so such a
    table must be reduced before it is projected."""
    missing = [c for c in tie_break if c not in df.columns]
    if missing:
        raise ValueError(f"tie-break columns {missing} are not in the table")
    return first_per_group(df, keys, version_order(tie_break), break_ties=not tie_break)


def latest_by_source_id(df: DataFrame, source_id: str = "source_id", tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest version when identity is a single ``source_id`` column; versions
    of one time are settled by ``tie_break``, then by the smallest id."""
    return first_per_group(df, [source_id], [*version_order(tie_break), F.col("id").asc()], break_ties=not tie_break)
