"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_condition(left: DataFrame, right: DataFrame, cols: Sequence[str],
                        right_cols: Sequence[str] | None = None) -> Column:
    """``l.c1 <=> r.c1 AND ...``: join keys where NULL matches NULL (the way
    a GROUP BY treats them)."""
    rcols = list(right_cols) if right_cols is not None else list(cols)
    cond = None
    for lc, rc in zip(cols, rcols):
        part = left[lc].eqNullSafe(right[rc])
        cond = part if cond is None else (cond & part)
    return cond


def own_shuffle(df: DataFrame) -> DataFrame:
    """``df`` (one row per key) under a shuffle that the next join cannot use.

    An aggregate keeps the partitioning of its keys, so a join on them would
    read it in place, and AQE splits a hot partition only where both sides of
    a join are plain shuffle reads.  Moving the key table once more, which is
    small beside the rows it is joined with, makes the join shuffle both."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
