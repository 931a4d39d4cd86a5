"""Frequent names without a rescan: one mergeable sketch a batch.

A sketch holds at most ``max_items`` names with their counts; merged sketches
are a sketch of all their batches.  With N rows in total, a count is off by at
most ``error_bound(max_items, N)``; up to ``max_items`` distinct names all counts
are exact.  Names more frequent than the bound are never lost, so a report needs
the stored sketches and no records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: share of the counters by which a full sketch may be wrong (3.5 / max_items).
ERROR_FACTOR = 3.5


def error_bound(max_items: int, rows: int) -> int:
    """Largest error of any count over ``rows`` rows."""
    return int(ERROR_FACTOR * rows / max_items) + 1


def name_sketch(df: DataFrame, batch: str, name_col: str = "name", max_items: int = 4096) -> DataFrame:
    """One row: batch, rows (with a name) and their sketch.  Map tasks make
    partial sketches, so a popular name costs one counter a task."""
    named = df.where(F.col(name_col).isNotNull())
    return named.agg(F.lit(batch).alias("batch"), F.count(F.lit(1)).alias("rows"),
                     F.expr(f"approx_top_k_accumulate(`{name_col}`, {max_items})").alias("sketch"))


def merge_sketches(sketches: DataFrame, batch: str = "all", max_items: int = 4096) -> DataFrame:
    """One sketch of all rows of ``sketches`` (batch, rows, sketch)."""
    return sketches.where("rows > 0").agg(F.lit(batch).alias("batch"), F.sum("rows").alias("rows"),
                                          F.expr(f"approx_top_k_combine(sketch, {max_items})").alias("sketch"))


def frequent_names(sketch: DataFrame, n: int, out: str = "c", name_col: str = "name", max_items: int = 4096) -> DataFrame:
    """The ``n`` most frequent names of one sketch with their counts (ties by
    name): a top-k report."""
    found = sketch.where("rows > 0").select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {max_items})")).alias("_t"))
    return found.select(F.col("_t.item").alias(name_col), F.col("_t.count").alias(out)).orderBy(F.col(out).desc(), name_col).limit(n)
