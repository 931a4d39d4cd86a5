"""Taxa filters and name statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from geotaxa.functions.joins import own_shuffle
from geotaxa.functions.words import is_multiword

# Fixed value: minimum number of occurrences for a taxon.
DEFAULT_THRESHOLD = 200


def name_distribution(df: DataFrame, name_col: str = "name", out: str = "c") -> DataFrame:
    """(name, count); NULL names are one group.  Partial + final aggregate."""
    return df.groupBy(name_col).agg(F.count(F.lit(1)).alias(out))


def valid_names(df: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                name_col: str = "name", out: str = "c") -> DataFrame:
    """Names with **at least** ``threshold`` rows (inclusive; no word test;
    NULL is a group)."""
    return name_distribution(df, name_col, out).where(F.col(out) >= threshold)


def taxa_threshold(df: DataFrame, threshold: int = DEFAULT_THRESHOLD,
                   name_col: str = "name", require_multiword: bool = True,
                   taxa_observation: Observation | None = None) -> DataFrame:
    """Keep every row of a name with **more than** ``threshold`` rows and more
    than one word.

    Counted with a partially aggregated GROUP BY and applied with a LEFT SEMI
    join, so no group is ever gathered: a popular name costs one partial count
    per map task.  The surviving names are shuffled by themselves, never
    repeated, so both join inputs are plain shuffle reads and AQE splits the
    rows of a popular name (or broadcasts the names where it measures them
    small).  The word test runs first, on both sides.  NULL names are dropped.
    ``taxa_observation`` (optional) counts the surviving names as ``valid_taxa``
    in the same pass."""
    cand = df.where(is_multiword(name_col)) if require_multiword else df.where(F.col(name_col).isNotNull())
    keep = (cand.groupBy(name_col).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > threshold).select(name_col))
    if taxa_observation is not None:
        keep = keep.observe(taxa_observation, F.count(F.lit(1)).alias("valid_taxa"))
    return cand.join(own_shuffle(keep), on=[name_col], how="left_semi").select(*cand.columns)


def top_names(df: DataFrame, n: int = 1000, name_col: str = "name", out: str = "c") -> DataFrame:
    """The ``n`` most frequent non-null names (ties by name): a top-k report,
    planned as ``TakeOrderedAndProject`` over the partial counts."""
    return (df.where(F.col(name_col).isNotNull())
              .groupBy(name_col).agg(F.count(F.lit(1)).alias(out))
              .orderBy(F.col(out).desc(), F.col(name_col).asc())
              .limit(n))
