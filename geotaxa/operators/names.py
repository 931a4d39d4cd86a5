"""Name normalization: one lookup per distinct given name, put back on rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.functions.joins import own_shuffle


def unique_lookup(names: DataFrame, given_col: str = "given_name",
                  out_col: str = "scientific_name") -> DataFrame:
    """One scientific name per given name (the largest, if a lookup has
    several), so the join cannot multiply rows."""
    return names.groupBy(given_col).agg(F.max(out_col).alias(out_col))


def normalize_names(df: DataFrame, names: DataFrame, name_col: str = "name",
                    given_col: str = "given_name", out_col: str = "scientific_name",
                    drop_unresolved: bool = False) -> DataFrame:
    """Attach ``out_col`` to every row by a LEFT join on the name.

    The lookup (one row per distinct name) is shuffled by itself, never
    repeated: AQE then splits the rows of a popular name, or broadcasts the
    lookup where it measures it small.  Unresolved names get NULL, or are
    dropped with ``drop_unresolved``."""
    if out_col in df.columns:          # re-normalizing: the lookup's answer replaces it
        df = df.drop(out_col)
    lookup = unique_lookup(names, given_col, out_col).withColumnRenamed(given_col, name_col)
    how = "inner" if drop_unresolved else "left"
    return df.join(own_shuffle(lookup), on=[name_col], how=how).select(*df.columns, out_col)
