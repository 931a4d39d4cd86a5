"""Job counters.

The source system printed named counters at the end of a job.  ``job_counters``
is that report as a table, from the frames the job works on; during a job the
same numbers are observed while its own passes run (``observe_counters``:
Spark's ``Observation``), with stage-qualified names so counters of different
steps do not overwrite each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def job_counters(frames: Mapping[str, DataFrame] | Sequence[tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """(counter, value) of several frames, each with its own named aggregates
    (``count_where``, ``F.count``, ``F.count_distinct``): all counters of one
    frame come from one pass over it; nothing is gathered.  A mapping of names to
    frames counts the rows of each, 0 for an empty one."""
    if isinstance(frames, Mapping):
        frames = [(df, {name: F.count(F.lit(1))}) for name, df in frames.items()]
    out = None
    for df, counters in frames:
        one = df.agg(*[value.cast("long").alias(f"_{i}") for i, value in enumerate(counters.values())])
        pairs = [F.struct(F.lit(name).alias("counter"), F.col(f"_{i}").alias("value")) for i, name in enumerate(counters)]
        one = one.select(F.explode(F.array(*pairs)).alias("_c")).select("_c.*")
        out = one if out is None else out.unionAll(one)
    return out


def count_where(condition: Column) -> Column:
    """Rows that meet ``condition``; 0 on empty input."""
    return F.count(F.when(condition, 1))


def observe_counters(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter named ``<stage>.rows`` to ``df``; read it from the
    returned ``Observation`` after an action on the returned frame."""
    obs = Observation(stage)
    return df.observe(obs, F.count(F.lit(1)).alias(f"{stage}.rows")), obs
