"""Clustered record layout, and pulls that read only what is due.

``write_clustered`` stores records in folders by source and period (the month
of the update), the files of a folder sorted by (family, updated_at).  A pull
over that layout (``pruned_pull``) is the plain pull with three more chances to
skip data, none of which changes its result:

* folders of sources that no history row names: the planner turns the join
  with the marks into a dynamic partition filter, evaluated when the query runs;
* folders of periods before the earliest mark of their source (and after
  ``modified_before``): a subquery over the history gives one mark a source, as
  a map no larger than the list of source folders, so a source that lags does
  not widen what is read of the others;
* row groups: the same mark on ``updated_at`` and the smallest and largest due
  family reach the Parquet reader, whose statistics are narrow as files are
  sorted.

Records are range-partitioned by (source, period, family, updated_at) before
they are written, so a source with a third of all records is many files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotaxa.functions.geo import timestamp_literal
from geotaxa.sources.sync import incremental_pull, reduce_history

PERIOD = "period"
# Fixed value: a mark at this time switches a (source, family) off.
NEVER = "9999-12-31 00:00:00"


def period_of(updated: str | Column = "updated_at") -> Column:
    """First day of the month of an update; the same for every session zone
    where times are wall-clock (``TIMESTAMP_NTZ``)."""
    return F.trunc((F.col(updated) if isinstance(updated, str) else updated).cast("date"), "month")


def write_clustered(records: DataFrame, path: str, mode: str = "append", files: int | None = None) -> None:
    """Write (or append) ``records`` in the clustered layout.  ``files`` is the
    number of range partitions (default: the session's shuffle partitions); a
    folder gets one file per range that reaches into it.  A record without an
    ``updated_at`` has no period and no pull returns it; a blank source is
    stored as a missing one."""
    order = ["source", PERIOD, "family", "updated_at"]
    placed = records.withColumn(PERIOD, period_of())
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode(mode).partitionBy("source", PERIOD).parquet(path)


def read_clustered(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table, with ``source`` as text and ``period`` as a date whatever
    their values look like in folder names."""
    if schema is None:
        schema = spark.read.parquet(path).schema
    own = {"source": T.StringType(), PERIOD: T.DateType()}
    fields = [f for f in schema.fields if f.name not in own]
    fields += [T.StructField(name, kind) for name, kind in own.items()]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def pruned_pull(records: DataFrame, history: DataFrame, modified_before=None,
                restrict_sources: Sequence[str] | None = None, restrict_families: Sequence[str] | None = None,
                **options) -> DataFrame:
    """``incremental_pull`` over ``read_clustered``; further ``options`` are
    those of ``incremental_pull``.

    ``history`` should be a stored table: the planner then knows its size and
    broadcasts it where it is small, which is what lets the marks prune
    folders; a history too large for that is joined without this filter."""
    kind = records.schema["updated_at"].dataType
    due = history.where(F.col("fetched_at").cast(kind) < timestamp_literal(NEVER, kind))
    marks = reduce_history(due, restrict_sources, restrict_families)
    of_source = marks.where("source is not null").groupBy("source").agg(period_of(F.min(F.col("fetched_at").cast(kind))).alias("first"))
    first = of_source.agg(F.map_from_entries(F.collect_list(F.struct("source", "first")))).scalar()
    r = records.where(F.col(PERIOD) >= F.try_element_at(first, F.col("source")))
    r = r.where(F.col("family") >= marks.agg(F.min("family")).scalar()).where(F.col("family") <= marks.agg(F.max("family")).scalar())
    if modified_before is not None:
        r = r.where(F.col(PERIOD) <= period_of(timestamp_literal(modified_before, kind)))
    return incremental_pull(r, due, modified_before=modified_before, restrict_sources=restrict_sources,
                            restrict_families=restrict_families, **options).drop(PERIOD)
