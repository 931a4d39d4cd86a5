"""Provider pulls as a Spark data source.

``pull_source(Client)`` makes a data source class for
``spark.dataSource.register``; ``read_due`` reads it.  Every due (source, family)
is one input partition, in which one client is made and asked for the records
updated after that pair's mark; Spark schedules, retries and counts partitions
like those of any table.

A client is a class of the user's::

    class Client:
        def __init__(self, options: dict): ...
        def fetch(self, source, family, updated_after, updated_before,
                  observed_after, observed_before):     # bounds: datetime or None
            yield record_batch      # pyarrow, with the columns of the schema

It may return more than it was asked for: records up to the mark or beyond the
bounds are dropped here.  A partition that is retried asks again, so a client
must not mark anything as fetched; marks move when the job that wrote the
records is done (``geotaxa.sources.sync.next_marks``).

Filters on source, family, ``updated_at`` and ``observed_at`` prune partitions
and become bounds of the client's where the session allows Python data sources
to take filters (``spark.sql.python.filterPushdown.enabled``); ``read_due`` looks
at that setting and changes nothing but the work."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from geotaxa.sources.sync import reduce_history

NAME = "occurrence_pull"
# History rows that are sent to the planner; more is refused, not cut.
MAX_PULLS = 100_000
# What ``ParquetClient`` holds of a file: rows decoded at once, bytes read of a column.
BATCH_ROWS, BUFFER_BYTES = 1 << 16, 1 << 20


@dataclass
class Pull(InputPartition):
    source: str
    family: str
    mark: dt.datetime


class PullReader(DataSourceReader):
    def __init__(self, client: type, options: dict, schema: T.StructType):
        self.client, self.options, self.schema = client, options, schema
        self.only: dict[str, set] = {}
        self.bounds: dict[str, dt.datetime | None] = dict.fromkeys(
            ("updated_after", "updated_before", "observed_after", "observed_before"))
        for name in self.bounds:
            if options.get(name):
                self.bounds[name] = dt.datetime.fromisoformat(options[name])

    def partitions(self) -> list[Pull]:
        due = [Pull(s, f, dt.datetime.fromisoformat(m)) for s, f, m in json.loads(self.options["due"])]
        return [p for p in due if all(getattr(p, c) in values for c, values in self.only.items())
                and (self.bounds["updated_before"] is None or p.mark < self.bounds["updated_before"])]

    def read(self, partition: Pull | None) -> Iterator[pa.RecordBatch]:
        if partition is None:        # Spark's one partition where nothing is due
            return
        names = self.schema.names
        after = max(filter(None, (partition.mark, self.bounds["updated_after"])))
        client = self.client(dict(self.options))
        for batch in client.fetch(partition.source, partition.family, after, self.bounds["updated_before"],
                                  self.bounds["observed_after"], self.bounds["observed_before"]):
            keep = pc.and_(pc.equal(batch["source"], partition.source), pc.equal(batch["family"], partition.family))
            keep = pc.and_(keep, pc.greater(batch["updated_at"], pa.scalar(partition.mark, batch["updated_at"].type)))
            found = pa.Table.from_batches([batch]).filter(keep).select(names)
            yield from found.combine_chunks().to_batches()


class PushingReader(PullReader):
    """Takes filters: they prune pulls and bound the client's answers.  Spark
    evaluates them again, so a bound may be wider than the filter."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("source", "family") and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only[column] = self.only.get(column, values) & values
            elif column in ("updated_at", "observed_at") and isinstance(getattr(f, "value", None), dt.datetime):
                kind = column.split("_")[0]
                if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    # The client's lower bound is exclusive.
                    low = f.value if isinstance(f, GreaterThan) else f.value - dt.timedelta(microseconds=1)
                    self.bounds[f"{kind}_after"] = max(filter(None, (self.bounds[f"{kind}_after"], low)))
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    high = f.value if isinstance(f, LessThan) else f.value + dt.timedelta(microseconds=1)
                    self.bounds[f"{kind}_before"] = min(filter(None, (self.bounds[f"{kind}_before"], high)))
            yield f


def pull_source(client: type, format_name: str = NAME) -> type[DataSource]:
    """A data source class whose partitions use ``client``."""

    class PullSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self) -> str:
            raise ValueError("give the records' schema: spark.read.schema(...)")

        def reader(self, schema: T.StructType) -> DataSourceReader:
            kind = PushingReader if self.options.get("pushdown") == "true" else PullReader
            return kind(client, dict(self.options), schema)

    return PullSource


def read_due(spark: SparkSession, history: DataFrame, schema: T.StructType, restrict_sources: Sequence[str] | None = None,
             restrict_families: Sequence[str] | None = None, format_name: str = NAME, **options) -> DataFrame:
    """The records of all due pulls.  One mark a (source, family) reaches the
    driver (at most ``MAX_PULLS``); rows of the history without one are skipped."""
    marks = reduce_history(history, restrict_sources, restrict_families).where("source is not null and family is not null and fetched_at is not null")
    due = marks.orderBy("source", "family").limit(MAX_PULLS + 1).collect()
    if len(due) > MAX_PULLS:
        raise ValueError(f"more than {MAX_PULLS} pulls are due: restrict sources or families")
    lines = json.dumps([(r["source"], r["family"], r["fetched_at"].isoformat()) for r in due])
    takes = str(spark.conf.get("spark.sql.python.filterPushdown.enabled")).lower()
    return spark.read.format(format_name).schema(schema).options(due=lines, pushdown=takes, **options).load()


class ParquetClient:
    """A client over a Parquet folder that all executors can open (``path``)."""

    def __init__(self, options: dict):
        import pyarrow.dataset as ds

        self.table = ds.dataset(options["path"].removeprefix("file://"), format="parquet")

    def fetch(self, source, family, updated_after, updated_before, observed_after, observed_before):
        import pyarrow.dataset as ds

        schema = self.table.schema
        limits = [("source", pc.equal, source), ("family", pc.equal, family)]
        for column, low, high in (("updated_at", updated_after, updated_before), ("observed_at", observed_after, observed_before)):
            limits += [(column, op, pa.scalar(at, schema.field(column).type)) for op, at in ((pc.greater, low), (pc.less, high)) if at is not None]
        wanted = reduce(and_, [op(ds.field(column), at) for column, op, at in limits])
        for fragment in self.table.get_fragments(filter=wanted):
            groups = [g.id for g in fragment.subset(filter=wanted, schema=schema).row_groups]
            for batch in self._stream(fragment, groups):
                yield batch.filter(reduce(pc.and_, [op(batch.column(column), at) for column, op, at in limits]))

    def _stream(self, fragment, groups: list[int]) -> Iterator[pa.RecordBatch]:
        """The rows of some row groups of one file, decoded a few pages at a time:
        a scan of the folder would hold whole row groups and read ahead."""
        import pyarrow.parquet as pq

        schema = self.table.schema
        with fragment.open() as file:
            parts = pq.ParquetFile(file, buffer_size=BUFFER_BYTES, pre_buffer=False)
            for batch in parts.iter_batches(BATCH_ROWS, row_groups=groups, use_threads=False):
                own = dict(zip(batch.schema.names, batch.columns))
                columns = [own[f.name].cast(f.type) if f.name in own else pa.nulls(len(batch), f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
