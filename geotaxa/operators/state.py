"""The latest version of every record as a table that batches are merged into.

``latest_version`` recomputes everything; ``LatestState`` keeps its result in
buckets of the identity and merges a pull's batch into it:

1. the batch is reduced to its own latest versions, written once;
2. its bucket numbers (at most ``buckets`` of them) select the part of the
   state that is read;
3. state and batch meet in a full outer join on the identity.  The state is
   read in its buckets, so only the batch is shuffled;
4. the winners are written as a new *generation* of those buckets, and one
   manifest line names it.  A bucket's content is that of its newest generation:
   buckets that the batch does not touch are neither read nor written.

Nothing is overwritten.  A merge that dies leaves files nobody names, and a
batch whose id is committed is not merged again.  Batches may come in any order
(a merge is idempotent besides).  Where more than ``generations`` generations
hold buckets, a merge also rewrites those of the smallest one, so a read joins a
bounded number of tables.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotaxa.operators.versions import IDENTITY, latest_version
from geotaxa.session import materialize
from geotaxa.sinks.commits import lines_of, write_line

BUCKET = "_bucket"
GENERATION = T.StructType([T.StructField("batch", T.StringType()), T.StructField("number", T.LongType()),
                           T.StructField("attempt", T.StringType()), T.StructField("buckets", T.ArrayType(T.IntegerType()))])


class LatestState:
    """The state below ``path`` (a shared folder).

    ``schema``       columns of the records, identity and version columns included
    ``tie_break``    columns that settle versions of one time (largest first); they
                     must tell apart any two versions of one record
    ``buckets``      fixed for the life of the state; choose it so that a bucket
                     is a task's worth of records

    Identity columns must not be null: a null id or source is refused.  One
    merge runs at a time; of two at once, one fails and is repeated."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, tie_break: Sequence[str],
                 keys: Sequence[str] = IDENTITY, buckets: int = 64, generations: int = 8):
        if not tie_break:
            raise ValueError("a state needs tie_break columns: a merge compares two versions at a time")
        self.spark, self.path, self.schema, self.buckets, self.generations = spark, path, schema, buckets, generations
        self.keys, self.tie_break, self.columns = list(keys), list(tie_break), schema.names

    def live(self) -> dict[str, list[int]]:
        """Generation -> buckets whose newest content it holds.  One manifest
        line a batch reaches the driver."""
        owner: dict[int, str] = {}
        for line in lines_of(self.spark, self.path, GENERATION).orderBy("number").collect():
            owner |= dict.fromkeys(line["buckets"], line["attempt"])
        out: dict[str, list[int]] = {}
        for bucket, attempt in sorted(owner.items()):
            out.setdefault(attempt, []).append(bucket)
        return out

    def _table(self, attempt: str) -> str:
        """The generation as a bucketed table (a name in this session's catalog only)."""
        name = "state_" + hashlib.sha256(f"{self.path} {attempt}".encode()).hexdigest()[:24]
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        clustered = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(f"create table if not exists {name} ({declared}, {BUCKET} int) using parquet partitioned by ({BUCKET}) "
                       f"clustered by ({clustered}) into {self.buckets} buckets location '{self.path}/data/{attempt}'")
        return name

    def _bucket(self) -> Column:
        """The number Spark gives a bucket of these columns."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")

    def _part(self, attempt: str, buckets: Sequence[int]) -> DataFrame:
        return self.spark.table(self._table(attempt)).where(F.col(BUCKET).isin(list(buckets))).select(*self.columns)

    def read(self) -> DataFrame:
        """The latest version of every record merged so far."""
        parts = [self._part(a, b) for a, b in self.live().items()]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def newest(self, batch: DataFrame) -> DataFrame:
        """The batch's own latest versions with their buckets."""
        checked = [F.coalesce(F.col(f.name), F.raise_error(F.lit(f"null {f.name} in a state batch")).cast(f.dataType)).alias(f.name)
                   if f.name in self.keys else F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return latest_version(batch.select(*checked), self.keys, self.tie_break).withColumn(BUCKET, self._bucket())

    def winners(self, attempt: str, new: DataFrame, buckets: Sequence[int]) -> DataFrame:
        """Newest versions in ``buckets``, of a generation and of the batch."""
        new = new.where(F.col(BUCKET).isin(list(buckets))).select([F.col(c).alias(f"_n_{c}") for c in self.columns])
        old = self._part(attempt, buckets)
        both = old.join(new, [F.col(k) == F.col(f"_n_{k}") for k in self.keys], "full")
        # Later by (updated_at, tie breaks); a null is before everything, as in DESC.
        newer, even = F.lit(False), F.lit(True)
        for c in ["updated_at", *self.tie_break]:
            a, b = F.col(c), F.col(f"_n_{c}")
            newer = newer | (even & F.coalesce(b > a, b.isNotNull() & a.isNull()))
            even = even & a.eqNullSafe(b)
        key = self.keys[0]
        take = F.col(key).isNull() | (F.col(f"_n_{key}").isNotNull() & newer)
        return both.select([F.when(take, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in self.columns])

    def merge(self, batch: DataFrame, batch_id: str) -> list[int]:
        """Merge ``batch``; the buckets that were rewritten (none if it is
        committed already)."""
        lines = lines_of(self.spark, self.path, GENERATION)
        if lines.where(F.col("batch") == batch_id).head(1):
            return []
        number = lines.count()
        new = materialize(self.newest(batch), "batch")
        touched = {r[BUCKET] for r in new.select(BUCKET).distinct().collect()}    # at most ``buckets`` numbers
        live = self.live()
        kept = {a: set(b) - touched for a, b in live.items() if set(b) - touched}
        if touched and len(kept) >= self.generations:
            touched |= min(kept.values(), key=len)
        attempt, rest, parts = uuid.uuid4().hex, set(touched), []
        for old, held in live.items():
            here = sorted(touched & set(held))
            rest -= set(held)
            if here:
                parts.append(self.winners(old, new, here))
        if rest:  # buckets that nothing holds yet: a shuffle of the batch alone
            first = new.where(F.col(BUCKET).isin(sorted(rest))).select(*self.columns)
            parts.append(first.repartition(self.buckets, *self.keys))
        if parts:
            rows = reduce(DataFrame.unionByName, parts).withColumn(BUCKET, self._bucket())
            rows.write.insertInto(self._table(attempt))
        write_line(self.spark, self.path, batch_id, (batch_id, number, attempt, sorted(touched)), GENERATION)
        return sorted(touched)
