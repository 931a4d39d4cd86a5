"""Appends that show whole or not at all.

A committed table is a folder with two parts::

    <table>/data/attempt=<unique>/...     staged files of one run
    <table>/_commits/<batch>/part-*.json  the batch's manifest, one line

``append_batch`` stages the rows in an attempt folder of its own and then
writes the manifest that names it.  The manifest is one file that Spark's job
commit moves into place, so a batch is either named or not.  ``read_committed``
reads the attempts that manifests name and nothing else:

* a run that dies while staging leaves an attempt nobody names;
* a run that is repeated finds its batch's manifest and appends nothing;
* two runs of one batch at a time: the second manifest is refused, because its
  folder exists, and its attempt stays unnamed.

Executors that are lost while staging or committing cost retried tasks only.
``unnamed_attempts`` lists what may be deleted once no run is under way.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTEMPT = "attempt"
MANIFEST = T.StructType([T.StructField("batch", T.StringType()), T.StructField(ATTEMPT, T.StringType()),
                         T.StructField("rows", T.LongType()), T.StructField("schema", T.StringType())])


def _name(batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):
        raise ValueError(f"batch id {batch!r}: letters, digits, '.', '_' and '-' only")
    return batch


def lines_of(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The manifest lines below ``table``, one a committed batch."""
    try:
        return spark.read.schema(schema).json(f"{table}/_commits/*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":     # no batch yet
            return spark.createDataFrame([], schema)
        raise


def write_line(spark: SparkSession, table: str, batch: str, line: tuple, schema: T.StructType) -> None:
    """Commit ``batch``: one line, in a file that appears whole; fails if the
    batch has one."""
    spark.createDataFrame([line], schema).coalesce(1).write.mode("errorifexists").json(f"{table}/_commits/{_name(batch)}")


def manifests(spark: SparkSession, table: str) -> DataFrame:
    """(batch, attempt, rows, schema) of every committed batch."""
    return lines_of(spark, table, MANIFEST)


def is_committed(spark: SparkSession, table: str, batch: str) -> bool:
    return bool(manifests(spark, table).where(F.col("batch") == _name(batch)).head(1))


def stage(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """Write ``df`` into a new attempt folder; (attempt, rows)."""
    attempt, seen = uuid.uuid4().hex, Observation("staged")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{table}/data/{ATTEMPT}={attempt}")
    return attempt, seen.get["rows"]


def commit(spark: SparkSession, table: str, batch: str, attempt: str, rows: int, schema: T.StructType) -> None:
    """Name ``attempt`` as the content of ``batch``; fails if the batch has one."""
    write_line(spark, table, batch, (batch, attempt, rows, schema.json()), MANIFEST)


def append_batch(df: DataFrame, table: str, batch: str, partition_by: Sequence[str] = ()) -> bool:
    """Append ``df`` as ``batch``; False if that batch is there already."""
    spark = df.sparkSession
    if is_committed(spark, table, batch):
        return False
    attempt, rows = stage(df, table, partition_by)
    commit(spark, table, batch, attempt, rows, df.schema)
    return True


def read_committed(spark: SparkSession, table: str, schema: T.StructType | None = None,
                   batches: Sequence[str] | None = None) -> DataFrame:
    """The rows of all committed batches (or of ``batches``).

    One manifest line a batch reaches the driver, never a row of the table.
    Columns are those of ``schema``, or of the last batch's manifest where none
    is given; a column that a batch lacks is null."""
    named = manifests(spark, table)
    if batches is not None:
        named = named.where(F.col("batch").isin(list(batches)))
    lines = named.orderBy("batch").collect()
    if schema is None:
        if not lines:
            raise ValueError(f"{table} has no committed batch: give its schema")
        schema = T.StructType.fromJson(json.loads(lines[-1]["schema"]))
    paths = [f"{table}/data/{ATTEMPT}={line[ATTEMPT]}" for line in lines if line["rows"]]
    if not paths:
        return spark.createDataFrame([], schema)
    # Reading nullable: Parquet files do not keep REQUIRED.
    full = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
    return spark.read.schema(full).option("basePath", f"{table}/data").parquet(*paths).select(*schema.names)


def unnamed_attempts(spark: SparkSession, table: str) -> DataFrame:
    """Attempt folders that no manifest names (from dead or repeated runs)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{table}/data").select("path")
    found = files.select(F.regexp_extract("path", f"/{ATTEMPT}=([0-9a-f]+)/", 1).alias(ATTEMPT)).distinct()
    return found.join(manifests(spark, table).select(ATTEMPT), ATTEMPT, "left_anti")
