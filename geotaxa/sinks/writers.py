"""Writers.

* ``enforce_schema``  cast to a declared schema, fail on NULL in a REQUIRED
                      column (instead of writing a bad row);
* ``occurrence_rows`` records in output form: only records that can be
                      formatted (a resolved name) -- the same validity rule
                      for every sink;
* ``write_json_lines``  JSON lines files (``part-*.json``) under a prefix;
* ``append_table``    Parquet append (create if missing)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotaxa.functions.json import reject_non_finite
from geotaxa.schemas import OCCURRENCE_FIELDS, schema_from_fields
from geotaxa.sinks.commits import append_batch


def enforce_schema(df: DataFrame, fields: Sequence[tuple[str, str, str]] | T.StructType) -> DataFrame:
    """Project ``df`` onto a declared schema: declared columns and order,
    cast to declared types; a NULL in a REQUIRED (non-nullable) column raises
    an error naming the column.  A NULLABLE column the frame lacks is NULL; a
    missing REQUIRED column is refused before anything runs."""
    schema = fields if isinstance(fields, T.StructType) else schema_from_fields(fields)
    present = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in present and not f.nullable]
    if missing:
        raise ValueError(f"missing REQUIRED column(s): {', '.join(missing)}")
    cols = []
    for f in schema.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"NULL in REQUIRED column {f.name}")).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def occurrence_rows(df: DataFrame, name_col: str = "scientific_name",
                    fields: Sequence[tuple[str, str, str]] | None = None) -> DataFrame:
    """Occurrences in output form: rows with a resolved name only, projected
    to the declared occurrence schema (``name`` carries the resolved name)."""
    fields = list(fields) if fields is not None else OCCURRENCE_FIELDS
    valid = df.where(F.col(name_col).isNotNull())
    if name_col != "name":
        valid = valid.drop("name").withColumnRenamed(name_col, "name")
    return enforce_schema(valid, fields)


def write_json_lines(df: DataFrame, path: str, mode: str = "append",
                     compression: str | None = None) -> None:
    """Write one JSON object per line.  NULL fields are kept; NaN / Infinity
    fail the job (not JSON).  Files are ``part-*.json`` under ``path``."""
    writer = reject_non_finite(df).write.mode(mode).option("ignoreNullFields", "false")
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Append to a Parquet table, creating it if needed."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_occurrences(df: DataFrame, path: str, name_col: str = "scientific_name",
                       fields: Sequence[tuple[str, str, str]] | None = None,
                       partition_by: Sequence[str] = ("source",), batch: str | None = None) -> None:
    """Append normalized occurrences to the record table: only rows that can
    be formatted (same rule as the JSON sink), in the declared schema, and
    partitioned by source so pulls restricted to some sources read only
    their folders.  With ``batch`` the table is a committed one
    (``geotaxa.sinks.commits``): the rows show whole or not at all, and a batch
    that is there already is not appended again."""
    rows = occurrence_rows(df, name_col, fields)
    if batch is not None:
        append_batch(rows, path, batch, partition_by)
        return
    append_table(rows, path, partition_by=list(partition_by))
