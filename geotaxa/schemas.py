"""Declared record schemas and schema triples.

A table schema can be given as ``(name, type, mode)`` triples in BigQuery's
vocabulary; ``schema_from_fields`` turns them into a Spark ``StructType``.
Times are wall-clock UTC (``TIMESTAMP_NTZ``) so no session zone ever shifts
them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# BigQuery type name -> Spark type (public BigQuery docs).
BIGQUERY_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DATETIME": T.TimestampNTZType(),
    "NUMERIC": T.DecimalType(38, 9),
}
# Modes.
REQUIRED, NULLABLE, REPEATED = "REQUIRED", "NULLABLE", "REPEATED"

# The occurrence record as (name, type, mode).
OCCURRENCE_FIELDS: list[tuple[str, str, str]] = [
    ("id", "INTEGER", REQUIRED),
    ("source", "STRING", REQUIRED),
    ("family", "STRING", NULLABLE),
    ("name", "STRING", NULLABLE),
    ("latitude", "FLOAT", REQUIRED),
    ("longitude", "FLOAT", REQUIRED),
    ("coordinate_uncertainty", "FLOAT", NULLABLE),
    ("date", "DATE", REQUIRED),
    ("observed_at", "TIMESTAMP", NULLABLE),
    ("updated_at", "TIMESTAMP", REQUIRED),
    ("cell_id", "INTEGER", NULLABLE),
]


def spark_type(bq_type: str, mode: str = NULLABLE) -> T.DataType:
    t = BIGQUERY_TYPES[bq_type.upper()]
    return T.ArrayType(t, containsNull=True) if mode.upper() == REPEATED else t


def schema_from_fields(fields: Sequence[tuple[str, str, str]]) -> T.StructType:
    """``(name, type, mode)`` triples -> ``StructType`` (flat)."""
    return T.StructType([
        T.StructField(name, spark_type(t, mode), nullable=(mode.upper() != REQUIRED))
        for name, t, mode in fields
    ])


OCCURRENCE_SCHEMA = schema_from_fields(OCCURRENCE_FIELDS)


def decode_rows(df: DataFrame, schema: T.StructType = OCCURRENCE_SCHEMA) -> DataFrame:
    """Decode table rows into occurrence records: the declared columns, in
    declared order, cast to the declared types (a plain projection, so it
    stays in codegen and prunes the scan); a declared column the table lacks
    is NULL."""
    present = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])
