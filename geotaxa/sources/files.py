"""File sources: JSON lines written by the JSON sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from geotaxa.schemas import OCCURRENCE_SCHEMA


def read_json_records(spark: SparkSession, path: str,
                      schema: T.StructType = OCCURRENCE_SCHEMA) -> DataFrame:
    """Read JSON-lines records with a declared schema (no inference pass over
    the files).  Strict like the writer: a malformed line or a bare NaN fails
    the read instead of turning into NULLs."""
    return (spark.read.schema(schema)
                 .option("mode", "FAILFAST")
                 .option("allowNonNumericNumbers", "false")
                 .json(path))
