"""Records whose fields are not declared: kept whole, read strictly.

A record becomes one VARIANT value, so a table can take rows with new, missing
or differently typed fields without a schema change.  ``discover_schema`` says
what a table holds; ``extract_fields`` reads declared fields out of it and fails
on a value that does not fit, instead of storing something else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.schemas import schema_from_fields


def as_variant(df: DataFrame, columns: Sequence[str] | None = None, out: str = "record") -> DataFrame:
    """Each row as one VARIANT object; a null field is there, as a null."""
    return df.select(F.to_variant_object(F.struct(*(columns or df.columns))).alias(out))


def parse_variant(lines: DataFrame, col: str, out: str = "record") -> DataFrame:
    """JSON text as VARIANT; a line that is no JSON fails the job."""
    return lines.select(F.parse_json(col).alias(out))


def discover_schema(df: DataFrame, col: str = "record", out: str = "schema") -> DataFrame:
    """One row: the schema all records fit, as text; a field with values of
    kinds that do not fit together is VARIANT.  Merged as a partial aggregate."""
    return df.agg(F.schema_of_variant_agg(col).alias(out))


def _field(col: str, name: str, kind: str) -> Column:
    path = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
    return F.variant_get(col, path, kind)


def extract_fields(df: DataFrame, fields: Sequence[tuple[str, str, str]], col: str = "record") -> DataFrame:
    """The declared ``fields`` ((name, type, mode) triples, flat) of each record.

    A value that cannot be read as its declared type fails the job, so does a
    missing or null REQUIRED field; a missing NULLABLE one is null.  Fields that
    are not declared are left out."""
    columns = []
    for f in schema_from_fields(fields).fields:
        value = _field(col, f.name, f.dataType.simpleString())
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"no value in REQUIRED field {f.name}")).cast(f.dataType))
        columns.append(value.alias(f.name))
    return df.select(*columns)
