"""JSON encode / decode of records.

* nulls are kept (``ignoreNullFields=false``), as a dict dump would keep them;
* ``strict_json`` refuses NaN and +-Infinity, which are not JSON;
* decoding is strict too: non-numeric numbers rejected, malformed text fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.DoubleType, T.FloatType)


def to_json_record(cols: Sequence[str | Column]) -> Column:
    """One JSON object per row, keeping null fields."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def _non_finite(c: Column) -> Column:
    return F.isnan(c) | (c == F.lit(float("inf"))) | (c == F.lit(float("-inf")))


def _refusal(name: str) -> Column:
    return F.lit(f"column {name} holds a number that JSON cannot write")


def strict_json(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Like ``to_json_record`` but raises on NaN / +-Infinity in float columns
    (the row fails the job with a clear message, it is not silently dropped)."""
    names = list(cols) if cols is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    encoded = to_json_record([F.col(n) for n in names])
    for n in names:
        if isinstance(types.get(n), _FLOATS):
            bad = F.coalesce(_non_finite(F.col(n)), F.lit(False))
            encoded = F.when(bad, F.raise_error(_refusal(n))).otherwise(encoded)
    return encoded


def reject_non_finite(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Same columns, but a NaN / +-Infinity in a float column fails the job."""
    names = set(cols) if cols is not None else set(df.columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in names and isinstance(f.dataType, _FLOATS):
            c = F.when(F.coalesce(_non_finite(c), F.lit(False)), F.raise_error(_refusal(f.name)).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def from_json_record(text: str | Column, schema: T.StructType | str) -> Column:
    """Decode a JSON object into a struct whose field order is the schema's."""
    c = F.col(text) if isinstance(text, str) else text
    return F.from_json(c, schema, {"allowNonNumericNumbers": "false", "mode": "FAILFAST"})
