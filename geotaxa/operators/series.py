"""Features over time: the nearest earlier value, and windows of fixed length.

``asof_features`` gives each occurrence the latest feature of its cell that is
not after it, at most ``tolerance_days`` old.  Occurrences and features are
sorted together by (cell, date); each range of that order is read as a stream
that remembers one feature row, and what a range needs from the ones before it
is carried over in a table of at most two rows a range.  There is no window over
a cell and no join on it: a cell with a third of all rows is cut into ranges like
any other stretch of the order, also where all its rows have one date.

``feature_windows`` gives each occurrence the last N steps (days or months) of
its cell as an array of N values, a gap being null.  A cell's values are one
dense array with the place of its first step, as long as the calendar between
its first and last value, and reach each occurrence as one row; the N values are
cut out by position, so there is no join on a range of dates.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotaxa.functions.joins import own_shuffle
from geotaxa.operators.features import FETCHED, FeatureSpec, _without_values, has_key, one_row_per_key
from geotaxa.session import materialize

_FEATURE, _PID, _OPEN = "_is_feature", "_pid", "_open"


def _fill(by: Sequence[str], values: Sequence[str]):
    """Sorted rows -> occurrences with the last feature of their cell seen in
    this range, and at the end the range's last feature.  ``_open`` marks
    occurrences of the range's first cell before its first feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, held, before, opening = TaskContext.get().partitionId(), None, None, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            table = pa.Table.from_batches([batch])
            new = np.zeros(n, bool)
            for c in by:
                column = batch.column(c)
                new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
                new[0] |= before is None or before.column(c)[0].as_py() != column[0].as_py()
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))       # -1: goes on from the batch before
            feature = batch.column(_FEATURE).to_numpy(zero_copy_only=False).astype(bool)
            last = np.maximum.accumulate(np.where(feature, at, -1))
            from_here = (last >= np.maximum(start, 0)) & (last >= 0)
            from_held = ~from_here & (start < 0) & (held is not None)
            first_run = (start < 0) | (start == 0) if before is None else start < 0
            open_ = opening & first_run & ~from_here & ~from_held
            opening = opening and bool(first_run[-1])
            rows = table if held is None else pa.concat_tables([held, table])
            take = np.where(from_here, last + (held is not None), 0)
            wanted = pa.array(take, mask=~(from_here | from_held))
            own = ~feature
            out = table.set_column(table.schema.get_field_index(values[0]), values[0], rows.column(values[0]).take(wanted))
            for v in values[1:]:
                out = out.set_column(out.schema.get_field_index(v), v, rows.column(v).take(wanted))
            out = out.append_column(_PID, pa.array(np.full(n, pid, np.int64))).append_column(_OPEN, pa.array(open_))
            yield from out.filter(pa.array(own)).combine_chunks().to_batches()
            before = table.slice(n - 1, 1)
            if from_here[-1]:
                held = table.slice(int(last[-1]), 1)
            elif not from_held[-1]:
                held = None
        if held is not None:
            yield from held.append_column(_PID, pa.array([pid], pa.int64())).append_column(_OPEN, pa.array([False])).to_batches()

    return run


def asof_features(occ: DataFrame, table: DataFrame, spec: FeatureSpec, tolerance_days: int | None = None,
                  at_col: str = "feature_date", identity: Sequence[str] = ("source", "id")) -> DataFrame:
    """Every occurrence once, with the values of the nearest feature row of its
    cell (the key columns but the last) whose date (the last key column) is not
    after its own, and that row's date as ``at_col``; both null where there is
    none or it is more than ``tolerance_days`` older.

    A feature of the same date is the nearest.  Repeated feature keys are reduced
    as everywhere (``one_row_per_key``); a row without a value is a feature, too,
    so filter ``table`` first to look past such rows.  Occurrences without a key
    have no feature.  ``identity`` only splits many rows of one cell and date."""
    *by, on = spec.key_cols
    values = [*spec.value_cols, at_col]
    occ = _without_values(occ, spec, [at_col, _FEATURE, _PID, _OPEN])
    found = one_row_per_key(table, spec).drop(FETCHED).withColumn(at_col, F.col(on))
    kinds = {f.name: f.dataType for f in found.schema.fields}
    empty = [F.lit(None).cast(kinds[v]).alias(v) for v in values]
    ours = occ.where(has_key(spec)).select(*occ.columns, *empty, F.lit(False).alias(_FEATURE))
    theirs = found.select(*[F.col(c).cast(occ.schema[c].dataType).alias(c) if c in spec.key_cols
                            else F.lit(None).cast(occ.schema[c].dataType).alias(c) for c in occ.columns],
                          *values, F.lit(True).alias(_FEATURE))
    rows = ours.unionByName(theirs)
    order = [*by, on, F.col(_FEATURE).desc(), *[c for c in identity if c in occ.columns]]
    partitions = int(occ.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]
                          + [T.StructField(_PID, T.LongType()), T.StructField(_OPEN, T.BooleanType())])
    ranged = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    filled = materialize(ranged.mapInArrow(_fill(by, values), schema), "asof")

    # One row a range that ends with a feature, one a range that begins open.
    tails = filled.where(_FEATURE).select(_PID, *by, F.struct(*values).alias("_tail"))
    opens = filled.where(_OPEN).select(_PID, *by, F.lit(None).cast(tails.schema["_tail"].dataType).alias("_tail")).distinct()
    earlier = Window.partitionBy(*by).orderBy(_PID, F.col("_tail").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("_ask", F.lit(False)).unionByName(opens.withColumn("_ask", F.lit(True)))
    carried = carried.withColumn("_tail", F.last("_tail", True).over(earlier)).where("_ask").select(F.col(_PID).alias("_p"), "_tail")
    ours = filled.where(f"not {_FEATURE}")
    late = ours.where(_OPEN).drop(*values).join(carried, F.col(_PID) == F.col("_p"), "left").select(
        *occ.columns, *[F.col(f"_tail.{v}").alias(v) for v in values])
    out = ours.where(f"not {_OPEN}").select(*occ.columns, *values).unionByName(late)
    if tolerance_days is not None:
        near = F.col(at_col) >= F.col(on) - F.expr(f"interval {int(tolerance_days)} days")
        out = out.select(*occ.columns, *[F.when(near, F.col(v)).alias(v) for v in values])
    return out.unionByName(occ.where(~has_key(spec)).select(*occ.columns, *empty))


def step_number(date: str | Column, step: str) -> Column:
    """Days or months since a fixed day, as a whole number."""
    c = F.col(date) if isinstance(date, str) else date
    if step == "day":
        return F.unix_date(c.cast("date"))
    if step == "month":
        return F.year(c) * 12 + F.month(c)
    raise ValueError(f"step {step!r}: 'day' or 'month'")


def dense_series(table: DataFrame, spec: FeatureSpec, step: str = "day", value_col: str | None = None) -> DataFrame:
    """Per cell one row: ``first`` (number of its first step) and ``series``, the
    value of every step from there to its last one, null in the gaps.  Of
    several dates within a step the latest value counts."""
    *by, on = spec.key_cols
    v = value_col or spec.value_cols[0]
    steps = one_row_per_key(table, spec).where(F.col(v).isNotNull()).groupBy(*by, step_number(on, step).alias("_at")).agg(
        F.max_by(v, on).alias("_v"))
    entries = F.sort_array(F.collect_list(F.struct("_at", "_v")))
    listed = steps.groupBy(*by).agg(entries.alias("_e"))
    null = F.lit(None).cast(table.schema[v].dataType)
    # Each entry behind the nulls of the gap before it.
    filled = F.flatten(F.transform("_e", lambda x, i: F.concat(
        F.array_repeat(null, F.coalesce(x["_at"] - F.get("_e", i - 1)["_at"] - 1, F.lit(0))), F.array(x["_v"]))))
    return listed.select(*by, F.col("_e")[0]["_at"].alias("first"), filled.alias("series"))


def feature_windows(occ: DataFrame, table: DataFrame, spec: FeatureSpec, length: int, step: str = "day",
                    out: str = "window", count: str = "n_values", value_col: str | None = None) -> DataFrame:
    """Every occurrence once, with ``out``: the values of the ``length`` steps
    that end with its own, oldest first, and ``count``, how many are there.
    Without a key, or where the cell has no value, all are null."""
    *by, on = spec.key_cols
    series = dense_series(table, spec, step, value_col).select(*by, F.col("first").alias("_first"), F.col("series").alias("_series"))
    kept = occ.drop(out, count, "_first", "_series")
    joined = kept.join(own_shuffle(series), on=list(by), how="left")
    begin = step_number(on, step) - F.col("_first") - (length - 1)
    window = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda k: F.get("_series", begin + k))
    cut = joined.select(*kept.columns, window.alias(out))
    return cut.withColumn(count, F.size(F.filter(out, lambda x: x.isNotNull())).cast("long"))
