"""Provider pulls through Spark's Python data source API."""

import datetime as dt
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from geotaxa.sources.pull_source import ParquetClient, pull_source, read_due
from geotaxa.sources.sync import incremental_pull
from helpers import OCC_SCHEMA, T0, as_set, occ_df, row

cloudpickle.register_pickle_by_value(sys.modules[__name__])
PUSH = "spark.sql.python.filterPushdown.enabled"


class Greedy(ParquetClient):
    """Answers with more than it was asked for."""

    def fetch(self, source, family, updated_after, updated_before, observed_after, observed_before):
        yield from self.table.to_batches()


def day(n):
    return T0 + dt.timedelta(days=n)


@pytest.fixture
def case(spark, tmp_path):
    rows = [row(i, source=("gbif", "idigbio", "x")[i % 3], family=f"F{i % 4}", updated=day(i % 50), observed=day(i % 31)) for i in range(600)]
    raw, path = occ_df(spark, rows), str(tmp_path / "records")
    raw.repartition(3).write.parquet(path)
    history = spark.createDataFrame([("gbif", "F0", day(10)), ("gbif", "F0", day(20)), ("gbif", "F1", day(49)), ("idigbio", "F2", day(5)),
                                     ("nobody", "F0", day(0)), ("x", None, day(0)), ("x", "F3", None)],
                                    "source string, family string, fetched_at timestamp_ntz")
    spark.dataSource.register(pull_source(ParquetClient))
    spark.dataSource.register(pull_source(Greedy, "greedy_pull"))
    yield raw, path, history
    spark.conf.set(PUSH, "false")


@pytest.mark.parametrize("push", ["false", "true"])
@pytest.mark.parametrize("name", ["occurrence_pull", "greedy_pull"])
def test_reads_what_the_pull_returns(spark, case, name, push):
    raw, path, history = case
    spark.conf.set(PUSH, push)
    df = read_due(spark, history, OCC_SCHEMA, format_name=name, path=path)
    want = incremental_pull(raw, history, observed_after=None, observed_before=None)
    assert as_set(df, "id", "source", "updated_at") == as_set(want, "id", "source", "updated_at") and df.count() == want.count() > 0
    assert df.rdd.getNumPartitions() == 4                       # one a due (source, family)
    options = dict(observed_after=day(3), observed_before=day(20), modified_before=day(40), restrict_families=["F0", "F2"])
    got = read_due(spark, history, OCC_SCHEMA, restrict_families=["F0", "F2"], format_name=name, path=path).where(
        (F.col("observed_at") >= F.lit(day(3)).cast("timestamp_ntz")) & (F.col("observed_at") < F.lit(day(20)).cast("timestamp_ntz"))
        & (F.col("updated_at") < F.lit(day(40)).cast("timestamp_ntz")))
    assert as_set(got, "id") == as_set(incremental_pull(raw, history, **options), "id") and got.count() > 0


def test_a_pushed_restriction_makes_fewer_partitions(spark, case):
    raw, path, history = case
    spark.conf.set(PUSH, "true")
    whole = read_due(spark, history, OCC_SCHEMA, path=path)
    one = whole.where("source = 'gbif' and family in ('F0', 'F2')")
    late = whole.where(F.col("updated_at") < F.lit(day(12)).cast("timestamp_ntz"))
    assert (whole.rdd.getNumPartitions(), one.rdd.getNumPartitions(), late.rdd.getNumPartitions()) == (4, 1, 2)
    want = incremental_pull(raw, history, observed_after=None, observed_before=None)
    assert as_set(one, "id") == as_set(want.where("source = 'gbif' and family = 'F0'"), "id")
    assert as_set(late, "id") == as_set(want.where(F.col("updated_at") < F.lit(day(12)).cast("timestamp_ntz")), "id")


def test_nothing_due(spark, case):
    _, path, history = case
    assert read_due(spark, history.where("source = 'x'"), OCC_SCHEMA, path=path).count() == 0


def test_the_parquet_client_holds_little_of_a_row_group(tmp_path):
    n = 1_000_000
    at = pa.array([T0 + dt.timedelta(minutes=1)] * n, pa.timestamp("us"))
    table = pa.table({"id": pa.array(range(n)), "source": ["gbif", "x"] * (n // 2), "family": ["F0"] * n, "updated_at": at, "observed_at": at,
                      "name": [f"a name of some length {i}" for i in range(n)]})
    pq.write_table(table, str(tmp_path / "one.parquet"), row_group_size=n)
    pq.write_table(table.slice(0, 9).drop(["name"]), str(tmp_path / "two.parquet"))   # a column that a file lacks is null
    client = ParquetClient({"path": str(tmp_path)})
    before, held, found = pa.total_allocated_bytes(), 0, []
    for batch in client.fetch("gbif", "F0", T0, None, None, None):
        held = max(held, pa.total_allocated_bytes() - before)
        found += batch["id"].to_pylist()
        assert batch.schema == client.table.schema
        del batch
    assert sorted(found) == sorted([*range(0, n, 2), *range(0, 9, 2)])
    assert held < table.nbytes / 2
    assert not [b for b in client.fetch("gbif", "F0", T0 + dt.timedelta(days=1), None, None, None) if len(b)]
