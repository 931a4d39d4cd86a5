"""Occurrence fixture views derived from the driver's order tables.

Observation records, their sync history, a name lookup, stored features and a
feature raster are all derived by Spark from ``lineitem``, ``orders`` and
``part`` (see FIXTURES.md), so every query's work grows with those tables.

* ``occ``          several versions per record, identity (id, source)
* ``latest``       latest version of each record
* ``sync_history`` one high-water mark per (source, family); ``gbif`` has none
* ``names``        given name -> scientific name (``red...`` names unresolved)
* ``features``     land cover already stored for a third of the cells: repeated
                   keys, missing values, a ``fetched`` flag, rows without a key
* ``raster``       what a feature fetch can find (not cells ending in 1), by
                   another formula, with repeated keys and missing values
* ``elevation``    a second feature with the same key

The membership rules of ``features`` / ``raster`` (cell modulo) define which
keys the fixture treats as already stored or fetchable; they are part of the
fixture, not a way to cut work: every query reads the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geotaxa.functions.geo import timestamp_literal
from geotaxa.operators.versions import latest_version
from geotaxa.sources.tables import load_table

# Order priority -> provider name, as in FIXTURES.md.
PRIORITY_TO_SOURCE = [
    ("1-URGENT", "idigbio"),
    ("2-HIGH", "inaturalist"),
    ("3-MEDIUM", "gbif"),
    ("4-NOT SPECIFIED", "mycoportal"),
]
OTHER_SOURCE = "mushroomobserver"

OCC_COLUMNS = ["id", "source", "family", "name", "latitude", "longitude",
               "coordinate_uncertainty", "date", "observed_at", "updated_at",
               "price", "version", "cell_id"]
# Versions of one time are settled by these columns.  Times are cut to quarters
# and prices to steps of 20,000, so versions do tie and ``version`` decides.
TIE_BREAK = ("price", "version")


def _source_expr(priority: Column) -> Column:
    expr = None
    for value, source in PRIORITY_TO_SOURCE:
        expr = (F.when(priority == value, F.lit(source)) if expr is None
                else expr.when(priority == value, F.lit(source)))
    return expr.otherwise(F.lit(OTHER_SOURCE))


def occ(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax",
        "l_extendedprice", "l_shipdate")
    orders = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority")
    part = load_table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", "p_name", "p_size")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey))
    size_mod = F.col("p_size") % 10
    name = (F.when(size_mod == 0, F.col("p_type"))
             .when(size_mod == 1, F.lit(None).cast("string"))
             .otherwise(F.concat(F.col("p_name"), F.lit(" "),
                                 (F.col("p_size") % 4).cast("string"))))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        _source_expr(F.col("o_orderpriority")).alias("source"),
        F.col("p_type").alias("family"),
        name.alias("name"),
        ((F.col("l_suppkey") % 10) * 9 - 45).cast("double").alias("latitude"),
        ((F.col("l_suppkey") % 10) * 18 - 90).cast("double").alias("longitude"),
        F.when(F.col("l_tax") < 0.04, F.lit(None).cast("double"))
         .otherwise(F.lit(40.0)).alias("coordinate_uncertainty"),
        F.trunc(F.to_date("l_shipdate"), "month").alias("date"),
        F.col("o_orderdate").alias("observed_at"),
        F.trunc(F.to_date("l_shipdate"), "quarter").cast("timestamp_ntz").alias("updated_at"),
        F.floor(F.col("l_extendedprice") / 20000).alias("price"),
        (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("version"),
        F.when(F.col("l_suppkey") % 50 != 49, F.col("l_suppkey") % 100).alias("cell_id"),
    )


def latest(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Latest version of each record.  With ``columns`` only those (plus the
    identity and version columns) are carried: the version window then
    shuffles, and the scan reads, just what the caller needs."""
    o = occ(spark, sf_dir)
    if columns is not None:
        keep = ["id", "source", "updated_at", *TIE_BREAK]
        keep += [c for c in columns if c not in keep]
        o = o.select(*keep)
    return latest_version(o, tie_break=TIE_BREAK)


def sync_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = occ(spark, sf_dir)
    ts_type = o.schema["updated_at"].dataType
    mark = (F.when(F.col("family").isin("LARGE", "SMALL"),
                   timestamp_literal("1999-01-01 00:00:00", ts_type))
             .otherwise(timestamp_literal("1997-06-01 00:00:00", ts_type)))
    return (o.where(F.col("source") != "gbif")
             .select("source", "family").distinct()
             .select("source", "family", mark.alias("fetched_at")))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = occ(spark, sf_dir)
    return (o.where(F.col("name").isNotNull() & ~F.col("name").like("red%"))
             .select(F.col("name").alias("given_name"),
                     F.upper("name").alias("scientific_name"))
             .distinct())


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occ(spark, sf_dir).select("cell_id", "date").distinct()


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell, month = F.col("cell_id"), F.month("date")
    keys = _cells(spark, sf_dir).where((cell % 3 == 0) | cell.isNull())
    first = keys.select("cell_id", "date", F.when(cell % 5 != 0, (cell + month) % 7).alias("landcover"),
                        (cell % 10 == 0).alias("fetched"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("appended_at"))
    again = keys.where(cell % 2 == 0).select(
        "cell_id", "date", F.when(cell % 4 != 0, (cell + month + 1) % 7).alias("landcover"),
        F.lit(False).alias("fetched"), F.lit("2020-02-01 00:00:00").cast("timestamp_ntz").alias("appended_at"))
    return first.unionAll(again)


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("cell_id")
    keys = _cells(spark, sf_dir).where(cell % 10 != 1)
    found = keys.select("cell_id", "date", F.when(cell % 7 != 0, (cell + F.month("date") + 3) % 7).alias("landcover"))
    return found.unionAll(keys.where(cell % 9 == 0).select("cell_id", "date", F.lit(None).cast("long").alias("landcover")))


def elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.col("cell_id")
    return _cells(spark, sf_dir).where(cell % 4 != 2).select("cell_id", "date", (cell * 10 + F.month("date")).alias("elevation"))


# DuckDB text of the same views, for the oracle (tables are pre-registered).
DUCKDB_VIEWS = {
    "occ": """
select l_orderkey * 10 + l_linenumber as id,
  case o_orderpriority when '1-URGENT' then 'idigbio' when '2-HIGH' then 'inaturalist'
    when '3-MEDIUM' then 'gbif' when '4-NOT SPECIFIED' then 'mycoportal'
    else 'mushroomobserver' end as source,
  p_type as family,
  case when p_size % 10 = 0 then p_type when p_size % 10 = 1 then null
    else p_name || ' ' || cast(p_size % 4 as varchar) end as name,
  cast((l_suppkey % 10) * 9 - 45 as double) as latitude,
  cast((l_suppkey % 10) * 18 - 90 as double) as longitude,
  case when l_tax < 0.04 then null else cast(40 as double) end as coordinate_uncertainty,
  cast(date_trunc('month', l_shipdate) as date) as date,
  o_orderdate as observed_at, cast(date_trunc('quarter', l_shipdate) as timestamp) as updated_at,
  cast(floor(l_extendedprice / 20000) as bigint) as price, l_partkey * 1000000 + l_suppkey as version,
  case when l_suppkey % 50 <> 49 then l_suppkey % 100 end as cell_id
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "latest": """
select id, source, family, name, latitude, longitude, coordinate_uncertainty, date,
  observed_at, updated_at, price, version, cell_id
from (select *, row_number() over (partition by id, source
        order by updated_at desc, price desc, version desc) as r from occ)
where r = 1""",
    "sync_history": """
select source, family,
  case when family in ('LARGE', 'SMALL') then timestamp '1999-01-01 00:00:00'
    else timestamp '1997-06-01 00:00:00' end as fetched_at
from occ where source <> 'gbif' group by source, family""",
    "names": """
select distinct name as given_name, upper(name) as scientific_name
from occ where name is not null and name not like 'red%'""",
    "features": """
select cell_id, date, case when cell_id % 5 <> 0 then (cell_id + month(date)) % 7 end as landcover,
  cell_id % 10 = 0 as fetched, timestamp '2020-01-01 00:00:00' as appended_at
from (select distinct cell_id, date from occ where cell_id % 3 = 0 or cell_id is null) k
union all
select cell_id, date, case when cell_id % 4 <> 0 then (cell_id + month(date) + 1) % 7 end,
  false, timestamp '2020-02-01 00:00:00'
from (select distinct cell_id, date from occ where cell_id % 6 = 0) k""",
    "stored": """
select cell_id, date, landcover, coalesce(flag, false) as fetched
from (select *, bool_or(fetched) over (partition by cell_id, date) as flag, row_number() over (
        partition by cell_id, date order by (landcover is not null) desc, appended_at desc, landcover desc) as r
      from features where cell_id is not null and date is not null)
where r = 1""",
    "raster": """
select cell_id, date, case when cell_id % 7 <> 0 then (cell_id + month(date) + 3) % 7 end as landcover
from (select distinct cell_id, date from occ where cell_id % 10 <> 1) k
union all
select distinct cell_id, date, cast(null as bigint) from occ where cell_id % 9 = 0 and cell_id % 10 <> 1""",
    "found": """
select cell_id, date, max(landcover) as landcover from raster group by cell_id, date""",
    "elevation": """
select distinct cell_id, date, cell_id * 10 + month(date) as elevation from occ where cell_id % 4 <> 2""",
    "missing": """
select distinct cell_id, date from latest l where cell_id is not null and date is not null
  and not exists (select 1 from stored s where s.cell_id = l.cell_id and s.date = l.date
                  and (s.landcover is not null or s.fetched))""",
    "got": """
select m.cell_id, m.date, r.landcover, true as fetched from missing m
  left join found r on m.cell_id = r.cell_id and m.date = r.date""",
    "merged": """
select o.*, coalesce(f.landcover, m.landcover) as lc from latest o
  left join stored f on o.cell_id = f.cell_id and o.date = f.date
  left join got m on o.cell_id = m.cell_id and o.date = m.date""",
}
_VIEW_DEPS = {
    "occ": [], "latest": ["occ"], "sync_history": ["occ"], "names": ["occ"],
    "features": ["occ"], "raster": ["occ"], "elevation": ["occ"],
    "stored": ["features"], "found": ["raster"], "missing": ["latest", "stored"],
    "got": ["missing", "found"], "merged": ["latest", "stored", "got"],
}


def with_views(sql: str, views: list[str]) -> str:
    """Prefix ``sql`` with the CTEs it needs, dependencies first."""
    ordered: list[str] = []

    def add(v: str) -> None:
        for d in _VIEW_DEPS[v]:
            add(d)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        add(v)
    if not ordered:
        return sql.strip()
    ctes = ",\n".join(f"{v} as ({DUCKDB_VIEWS[v].strip()})" for v in ordered)
    return f"with {ctes}\n{sql.strip()}"
