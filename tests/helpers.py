"""Small builders for hand-made occurrence rows."""

import datetime as dt

from pyspark.sql import types as T

OCC_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("coordinate_uncertainty", T.DoubleType()),
    T.StructField("date", T.DateType()),
    T.StructField("observed_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("cell_id", T.LongType()),
])

D0 = dt.date(2016, 5, 1)
T0 = dt.datetime(2016, 5, 2, 12, 0, 0)


def row(id, source="gbif", name="Amanita muscaria", lat=1.0, lon=2.0, unc=30.0,
        date=D0, observed=T0, updated=T0, price=1.0, cell=7, family="AMANITACEAE"):
    return (id, source, family, name, lat, lon, unc, date, observed, updated, price, cell)


def occ_df(spark, rows):
    return spark.createDataFrame(rows, OCC_SCHEMA)


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}
