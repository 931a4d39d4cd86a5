"""Small documents for the operators of geotaxa.llm."""

import os

import duckdb
from pyspark.sql import types as T

SF = os.environ.get("GEOTAXA_TEST_SF", "/root/testdata/sf0.001")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def docs_df(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, None, None)[:4] if len(r) == 2 else (*r, None)[:4] if len(r) == 3 else r
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    return spark.createDataFrame(full, SCHEMA)


def with_clashes(df):
    """Columns that share names with what the operators add."""
    from pyspark.sql import functions as F
    for c in ("score", "kept", "component_id", "weight", "copies", "labels", "n", "bands", "_bucket", "spans", "node", "value"):
        df = df.withColumn(c, F.lit("x"))
    return df


def duck(sf=SF):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def texts(sf=SF):
    return dict(duck(sf).execute("select doc_id, coalesce(text, '') from documents").fetchall())


def rows_by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "x"), (5, "é ü ß 漢字 🙂"), (6, "word " * 4000), (7, "same text here"),
       (7, "same text here"), (8, "same text here"), (None, "no id at all")]
