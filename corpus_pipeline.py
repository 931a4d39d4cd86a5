"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and read back as the next one's input.

1. language ID: documents without a language (no letters, or no cosine of at
   least ``MIN_COSINE`` with any learned language, less for texts of few
   trigrams) go;
2. near duplicates: one document of each group (five-word shingles, 0.8) stays;
3. benchmark decontamination: documents that leak a benchmark item go;
4. secret scan: secrets in the text are replaced by a mark;
5. mixing: documents are drawn to the raked weights; the last stage adds
   weight and copies to the columns of documents and leaves out those drawn
   zero times.

Each stage learns and counts on what the one before it kept.  Null and empty
texts have no language and go in the first stage; an empty table stays empty;
further columns travel along and may have any name but those the last stage
adds.  Rows that repeat a doc_id are one document for every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotaxa.llm import hyper_language, qgram_leaks, raking, secret_crf, superminhash
from geotaxa.session import materialize

# Half of the least cosine of 51,282 documents with 400 or more trigrams (0.43);
# random words of learned letters reach 0.20, of other scripts 0.13.
MIN_COSINE = 0.22
# SQL has no form of the first four stages; tests hold them against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    languages, prototypes = hyper_language.learn(docs.select("text", "lang"))
    return hyper_language.keep_known(docs, languages, prototypes, MIN_COSINE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return superminhash.drop_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return qgram_leaks.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def scrub_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_crf.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = docs.drop("weight", "copies")
    mixed = raking.mix_sources(own, keep=tuple(own.columns))
    return mixed.where(F.col("copies") > 0).select(*own.columns, "weight", "copies")


STAGES = [
    ("language ID", language_id),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secret scan", scrub_secrets),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
