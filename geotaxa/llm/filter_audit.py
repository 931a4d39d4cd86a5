"""Audit of how five document filters interact, for every order of them.

A document fails

* A with under 100 words (maximal runs of other bytes than white space);
* B with fewer than 80 distinct words in 100 (case-sensitive);
* C with more than 10 capitals A-Z in 100 code points;
* D with any of ``# $ % & * |``;
* E if its text is that of a document with a smaller doc_id, removed or not.

*Existential self-join.*  E is a left-semi join on hash, exact text and
smaller doc_id.  Only texts whose hash occurs under two ids enter it (a count
of hashes alone finds them), and its right side is one row per distinct text
with that text's smallest doc_id, so a third of all rows with one text is one
partner, not a square.  The right side is shuffled by itself, which lets AQE
split a hot text on the left.

*Bit combinations.*  The ids that fail E are united with those that fail the
other filters, the bits of one document are put together, and documents are
counted by (part, bits, labels) - at most 128 counts a part.  All 120 orders
and their steps are computed from those counts alone.

Defined cases: a null text is empty (it fails A; it fails neither B nor C,
as 0 < 0 and 0 > 0 are false); a null lang is the part ''; a null doc_id
neither fails E nor makes another fail it and has no labels; rows that repeat
a doc_id count one by one and do not fail E by each other; a document with
several rows of labels has those that any of them gives; an empty table gives
no rows; further columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.functions.joins import own_shuffle
from geotaxa.llm.text import read_documents

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
# White space between words, and the marks of filter D.
SPACES = r"[\x20\x09-\x0D]+"
MARKS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
REPEAT = 1 << FILTERS.index("E")


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails by itself."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    tests = [F.size(words) < MIN_WORDS,
             100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
             100 * (F.length(text) - F.length(F.translate(text, CAPITALS, ""))) > MAX_CAPITALS * F.length(text),
             F.regexp_like(text, F.lit(MARKS))]
    bits = F.lit(0)
    for i, test in enumerate(tests):
        bits = bits + F.when(test, 1 << i).otherwise(0)
    return bits


def repeated_texts(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (doc_id, hash, text, ...) whose text a smaller doc_id has."""
    seen = texts.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    twice = own_shuffle(seen.where("low < high").select("hash"))
    likely = texts.join(twice, "hash", "left_semi")
    # A second hash as the key: the copies a task holds then become one row
    # before they are shuffled, where the first hash would bring them together.
    likely = likely.withColumn("again", F.hash("text"))
    first = likely.groupBy(F.col("again").alias("h"), F.col("text").alias("t")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    first = own_shuffle(first.where("low < high").drop("high"))
    same = (F.col("again") == F.col("h")) & (F.col("text") == F.col("t")) & (F.col("low") < F.col("doc_id"))
    return likely.join(first, same, "left_semi")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the set of filters they fail,
    those of them labelled good (quality 1) and toxic."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    own = texts.select("doc_id", "hash", "part", own_failures(F.col("text")).alias("bits"), F.lit(1).alias("rows"))
    again = repeated_texts(texts).select("doc_id", "hash", "part", F.lit(REPEAT).alias("bits"), F.lit(0).alias("rows"))
    failed = own.unionByName(again).groupBy("doc_id", "hash", "part").agg(
        F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return failed.join(marks, "doc_id", "left").groupBy("part", "bits").agg(
        F.sum("rows").alias("n"),
        F.sum(F.col("rows") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("rows") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from ``combinations``."""
    bit_of = lambda at: F.expr(f"shiftleft(1, ascii(substring(filter_order, {at}, 1)) - ascii('{FILTERS[0]}'))")
    steps = [F.struct(F.lit(i).alias("step"), bit_of(i).alias("own"),
                      sum((bit_of(j) for j in range(1, i)), F.lit(0)).alias("before")) for i in range(1, len(FILTERS) + 1)]
    rows = counts.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in ORDERS])))
    rows = rows.withColumn("at", F.explode(F.array(*steps))).select("*", "at.*")
    fails, out = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0
    total = lambda test, what="n": F.sum(F.when(test, F.col(what)).otherwise(0)).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~out).alias("kept"),
        total(fails & ~out).alias("removed"),
        total(fails & out).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"),
        total(fails & ~out, "good").alias("good_lost"),
        total(fails & ~out, "toxic").alias("toxic_lost"),
        # Of all orders, a filter comes first among the k that a document fails in one of k.
        F.sum(F.when(fails, F.col("n") * F.expr(f"{len(ORDERS)} div bit_count(bits)")).otherwise(0)).cast("long").alias("shapley"))


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(combinations(docs, labels))


def oracle_sql() -> str:
    letters = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(FILTERS))
    return f"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
split as (select *, list_filter(string_split_regex(text, '{SPACES}'), lambda w: w <> '') as words,
  coalesce(doc_id > min(doc_id) over (partition by text), false) as again from texts),
marked as (select doc_id, part,
  (case when len(words) < {MIN_WORDS} then 1 else 0 end)
  + (case when 100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words) then 2 else 0 end)
  + (case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(text) then 4 else 0 end)
  + (case when regexp_matches(text, '{MARKS}') then 8 else 0 end)
  + (case when again then 16 else 0 end) as bits from split),
marks as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
  max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
counts as (select part, bits, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from marked left join marks using (doc_id) group by part, bits),
f as (select * from (values {letters}) v(c, bit)),
orders as (select a.c || b.c || d.c || e.c || g.c as filter_order, [a.bit, b.bit, d.bit, e.bit, g.bit] as own
  from f a, f b, f d, f e, f g where a.bit | b.bit | d.bit | e.bit | g.bit = 31),
steps as (select filter_order, step, own[step] as own, coalesce(list_sum(own[1:step - 1]), 0)::int as before
  from orders, (select unnest(range(1, 6)) as step) s),
removed as (select part, filter_order, step, own,
  sum(case when bits & (own | before) = 0 then n else 0 end) as kept,
  sum(case when bits & own <> 0 and bits & before = 0 then n else 0 end) as removed,
  sum(case when bits & own <> 0 and bits & before <> 0 then n else 0 end) as redundant,
  sum(case when bits = own then n else 0 end) as unique_fails,
  sum(case when bits & own <> 0 and bits & before = 0 then good else 0 end) as good_lost,
  sum(case when bits & own <> 0 and bits & before = 0 then toxic else 0 end) as toxic_lost
  from counts, steps group by part, filter_order, step, own)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley from removed"""
