"""Mixing sources to target weights by iterative proportional fitting.

Only DataFrame functions.  Documents fall into cells (source, language,
topic); a cell's weight starts as its tokens.  A round scales the weights so
that they meet the target share of each source, then of each language, then of
each topic; after ``rounds`` rounds all three margins are met closely.  A
document's ``weight`` is its cell's final weight over the cell's tokens times
``budget`` (tokens wanted over tokens there): the expected number of copies.
``copies`` is its whole part, plus one with the probability of the rest, drawn
from a hash of doc_id and ``seed``, so a rerun draws the same.

Targets come as (dimension, value, share) or, by default, as each value's
tokens to the power ``temper``, which lifts small sources and languages.
Shares are scaled to add up to 1 over the values present; a value without a
target gets none.

The text is read once to count and class it; cells are summed in map tasks
before the shuffle, so a source with a third of all rows is one row a task.
The cell table is small but stays a table: it is written to the shared
checkpoint folder after each round and joined as the planner decides.

Defined cases: a null source, language or topic is the value ``(none)``; a
null text has no tokens and copies like any other of its cell; a cell without
tokens has weight 0; repeated rows are drawn alike; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.llm.text import read_documents
from geotaxa.session import materialize

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"
ROUNDS, TEMPER, BUDGET, SEED = 8, 0.7, 1.0, 20
# Topic of the first rule that holds; marks are text pieces.
TOPIC_MARKS = (("table", (" | ",)), ("symbols", ("###", "$$$", "&&&", "%%%", "***")), ("shouting", ("!! ",)))
SHORT, LONG = 800, 6000


def topic_of(text: Column) -> Column:
    """A document's kind of text, by marks and length."""
    rule = F.when(F.length(F.coalesce(text, F.lit(""))) == 0, NONE)
    for topic, marks in TOPIC_MARKS:
        found = text.contains(marks[0])
        for m in marks[1:]:
            found = found | text.contains(m)
        rule = rule.when(found, topic)
    return rule.when(F.length(text) < SHORT, "short").when(F.length(text) >= LONG, "long").otherwise("prose")


def count_tokens(text: Column) -> Column:
    """Runs without ASCII white space."""
    text = F.coalesce(text, F.lit(""))
    blank = "[\\x20\\x09-\\x0D]"
    ends = F.substring(text, 1, 1).rlike(blank).cast("long") + F.substring(text, -1, 1).rlike(blank).cast("long")
    return F.when(text == "", 0).otherwise(F.size(F.split(text, blank + "+")) - ends).cast("long")


def default_targets(cells: DataFrame, temper: float = TEMPER) -> DataFrame:
    parts = None
    for d in DIMENSIONS:
        own = cells.groupBy(F.col(d).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("share")) \
            .select(F.lit(d).alias("dimension"), "value", "share")
        parts = own if parts is None else parts.unionAll(own)
    return parts


def rake(cells: DataFrame, targets: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, tokens, fitted) whose margins meet ``targets``."""
    present = None
    for d in DIMENSIONS:
        own = cells.where("tokens > 0").select(F.lit(d).alias("dimension"), F.col(d).alias("value")).distinct()
        present = own if present is None else present.unionAll(own)
    wanted = materialize(targets.join(present, ["dimension", "value"], "left_semi"), "targets")
    sums = wanted.groupBy("dimension").agg(F.sum("share").alias("all"))
    wanted = materialize(wanted.join(sums, "dimension").select("dimension", "value", (F.col("share") / F.col("all")).alias("share")), "targets")
    total = cells.agg(F.sum("tokens").cast("double")).head()[0] or 0.0
    fitted = cells.withColumn("fitted", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for d in DIMENSIONS:
            share = wanted.where(F.col("dimension") == d).select(F.col("value").alias(d), "share")
            margin = fitted.groupBy(d).agg(F.sum("fitted").alias("margin")).join(share, d, "left")
            scale = F.when(F.col("margin") > 0, F.coalesce("share", F.lit(0.0)) * F.lit(total) / F.col("margin")).otherwise(0.0)
            fitted = fitted.join(margin.select(d, scale.alias("scale")), d).withColumn("fitted", F.col("fitted") * F.col("scale")).drop("scale")
        fitted = materialize(fitted, "cells")
    return fitted.select(*DIMENSIONS, "tokens", "fitted")


def mix_sources(docs: DataFrame, targets: DataFrame | None = None, budget: float = BUDGET, rounds: int = ROUNDS,
                seed: int = SEED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, then source, lang, topic, n_tokens, weight, copies."""
    names = {d: f"_{d}" for d in DIMENSIONS}
    own = [F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(names[d]) for d in ("source", "lang")]
    classed = docs.select(*keep, F.col("doc_id").alias("_id"), *own, topic_of(F.col("text")).alias("_topic"),
                          count_tokens(F.col("text")).alias("_tokens"))
    cells = materialize(classed.groupBy(*names.values()).agg(F.sum("_tokens").alias("tokens")).select(
        *[F.col(n).alias(d) for d, n in names.items()], "tokens"), "cells")
    fitted = rake(cells, targets if targets is not None else default_targets(cells), rounds)
    rates = fitted.select(*[F.col(d).alias(n) for d, n in names.items()], F.round(
        F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens") * budget).otherwise(0.0), 6).alias("_weight"))
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 8),
                  16, 10).cast("double") / F.lit(float(1 << 32))
    weight = F.col("_weight")
    copies = F.floor(weight) + (draw < weight - F.floor(weight)).cast("long")
    # "_" columns keep apart what ``keep`` may also name.
    found = classed.join(rates, list(names.values()))
    return found.select(*keep, *[F.col(n).alias(d) for d, n in names.items() if d not in keep], F.col("_tokens").alias("n_tokens"),
                        weight.alias("weight"), copies.cast("long").alias("copies"))


def op2_raking(spark, sf_dir: str) -> DataFrame:
    return mix_sources(read_documents(spark, sf_dir, "doc_id", "text", "lang", "source"))


def oracle_sql() -> str:
    """The same in DuckDB, with the rounds written out."""
    marks = " ".join("WHEN " + " OR ".join(f"contains(text, '{m}')" for m in ms) + f" THEN '{topic}'" for topic, ms in TOPIC_MARKS)
    steps, last = [], "cells"
    for r in range(ROUNDS):
        for d in DIMENSIONS:
            steps.append(f"r{r}{d} AS MATERIALIZED (SELECT c.* REPLACE (c.fitted * t.share * (SELECT sum(tokens) FROM cells) / "
                         f"sum(c.fitted) OVER (PARTITION BY c.{d}) AS fitted) FROM {last} c JOIN t_{d} t USING ({d}))")
            last = f"r{r}{d}"
    targets = ", ".join(
        f"t_{d} AS MATERIALIZED (SELECT {d}, pow(sum(tokens), {TEMPER}) / sum(pow(sum(tokens), {TEMPER})) OVER () AS share "
        f"FROM cells WHERE tokens > 0 GROUP BY {d})" for d in DIMENSIONS)
    return f"""
WITH docs AS MATERIALIZED (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
  CASE WHEN length(coalesce(text, '')) = 0 THEN '{NONE}' {marks} WHEN length(text) < {SHORT} THEN 'short'
    WHEN length(text) >= {LONG} THEN 'long' ELSE 'prose' END AS topic,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens, CAST(sum(n_tokens) AS DOUBLE) AS fitted
  FROM docs GROUP BY ALL),
{targets},
{", ".join(steps)},
w AS (SELECT d.*, coalesce(round(CASE WHEN c.tokens > 0 THEN c.fitted / c.tokens * {BUDGET} ELSE 0 END, 6), 0) AS weight,
  ('0x' || md5(concat(CAST(d.doc_id AS VARCHAR), ':{SEED}'))[1:8])::BIGINT / 4294967296.0 AS draw
  FROM docs d LEFT JOIN {last} c USING (source, lang, topic))
SELECT doc_id, source, lang, topic, n_tokens, CAST(weight AS DOUBLE) AS weight,
  CAST(floor(weight) AS BIGINT) + CASE WHEN draw < weight - floor(weight) THEN 1 ELSE 0 END AS copies FROM w"""
