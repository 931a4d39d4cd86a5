"""License scan: an exact containment join of text blocks with license templates.

Only DataFrame functions; one map over the documents after one aggregate that
counts the template tokens in the whole corpus.

*Words* are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing
A-Z (no other letters).  A *block* is every run of ``block_lines`` consecutive
lines that hold a word (one block starts at each), so blank lines and bare
comment marks between the lines of a notice do not cut it.  A block meets a template T when it holds at least
``need = ceil(threshold * |T|)`` of T's distinct tokens.  The filters lose no
such block:

* *global order*: T's tokens are ordered by their count in the corpus, rarest
  first (ties by token);
* *prefix*: a block that misses at most ``|T| - need`` tokens holds one of the
  first ``|T| - need + 1``; texts and blocks without one are skipped;
* *length*: a block with fewer than ``need`` tokens cannot meet T;
* *position*: if the first shared token is number i of T (from 0), at most
  ``|T| - i`` tokens can be shared, so a block whose first shared token comes
  too late is skipped before its tokens are intersected.

``base phrases`` are also located: places where a phrase's words stand
consecutively, counted in words from 0.

Nulls and empty texts give zero counts, null positions and empty labels; every
input row gives one output row, whatever its doc_id; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.llm.text import read_documents

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Phrase -> label.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label -> wordings of public license notices.
TEMPLATES = {
    "apache-2.0": ["licensed under the apache license version 2.0",
                   "you may not use this file except in compliance with the license"],
    "bsd": ["redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4.0"],
    "gpl-3.0": ["this work is licensed under the gnu general public license version 3"],
    "mit": ["released under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of "
            "this software and associated documentation files"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
}


def _tokens(text: str) -> list[str]:
    return sorted({w for w in re.split(SEPARATORS + "+", text.lower()) if w})


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def _phrase_pattern(phrase: str) -> str:
    return f"(?<!{WORD})" + (SEPARATORS + "+").join(phrase.split()) + f"(?!{WORD})"


def token_counts(docs: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Occurrences of ``tokens`` in all texts; one row per token reaches the driver."""
    words = docs.select(F.explode(F.split(_lower(F.col("text")), SEPARATORS + "+")).alias("token"))
    rows = words.where(F.col("token").isin(tokens)).groupBy("token").count().collect()
    return dict.fromkeys(tokens, 0) | {r["token"]: r["count"] for r in rows}


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _labels(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull()))), ",")


def _containment(ordered: list[str], need: int, first: list[str]) -> Callable[[Column], Column]:
    """Share of the template's tokens in a block, null where a filter rules the block out."""

    def share(block: Column) -> Column:
        # The number of the first shared token bounds what can be shared.
        at = F.array_position(F.transform(_strings(ordered), lambda t: F.array_contains(block, t)), F.lit(True))
        possible = F.arrays_overlap(block, _strings(first)) & (F.size(block) >= need)
        return F.when(possible, F.when(len(ordered) - at + 1 >= need, F.size(
            F.array_intersect(block, _strings(ordered))) / F.lit(len(ordered))))

    return share


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES,
                  phrases: dict[str, str] = BASE_PHRASES, threshold: float = 0.8,
                  block_lines: int = 3) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (largest containment that meets the threshold,
    else 0)."""
    docs = docs.select("doc_id", "text")
    entries = [(label, _tokens(t)) for label, texts in sorted(templates.items()) for t in texts]
    counts = token_counts(docs, sorted({t for _, ts in entries for t in ts})) if entries else {}
    plans = []
    for label, tokens in entries:
        ordered = sorted(tokens, key=lambda t: (counts[t], t))
        need = math.ceil(threshold * len(ordered) - 1e-9)
        plans.append((label, ordered, need, ordered[:len(ordered) - need + 1]))

    low = F.col("_low")
    df = docs.select("doc_id", _lower(F.coalesce("text", F.lit(""))).alias("_low"))

    def count_words(c: Column) -> Column:
        # Pieces between separators, without the empty ones at both ends.
        ends = F.substring(c, 1, 1).rlike(SEPARATORS).cast("long") + F.substring(c, -1, 1).rlike(SEPARATORS).cast("long")
        return F.when(c == "", 0).otherwise(F.size(F.split(c, SEPARATORS + "+")) - ends).cast("long")

    # Base phrases: the word number of a place is the number of words before it.
    n_words = count_words(low)
    places, firsts, lasts, base = [], [], [], []
    for phrase, label in phrases.items():
        pattern = _phrase_pattern(phrase)
        has = low.rlike(pattern)
        for w in phrase.split():
            has = low.contains(w) & has
        places.append(F.when(has, F.size(F.split(low, pattern, -1)) - 1).otherwise(0).cast("long"))
        firsts.append(F.when(has, count_words(F.split(low, pattern, 2)[0])))
        lasts.append(F.when(has, n_words - len(phrase.split())
                            - count_words(F.element_at(F.split(low, pattern, -1), -1))))
        base.append(F.when(has, F.lit(label)))
    total = places[0]
    for p in places[1:]:
        total = total + p
    nothing = F.lit(None).cast("long")

    # Templates: blocks of the texts that hold a prefix token of any template.
    # A token that the whole corpus lacks is in no block.
    prefix = sorted({t for *_, ts in plans for t in ts if counts[t]})
    candidate = F.lit(False)
    for t in prefix:
        candidate = candidate | (low.contains(t) & low.rlike(_phrase_pattern(t)))
    lines = F.filter(F.split(low, "\n"), lambda line: line.rlike(WORD))
    blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(lines), F.lit(1))), lambda i: F.array_distinct(
        F.split(F.concat_ws(" ", F.slice(lines, i, block_lines)), SEPARATORS + "+")))
    blocks = F.filter(blocks, lambda b: F.arrays_overlap(b, _strings(prefix)))
    df = df.select(
        "doc_id", n_words.alias("n_words"), total.alias("n_base"),
        F.least(*firsts, nothing).alias("first_word"), F.greatest(*lasts, nothing).alias("last_word"),
        F.array(*base).alias("_base"),
        (F.when(candidate, blocks) if prefix else F.lit(None).cast("array<array<string>>")).alias("_blocks"))

    found = []
    for label, ordered, need, first in plans:
        share = F.array_max(F.transform(F.col("_blocks"), _containment(ordered, need, first)))
        found.append(F.when(share >= need / len(ordered) - 1e-12, F.struct(share.alias("score"), F.lit(label).alias("label"))))
    hits = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.lit(None).cast("array<struct<score:double,label:string>>")
    df = df.withColumn("_hits", F.when(F.size("_blocks") > 0, hits))
    more = F.coalesce(F.transform("_hits", lambda x: x["label"]), F.array().cast("array<string>"))
    return df.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        _labels(F.col("_base")).alias("base_labels"), _labels(F.concat("_base", more)).alias("labels"),
        F.coalesce(F.array_max(F.transform("_hits", lambda x: x["score"])), F.lit(0.0)).alias("score"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(read_documents(spark, sf_dir, "doc_id", "text"))


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def oracle_sql(threshold: float = 0.8, block_lines: int = 3) -> str:
    """The same digest in DuckDB, without any filter: every block against every template."""
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    places = []
    for phrase, label in BASE_PHRASES.items():
        w = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(w))
        places.append(f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {test}), "
                      f"lambda i: {{'at': i - 1, 'label': '{label}'}})")
    checks = []
    for label, texts in sorted(TEMPLATES.items()):
        for t in texts:
            tokens = _tokens(t)
            need = math.ceil(threshold * len(tokens) - 1e-9)
            checks.append((label, tokens, need))
    parts = ", ".join(
        f"{{'label': '{label}', 'need': {need}, 'size': {len(tokens)}, "
        f"'n': list_max(list_transform(b, lambda x: len(list_intersect(x, {_sql_list(tokens)}))))}}"
        for label, tokens, need in checks)
    return f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS low FROM documents),
w AS (SELECT doc_id, low, regexp_extract_all(low, '{word}') AS w, list_filter(string_split(low, chr(10)), lambda l: regexp_matches(l, '{word}')) AS ls FROM t),
p AS (SELECT doc_id, len(w) AS n_words, list_concat({places[0]}, list_concat({places[1]},
        list_concat({places[2]}, {places[3]}))) AS p,
        list_transform(range(1, greatest(len(ls), 1) + 1), lambda i: regexp_extract_all(
            array_to_string(ls[i:i + {block_lines - 1}], ' '), '{word}')) AS b FROM w),
h AS (SELECT doc_id, n_words, p, list_filter([{parts}], lambda x: x.n >= x.need) AS h FROM p)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
  CAST(list_min(list_transform(p, lambda x: x.at)) AS BIGINT) AS first_word,
  CAST(list_max(list_transform(p, lambda x: x.at)) AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.label),
    list_transform(h, lambda x: x.label)))), ','), '') AS labels,
  coalesce(list_max(list_transform(h, lambda x: x.n / x.size)), 0.0) AS score
FROM h"""
