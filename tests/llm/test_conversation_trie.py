import hashlib
import random
import zlib

import duckdb
import pytest
from llm_helpers import SF
from pyspark.sql import functions as F

from geotaxa.llm import conversation_trie as ct


def conv_df(spark, rows):
    """rows: (conv_id, turn, role, text)."""
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def words(text):
    return len([w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w])


def brute(rows):
    """The trie as a dictionary of prefixes."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, sha), (role, text)))
    own = {c: tuple(t for _, t in sorted(v)) for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = own.get(base, ())[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids, out = {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p in sorted(members, key=len, reverse=True):
        below = out.setdefault(p, [0, 0])
        below[0] += 0 if p in kids else 1
        below[1] += (len(members[p]) - 1) * (words(p[-1][1]) if p else 0)
        if p:
            up = out.setdefault(p[:-1], [0, 0])
            up[0], up[1] = up[0] + below[0], up[1] + below[1]
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if rebuilt[c] == p)))
    return sorted(((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), kids.get(p, 0), out[p][0], out[p][1],
                    hashlib.sha256(ends(p).encode()).hexdigest()) for p in members), key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(rng, convs, turns, vocabulary):
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, turns)):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice("abc") for _ in range(rng.randrange(vocabulary)))))
    return rows


def test_query_equals_sql(spark):
    df = ct.op13_conversation_trie(spark, SF)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    cur = con.execute(ct.oracle_sql())
    assert [c[0] for c in cur.description] == df.columns
    assert rows_of(df) == sorted(cur.fetchall(), key=str)


@pytest.mark.parametrize("seed,vocabulary", [(1, 2), (2, 3), (3, 1)])
def test_random_tries_in_many_rounds(spark, seed, vocabulary):
    rng = random.Random(seed)
    rows = random_rows(rng, range(-60, 240), 7, vocabulary)
    df = conv_df(spark, rows).repartition(5)
    assert rows_of(ct.prefix_trie(df, size=2, slice_ids=3)) == brute(rows)


def test_hot_conversation_copies_and_long_shared_prefixes(spark):
    rng = random.Random(9)
    long = [("user", f"turn {i % 7} {i}") for i in range(700)]
    rows = [(1000, t, *x) for t, x in enumerate(long)]                                  # a third of all rows
    rows += [(1020, t, *x) for t, x in enumerate(long[:300] + [("user", "leaves here")] * 3)]
    rows += [(1040, t, *x) for t, x in enumerate(long[:64])] + [(1060, t, *x) for t, x in enumerate(long[:65])]
    rows += [(1080, t, *x) for t, x in enumerate(long[:128])] + [(1100, t, *x) for t, x in enumerate(long)]
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2300, 2) for t in range(4)]  # many copies
    rows += random_rows(rng, range(0, 100), 5, 2)
    df = conv_df(spark, rows).repartition(3)
    assert rows_of(ct.prefix_trie(df, size=3, slice_ids=16)) == brute(rows)


def test_defined_cases(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (1, 0, "", "x"), (1, 0, "", "x"), (2, 5, "user", "é 漢 word word"),
            (None, 0, "user", "left out"), (3, 0, "u", "ser"), (4, 0, "us", "er"), (25, 3, "a", "b"), (7, 1, "user", "word " * 50_000),
            (27, 0, "user", "w" * 3_000_000), (-5, 0, "user", "below zero")]
    df = conv_df(spark, rows)
    for name in ("pid", "conv", "k", "h", "token", "lo", "_group", "x"):
        df = df.withColumn(name, F.lit("clash"))
    assert rows_of(ct.prefix_trie(df)) == brute(rows)
    # Conversations that lose all their turns end at the root.
    assert any(r[1] == 0 and r[7] != ct.EMPTY_SHA for r in brute(rows))


def test_empty_and_single(spark):
    assert ct.prefix_trie(conv_df(spark, [])).count() == 0
    assert ct.prefix_trie(conv_df(spark, [(None, 1, "a", "b")])).count() == 0
    rows = [(20, 0, "user", "only one")]
    assert rows_of(ct.prefix_trie(conv_df(spark, rows))) == brute(rows)


def test_lcp():
    a, b = bytes(range(160)), bytes(range(160))
    assert ct.lcp(a, b) == 10 and ct.lcp(a, b"") == 0 and ct.lcp(a, b[:48]) == 3
    assert ct.lcp(a, b[:50] + b"!" + b[51:]) == 3
