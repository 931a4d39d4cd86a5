import pytest
from llm_helpers import ODD, SF, docs_df, duck, with_clashes

from geotaxa.llm import raking


def test_query_equals_sql(spark):
    df = raking.op2_raking(spark, SF)
    cur = duck().execute(raking.oracle_sql())
    assert [c[0] for c in cur.description] == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(cur.fetchall())


def test_margins_meet_the_targets(spark):
    rows = [(i, "w " * (1 + i % 13), ["en", "de", "fr"][i % 3], ["big", "big", "big", "small"][i % 4]) for i in range(600)]
    targets = spark.createDataFrame([("source", "big", 1.0), ("source", "small", 1.0), ("lang", "en", 2.0), ("lang", "de", 1.0),
                                     ("lang", "fr", 1.0), ("topic", "short", 5.0)], "dimension string, value string, share double")
    out = raking.mix_sources(docs_df(spark, rows), targets, budget=2.0, rounds=12).collect()
    tokens = sum(r["n_tokens"] for r in out)
    assert tokens == sum(len(r[1].split()) for r in rows)
    for column, value, share in (("source", "big", 0.5), ("lang", "en", 0.5), ("lang", "de", 0.25), ("topic", "short", 1.0)):
        mass = sum(r["n_tokens"] * r["weight"] for r in out if r[column] == value)
        assert mass == pytest.approx(2 * tokens * share, rel=1e-3)
    drawn = sum(r["n_tokens"] * r["copies"] for r in out)
    assert drawn == pytest.approx(2 * tokens, rel=0.1)
    assert all(abs(r["copies"] - r["weight"]) < 1 for r in out)
    again = raking.mix_sources(docs_df(spark, rows), targets, budget=2.0, rounds=12).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_odd_rows(spark):
    df = with_clashes(docs_df(spark, [(*r, None, None) for r in ODD]))
    out = raking.mix_sources(df).collect()
    assert len(out) == len(ODD)
    assert {(r["source"], r["lang"]) for r in out} == {("(none)", "(none)")}
    assert {r["doc_id"]: r["n_tokens"] for r in out}[6] == 4000
    assert all(r["weight"] == 0 for r in out if r["topic"] == "(none)")      # no tokens, no weight
    assert raking.mix_sources(docs_df(spark, [])).count() == 0
    untargeted = spark.createDataFrame([("source", "nowhere", 1.0)], "dimension string, value string, share double")
    assert all(r["copies"] == 0 for r in raking.mix_sources(df, untargeted).collect())
