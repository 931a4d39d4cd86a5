import corpus_pipeline as cp
import pytest
from llm_helpers import SF, docs_df, texts
from pyspark.sql import functions as F
from test_qgram_leaks import budget, distance, passages, plain
from test_secret_crf import brute as brute_secrets
from test_superminhash import brute as brute_groups

from geotaxa.session import materialize


def staged(spark, docs):
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), "stage"))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    return staged(spark, spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)))


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_each_stage_against_its_own_input(stages):
    start, known, single, clean, scrubbed, mixed = stages
    assert [df.columns for df in stages[1:5]] == [start.columns] * 4
    assert {r["doc_id"] for r in known.collect()} == {d for d, t in texts().items() if any(c.isalpha() for c in t)}
    docs = [(r["doc_id"], r["text"]) for r in known.collect()]
    assert ids(single) == sorted(d for d, (_, _, kept) in brute_groups(docs, 5, 80).items() if kept)

    import duckdb
    items = duckdb.execute(f"select text from '{SF}/benchmark.parquet'").fetchall()
    kept, whole = set(ids(clean)), {r["doc_id"]: r["text"] for r in single.collect()}
    for d, t in whole.items():
        if any(b in t for (b,) in items):
            assert d not in kept
    for d in sorted(set(whole) - kept)[:6]:
        body = plain(whole[d])
        assert any(distance(p, body) <= budget(p) for (b,) in items for p in passages(b)
                   if p[:40] in body or p[-40:] in body or p[40:80] in body)

    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in scrubbed.collect():
        assert not brute_secrets(r["text"]) and r["n_chars"] == len(r["text"])
        if not brute_secrets(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]
    assert ids(scrubbed) == ids(clean)

    assert mixed.columns == [*start.columns, "weight", "copies"]
    assert set(ids(mixed)) <= set(ids(scrubbed)) and mixed.where("copies < 1").count() == 0
    assert len(ids(mixed)) > 0.5 * len(ids(scrubbed))


def test_empty_and_odd_documents(spark):
    assert staged(spark, docs_df(spark, []))[-1].count() == 0
    odd = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "1 2 3", "en", None), (4, "plain words in a row here", "en", "a"),
           (5, "plain words in a row here", None, "b"), (None, "words without an id", "en", "a"), (7, "x" * 20000, "en", "a")]
    out = staged(spark, docs_df(spark, odd))
    assert sorted(r["doc_id"] or 0 for r in out[1].collect()) == [0, 4, 5, 7]
    assert sorted(r["doc_id"] or 0 for r in out[2].collect()) == [0, 4, 7]


def test_run_applies_the_stages(spark, stages):
    got = cp.run(spark, SF)
    assert sorted(map(str, got.select("doc_id", "weight", "copies").collect())) == sorted(
        map(str, stages[-1].select("doc_id", "weight", "copies").collect()))
