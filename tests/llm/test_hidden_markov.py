import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from llm_helpers import ODD, SF, docs_df, rows_by_id, texts, with_clashes
from pyspark.sql import functions as F

from geotaxa.llm import hidden_markov as hm


def brute_base(docs, learned):
    c = collections.Counter(w for d, t in docs if learned(d) for w in t.encode().lower().split())
    ends = sum(1 for d, _ in docs if learned(d))
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    size = math.log10(n + 0.1 * (v + 1))
    out = {}
    for d, t in docs:
        w = t.encode().lower().split()
        score = sum(math.log10(c[x] + 0.1) - size for x in w) + math.log10(ends + 0.1) - size
        out[d] = (len(w) + 1, sum(c[x] > 0 for x in w) + (ends > 0), n, score)
    return out


@pytest.mark.parametrize("lookup", [300_000, 500])
def test_base_equals_brute_force_and_the_model_beats_it(spark, monkeypatch, lookup):
    monkeypatch.setattr(hm, "LOOKUP", lookup)      # 500: most words are joined
    docs = list(texts().items())
    got = rows_by_id(hm.op5_hidden_markov(spark, SF))
    want = brute_base(docs, lambda d: zlib.crc32(str(d).encode()) % 10 != 0)
    assert set(got) == set(want)
    for d, (n, known, train, score) in want.items():
        r = got[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
    held = [r for r in got.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > 0.97 * sum(r["base_score"] for r in held)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def small_model(seed=1):
    rng = np.random.default_rng(seed)
    rows = lambda *shape: (lambda a: a / a.sum(axis=-1, keepdims=True))(rng.random(shape))
    return hm.Model(rows(hm.STATES), rows(hm.STATES, hm.STATES), rows(hm.STATES, hm.SYMBOLS).T)


def brute_paths(model, seq):
    total, start, moves, emit = 0.0, np.zeros(hm.STATES), np.zeros((hm.STATES, hm.STATES)), np.zeros((hm.SYMBOLS, hm.STATES))
    found = []
    for path in itertools.product(range(hm.STATES), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for a, b, s in zip(path, path[1:], seq[1:]):
            p *= model.moves[a, b] * model.emit[s, b]
        total += p
        found.append((path, p))
    for path, p in found:
        start[path[0]] += p / total
        for a, b in zip(path, path[1:]):
            moves[a, b] += p / total
        for s, x in zip(seq, path):
            emit[s, x] += p / total
    return total, np.concatenate([start, moves.ravel(), emit.ravel()])


def test_forward_and_counts_equal_a_sum_over_all_paths():
    model = small_model()
    seqs = [[3, 5, 3], [hm.END], [7, 7, 9, hm.END], [1, hm.END]]
    symbols, size = np.array([s for q in seqs for s in q]), np.array([len(q) for q in seqs])
    want = [brute_paths(model, q) for q in seqs]
    assert np.allclose(hm.log10_likelihood(model, symbols, size), [math.log10(t) for t, _ in want])
    assert np.allclose(hm.expected_counts(model, symbols, size), sum(c for _, c in want))


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(4)
    symbols = np.concatenate([rng.integers(0, 20, 60) if k % 2 else rng.integers(20, 40, 60) for k in range(40)])
    size = np.full(40, 60)
    shares = np.bincount(symbols, minlength=hm.SYMBOLS) + 0.5
    shares = shares / shares.sum()
    model, last = small_model(), -np.inf
    for _ in range(6):
        now = hm.log10_likelihood(model, symbols, size).sum()
        assert now > last
        last, model = now, hm.Model.of(hm.expected_counts(model, symbols, size), shares)
    assert hm._stretches(symbols, np.array([600, 1, hm.STRETCH])).tolist() == [256, 256, 88, 1, 256]


def test_odd_rows(spark):
    df = with_clashes(docs_df(spark, ODD)).withColumn("held_out", F.col("doc_id") == 4)
    rows = hm.score_texts(df).collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_tokens"] == 1 and by_id[6]["n_tokens"] == 4001
    assert by_id[4]["n_known"] == 1           # only the end
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert sum(r["doc_id"] == 7 for r in rows) == 2
    nothing = hm.score_texts(docs_df(spark, ODD).withColumn("held_out", F.lit(True))).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in nothing)
    assert all(r["base_score"] == pytest.approx(0) for r in nothing)
    assert hm.score_texts(docs_df(spark, []).withColumn("held_out", F.lit(False))).count() == 0


def test_a_corpus_of_long_texts_is_learned(spark, monkeypatch):
    monkeypatch.setattr(hm, "START_TOKENS", 4)      # every text is longer
    docs = [(d, t) for d, t in texts().items() if len(t) > 100]
    df = docs_df(spark, docs).withColumn("held_out", F.col("doc_id") % 10 == 0)
    held = [r for r in hm.score_texts(df).collect() if r["doc_id"] % 10 == 0]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    # no doc_id is drawn as a start: the passes still run over all texts
    monkeypatch.setattr(hm, "hash_share", lambda wanted, available: F.lit(False))
    none = [r for r in hm.score_texts(df).collect() if r["doc_id"] % 10 == 0]
    assert sum(r["score"] for r in none) > 1.02 * sum(r["base_score"] for r in none)


def test_start_stretches_lie_anywhere_in_their_texts(spark, monkeypatch):
    monkeypatch.setattr(hm, "START_TOKENS", 50)
    texts_ = [np.arange(k, k + n, dtype=np.int16) for k, n in [(i, 1000 + i) for i in range(40)] + [(3000, 50), (3500, 7), (4000, 1)]]
    coded = spark.createDataFrame([(bytearray(t.tobytes()), True) for t in texts_] + [(bytearray(b"xx"), False)],
                                  "symbols binary, drawn boolean")
    symbols, size = hm.start_stretches(coded)
    parts = np.split(symbols, np.cumsum(size)[:-1])
    assert sorted(size.tolist()) == [1, 7] + [50] * 41 and all((np.diff(p) == 1).all() for p in parts)
    starts = sorted(int(p[0]) for p in parts if p[0] < 2900)
    assert starts[5] < 400 and starts[-6] > 600       # not beginnings only
    assert hm.start_stretches(coded.limit(0))[1].size == 0
    model, rng = small_model(), np.random.default_rng(5)
    long, sizes = rng.integers(0, 50, 1300), np.array([700, 600])
    assert np.allclose(hm._start_counts(model, long, sizes), hm.expected_counts(model, long, hm._stretches(long, sizes)))


def test_the_lookup_changes_no_score(spark, monkeypatch):
    words = [f"w{i:03d}" for i in range(200)]          # all of one count
    docs = [(k, " ".join(words[(k * 7 + j * 3) % 200] for j in range(200))) for k in range(1, 12)]
    df = docs_df(spark, docs + [(20, "w001 w002 never seen")]).withColumn("held_out", F.col("doc_id") > 10)
    monkeypatch.setattr(hm, "VOCABULARY", 64)
    monkeypatch.setattr(hm, "END", 64 + hm.CLASSES)
    monkeypatch.setattr(hm, "SYMBOLS", 65 + hm.CLASSES)
    got = []
    for lookup in (300_000, 150, 1):
        monkeypatch.setattr(hm, "LOOKUP", lookup)
        got.append({r["doc_id"]: (r["score"], r["base_score"], r["n_known"]) for r in hm.score_texts(df).collect()})
    assert all(got[0][d] == pytest.approx(g[d], rel=1e-9) for g in got for d in got[0]) and got[0][20][2] == 3


def test_rows_without_an_id_are_not_learned(spark, tmp_path):
    docs_df(spark, [(1, "a b"), (2, "a c"), (None, "only here")]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = hm.op5_hidden_markov(spark, str(tmp_path)).collect()
    none = next(r for r in rows if r["doc_id"] is None)
    assert len(rows) == 3 and none["held_out"] is None and none["n_known"] == 1 and none["n_tokens"] == 3
