import time
import zlib

import numpy as np
from llm_helpers import ODD, SF, docs_df, duck, rows_by_id, with_clashes

from geotaxa.llm import quality_net as qn


def test_held_out_labels_are_ranked(spark):
    got = rows_by_id(qn.op7_quality_net(spark, "/root/testdata/sf0.01"))
    labels = duck("/root/testdata/sf0.01").execute("select doc_id, quality from labels").fetchall()
    held = [(got[d]["score"], q) for d, q in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    s, y = np.array(held).T
    assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() > 0.95
    assert abs(s.mean() - y.mean()) < 0.08                     # calibrated
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


def test_word_vectors_equal_a_plain_loop(spark):
    text = ["the cat sat on the mat", "the CAT!! | 12.5 on", "one"]
    want = np.zeros((qn.UNITS, qn.PLACES))
    for t in text:
        raw = np.frombuffer(t.encode(), np.uint8)
        unit, _ = qn.units(raw, np.array([0, len(raw)]))
        for i, u in enumerate(unit):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(unit):
                    for p, s in zip(qn._PLACE[unit[j]], qn._SIGN[unit[j]]):
                        want[u, p] += s
    got = qn.word_vectors(docs_df(spark, list(enumerate(text))))
    length = np.linalg.norm(want, axis=1, keepdims=True)
    unit_want = want / np.maximum(length, 1)
    weight = np.sqrt(length)
    unit_want -= (unit_want * weight).sum(axis=0) / weight.sum()
    unit_want /= np.maximum(np.linalg.norm(unit_want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(got, unit_want, atol=1e-5)


def test_odd_rows(spark):
    df = with_clashes(docs_df(spark, ODD))
    vectors = qn.word_vectors(df)
    labels = spark.createDataFrame([(4, 0), (6, 1), (6, 0), (7, 1), (None, 1), (5, None), (99, 1)], "doc_id long, quality int")
    net = qn.fit(df, labels, vectors)
    rows = qn.score_quality(df.select("doc_id", "text", "kept"), net, vectors).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    empty = [r["score"] for r in rows if r["doc_id"] in (1, 2, 3)]
    assert len(set(empty)) == 1
    none = qn.fit(df, labels.limit(0), vectors)
    assert {r["score"] for r in qn.score_quality(df.select("doc_id", "text"), none, vectors).collect()} == {0.5}
    one_kind = qn.fit(df, spark.createDataFrame([(4, 1)], "doc_id long, quality int"), vectors)
    assert one_kind.constant == 1.0
    assert qn.score_quality(docs_df(spark, []).select("doc_id", "text"), net, vectors).count() == 0


def test_pooling_does_not_depend_on_the_batch():
    texts = ["a b c", "", "Hello, WORLD!! | x", "a b c"]
    raw = [t.encode() for t in texts]
    vectors = np.random.default_rng(1).normal(size=(qn.UNITS, qn.PLACES)).astype(np.float32)
    together = qn.pooled(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]), vectors)
    alone = np.concatenate([qn.pooled(np.frombuffer(r, np.uint8), np.array([0, len(r)]), vectors) for r in raw])
    assert np.allclose(together, alone, atol=1e-5) and np.allclose(together[0], together[3])


def test_pooling_sums_numbers_that_lie_side_by_side():
    """Sums over strided columns took most of the time of a score; the results are theirs to the bit."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(3000)]
    raw = [" ".join(rng.choice(words, size)).encode() for size in (0, 1, 7, 40, 129, 300, 900) * 60]
    buf, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    vectors = rng.normal(size=(qn.UNITS, qn.PLACES)).astype(np.float32)
    unit, row = qn.units(buf, off)
    full, begin = np.unique(row, return_index=True)
    size = np.diff(np.append(begin, len(row)))[:, None]

    def strided():
        own = vectors[unit]
        mean = np.add.reduceat(own, begin, axis=0) / size
        return mean, np.sqrt(np.maximum(np.add.reduceat(own * own, begin, axis=0) / size - mean * mean, 0))

    def seconds(run):
        begun = time.process_time()
        run()
        return time.process_time() - begun

    got = qn.pooled(buf, off, vectors)
    mean, spread = strided()
    assert (got[full, :qn.PLACES] == mean.astype(np.float32)).all()
    assert (got[full, qn.PLACES:2 * qn.PLACES] == spread.astype(np.float32)).all()
    assert min(seconds(lambda: qn.pooled(buf, off, vectors)) for _ in range(3)) < min(seconds(strided) for _ in range(3))
