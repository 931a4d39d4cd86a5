"""Quality classifier: random-indexing word vectors and a two-layer network.

*Units.*  A white-space token that is letters with at most one closing mark
is a word and is hashed (lower-cased) to one of 6,144 units; any other token
is hashed by its shape (symbols at its ends, digits, capitals, length) to one
of 2,048.  No vocabulary is cut off: every token has a unit.

*Random indexing.*  Each unit has a sparse random index vector (4 signs in 64
places); a unit's word vector is the sum of the index vectors of its
neighbours (two on either side, same text) over the whole corpus.  Integer
sums per partition are added up in Spark; 8,192 x 64 numbers reach the driver.

*Pooling.*  A document is the mean and spread of its tokens' word vectors,
the share of shape units, the share of distinct units and its log length.

*Network.*  tanh layer and logistic output, trained with Adam on about
``train_rows`` labelled documents (by a hash of the doc_id, twice as many is
the bound), of which a fifth only sets the temperature that calibrates the
probabilities.

Defined cases: a null text is empty; an empty text pools to zeros and is
scored like any other; rows without a label are not learned from, a doc_id
labelled twice counts with its largest label; without labels of both kinds
every score is the share of ones (0.5 if none).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotaxa.llm.hyper_language import remainder
from geotaxa.llm.text import LOWER, Spans, buffer_of, hash_sample, mix, pieces, read_documents, word_spans

WORD_UNITS, SHAPE_UNITS = 6144, 2048
UNITS = WORD_UNITS + SHAPE_UNITS
PLACES, SIGNS = 64, 4
FEATURES = 2 * PLACES + 3

_rng = np.random.default_rng(404)
_PLACE = np.array([_rng.choice(PLACES, SIGNS, replace=False) for _ in range(UNITS)])
_SIGN = _rng.choice(np.array([-1.0, 1.0]), (UNITS, SIGNS))
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:?!"]] = True
# Letters, digits, capitals: 20 bits each, summed at once.
_CLASS = (_LETTER.astype(np.uint64) | np.zeros(256, np.uint64))
_CLASS[0x30:0x3A] += np.uint64(1 << 20)
_CLASS[0x41:0x5B] += np.uint64(1 << 40)


def units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, row) of every token."""
    s, e, row = word_spans(buf, off)
    if not len(s):
        return s, row
    counts = np.add.reduceat(_CLASS[buf], s)
    letters, digits, capitals = ((counts >> np.uint64(20 * k)).astype(np.int64) & 0xFFFFF for k in range(3))
    first, last, size = buf[s], buf[e - 1], e - s
    plain = (letters == size) | ((letters == size - 1) & _MARK[last])
    plain &= (capitals <= 1) | (capitals * 2 < letters)
    end = np.where(plain & ~_LETTER[last], e - 1, e)
    word = (Spans(LOWER[buf]).hash(s, end) % np.uint64(WORD_UNITS)).astype(np.int64)
    mark = lambda b: np.where(_LETTER[b], 0, b).astype(np.uint64)
    before = np.where(size > 1, buf[np.maximum(e - 2, s)], 0)
    shape = mark(first) | mark(last) << np.uint64(8) | mark(before) << np.uint64(16)
    shape |= (digits > 0).astype(np.uint64) << np.uint64(24) | (capitals > 1).astype(np.uint64) << np.uint64(25)
    shape |= (letters > 0).astype(np.uint64) << np.uint64(26) | np.digitize(size, [2, 4, 8, 16, 32]).astype(np.uint64) << np.uint64(27)
    return np.where(plain, word, WORD_UNITS + (mix(shape) % np.uint64(SHAPE_UNITS)).astype(np.int64)), row


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Context sums of all units over all texts, centred and of length 1."""
    names = [f"v{k}" for k in range(PLACES)]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(UNITS * PLACES)
        for batch in batches:
            for _, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                unit, row = units(buf, off)
                for gap in (1, 2):
                    same = row[gap:] == row[:-gap]
                    a, b = unit[gap:][same], unit[:-gap][same]
                    for x, y in ((a, b), (b, a)):
                        for k in range(SIGNS):
                            sums += np.bincount(x * PLACES + _PLACE[y, k], _SIGN[y, k], UNITS * PLACES)
        table = np.rint(sums).astype(np.int64).reshape(UNITS, PLACES)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *[pa.array(c) for c in table[used].T]], ["unit", *names])

    parts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        contexts, "unit long, " + ", ".join(f"{n} long" for n in names))
    rows = parts.groupBy("unit").agg(*[F.sum(n).alias(n) for n in names]).collect()
    table = np.zeros((UNITS, PLACES))
    for r in rows:
        table[r[0]] = r[1:]
    length = np.linalg.norm(table, axis=1, keepdims=True)
    table /= np.maximum(length, 1)
    weight = np.sqrt(length)
    if weight.sum():
        table -= (table * weight).sum(axis=0) / weight.sum()
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(buf: np.ndarray, off: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    out = np.zeros((n, FEATURES), np.float32)
    unit, row = units(buf, off)
    if not len(unit):
        return out
    size = np.bincount(row, minlength=n)
    full = np.flatnonzero(size)
    begin = np.searchsorted(row, full)
    # One row a place, so that every text's numbers lie side by side for the sums.
    own = np.take(np.ascontiguousarray(vectors.T), unit, axis=1)
    mean = np.add.reduceat(own, begin, axis=1) / size[full]
    square = np.add.reduceat(np.square(own, out=own), begin, axis=1) / size[full]
    out[full, :PLACES] = mean.T
    out[full, PLACES:2 * PLACES] = np.sqrt(np.maximum(square - mean * mean, 0)).T
    out[full, -3] = np.bincount(row, unit >= WORD_UNITS, n)[full] / size[full]
    pairs = np.unique(row * UNITS + unit)
    out[full, -2] = np.bincount(pairs // UNITS, minlength=n)[full] / size[full]
    out[full, -1] = np.log1p(size[full])
    return out


class Net:
    """Two layers over standardised features; ``temperature`` divides the logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 24, steps: int = 400):
        self.constant = None
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        rng = np.random.default_rng(9)
        order = rng.permutation(len(y))
        held, own = np.split(order, [len(y) // 5])
        if len(np.unique(y[own])) < 2 or not len(held):
            own = held = order
        self.mean, self.scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-3
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        moments = [(np.zeros_like(a), np.zeros_like(a)) for a in p]
        xs, ys = (x[own] - self.mean) / self.scale, y[own]
        for step in range(1, steps + 1):
            h = np.tanh(xs @ p[0] + p[1])
            gap = (1 / (1 + np.exp(-(h @ p[2] + p[3][0]))) - ys) / len(ys)
            dh = gap[:, None] * p[2] * (1 - h * h)
            grads = [xs.T @ dh + 1e-3 * p[0], dh.sum(axis=0), h.T @ gap + 1e-3 * p[2], np.array([gap.sum()])]
            for a, g, (m, v) in zip(p, grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                a -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        self.layers, self.temperature = p, 1.0
        z, t = self.logit(x[held]), y[held]
        options = np.geomspace(0.3, 8, 40)
        self.temperature = float(min(options, key=lambda k: np.logaddexp(0, np.where(t > 0, -z, z) / k).mean()))

    def logit(self, x: np.ndarray) -> np.ndarray:
        p = self.layers
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ p[0] + p[1])
        return (h @ p[2] + p[3][0]) / self.temperature

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _map(docs: DataFrame, names: list[str], value: Callable, kind: T.DataType, arrow: pa.DataType) -> DataFrame:
    """``names`` of ``docs`` and one value per text, from ``value(buf, off)``."""
    schema = docs.select(*names).schema.add("value", kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for _, _, buf, off in pieces(*buffer_of(batch.column("text"))) for x in value(buf, off)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found, arrow)], [*names, "value"])

    return docs.select(*names, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, train_rows: int = 8000) -> Net:
    """Train on about ``train_rows`` of ``labels`` (doc_id, quality)."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = hash_sample(known, train_rows, known.count())
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    found = _map(rows, ["doc_id", "quality"], lambda b, o: list(pooled(b, o, vectors)), T.ArrayType(T.FloatType()),
                 pa.list_(pa.float32())).collect()
    found.sort(key=lambda r: (r["doc_id"], r["value"]))
    x = np.array([r["value"] for r in found], np.float64).reshape(len(found), FEATURES)
    return Net(x, np.array([float(r["quality"] > 0) for r in found]))


def score_quality(docs: DataFrame, net: Net, vectors: np.ndarray) -> DataFrame:
    """All columns of ``docs`` but text, then score."""
    names = [c for c in docs.columns if c not in ("text", "score", "value")]
    return _map(docs, names, lambda b, o: net.score(pooled(b, o, vectors).astype(np.float64)), T.DoubleType(),
                pa.float64()).withColumnRenamed("value", "score")


def op7_quality_net(spark, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    vectors = word_vectors(docs)
    net = fit(docs, labels.where(remainder(F.col("doc_id"), 5) != 0), vectors)
    held = docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    scored = score_quality(held, net, vectors)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
