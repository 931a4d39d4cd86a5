"""Language ID by hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs.  A trigram binds its
letters' vectors, the first permuted twice and the second once (elementwise
product); a text bundles its distinct trigrams' vectors (sum), so a line
repeated a thousand times counts once.  A language's prototype bundles all its
training texts.  A text gets the language whose prototype has the largest
cosine with it; the score is that cosine, cut at 0.

Letters are lower-cased; runs of other characters count as one boundary.
Letters other than a-z share 37 hashed symbols.

Training sums are integers, added up per partition before the shuffle, so the
prototypes do not depend on the order of rows; one row per language and
dimension reaches the driver.  A language is a code from a short list: more
than ``MAX_LANGUAGES`` raise an error.

Defined cases: a null text or one without letters is ``und`` with score 0; a
row without a language is not learned from; equal cosines go to the first
language by name; with nothing to learn from every row is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotaxa.llm.text import Local, buffer_of, pieces, read_documents

DIMENSIONS = 1024
SYMBOLS = 64
TRIGRAMS = SYMBOLS ** 3
MAX_LANGUAGES = 2000
FULL = 400  # distinct trigrams from which on a cosine is asked in full
_ROWS = 256  # texts bundled at once


_table, _cache = Local(), Local()


def _symbols() -> np.ndarray:
    """Code point -> symbol; 0 is no letter."""
    if _table.value is None:
        table = np.zeros(0x110000, np.uint8)
        for cp in range(0x110000):
            if chr(cp).isalpha():
                low = ord(chr(cp).lower()[0])
                table[cp] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 16) % 37
        _table.value = table
    return _table.value


class _Vectors:
    """Trigram vectors, made when first met."""

    def __init__(self) -> None:
        base = np.random.default_rng(31).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
        self.parts = (np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base)
        self.at = np.full(TRIGRAMS, -1, np.int32)
        self.rows = np.zeros((0, DIMENSIONS), np.float32)

    def index(self, trigrams: np.ndarray) -> np.ndarray:
        fresh = np.unique(trigrams[self.at[trigrams] < 0])
        if len(fresh):
            a, b, c = fresh // SYMBOLS ** 2, fresh // SYMBOLS % SYMBOLS, fresh % SYMBOLS
            made = (self.parts[0][a] * self.parts[1][b] * self.parts[2][c]).astype(np.float32)
            self.at[fresh] = np.arange(len(self.rows), len(self.rows) + len(fresh))
            self.rows = np.concatenate([self.rows, made])
        return self.at[trigrams]


def _vectors() -> _Vectors:
    if _cache.value is None:
        _cache.value = _Vectors()
    return _cache.value


def trigrams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(trigram, row) over the letters of each text, with a boundary at both ends."""
    inner = (buf & 0xC0) == 0x80
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    starts = off - np.concatenate([[0], np.cumsum(inner)])[off]
    s = np.insert(_symbols()[points], np.repeat(starts[1:], 2), 0)  # two boundaries after each text
    ends = starts[1:] + 2 * np.arange(1, len(starts))
    s = np.concatenate([[0], s])
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] > 0) | (s[:-1] > 0)
    at = np.flatnonzero(keep)
    s = s[at].astype(np.int32)
    if len(s) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tri = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
    # The middle symbol is a letter, or the boundary between two words of one text.
    row = np.searchsorted(ends, at[1:-1], "right")
    same = (row == np.searchsorted(ends, at[2:] - 1, "right")) & (s[1:-1] + s[2:] > 0)
    first = np.searchsorted(ends, np.maximum(at[:-2], 0), "right")
    same &= (first == row) | (s[:-2] == 0)
    return tri[same].astype(np.int64), row[same]


def _present(index: np.ndarray, row: np.ndarray, lo: int, hi: int, width: int) -> np.ndarray:
    """(hi - lo, width): which of the trigrams each text has."""
    a, b = np.searchsorted(row, [lo, hi])
    out = np.zeros((hi - lo, width), np.float32)
    out[row[a:b] - lo, index[a:b]] = 1
    return out


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, prototypes of length 1) from all rows of (text, lang)."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums = _vectors(), {}
        for batch in batches:
            codes = batch.column("lang").dictionary_encode()
            names, which = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in pieces(*buffer_of(batch.column("text"))):
                tri, row = trigrams(buf, off)
                if not len(tri):
                    continue
                used, index = np.unique(vectors.index(tri), return_inverse=True)
                owner = which[lo:hi]
                for a in range(0, hi - lo, _ROWS):
                    b = min(hi - lo, a + _ROWS)
                    present = _present(index, row, a, b, len(used))
                    for k in np.unique(owner[a:b]):
                        own = present[owner[a:b] == k].sum(axis=0)
                        table = sums.setdefault(names[k], np.zeros(TRIGRAMS))
                        table[used] += own
        rows = []
        for name, own in sums.items():
            used = np.flatnonzero(own)  # numbers of the vectors this task has made
            rows.append((name, np.rint(own[used] @ vectors.rows[used].astype(np.float64)).astype(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                          pa.array([r[1] for r in rows], pa.list_(pa.int64()))], ["lang", "sums"])

    parts = docs.where(F.col("lang").isNotNull()).select("lang", F.coalesce("text", F.lit("")).alias("text")) \
        .mapInArrow(bundle, "lang string, sums array<long>")
    sums = parts.select("lang", F.posexplode("sums").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    rows = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v")) \
        .limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = sorted((r["lang"], [x["x"] for x in r["v"]]) for r in rows)
    rows = [(name, v) for name, v in rows if any(v)]
    prototypes = np.array([v for _, v in rows], np.float64).reshape(len(rows), DIMENSIONS)
    return [name for name, _ in rows], prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-300)


def classify(buf: np.ndarray, off: np.ndarray, prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the language or -1, cosine) of each text."""
    return judge(buf, off, prototypes)[:2]


def judge(buf: np.ndarray, off: np.ndarray, prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the language or -1, cosine, distinct trigrams) of each text."""
    n = len(off) - 1
    best, score, distinct = np.full(n, -1), np.zeros(n), np.zeros(n, np.int64)
    tri, row = trigrams(buf, off)
    if not len(tri) or not len(prototypes):
        return best, score, distinct
    vectors = _vectors()
    used, index = np.unique(vectors.index(tri), return_inverse=True)
    signs = vectors.rows[used]
    for lo in range(0, n, _ROWS):
        hi = min(n, lo + _ROWS)
        present = _present(index, row, lo, hi, len(used))
        distinct[lo:hi] = present.sum(axis=1)
        bundled = present @ signs
        length = np.linalg.norm(bundled, axis=1)
        full = np.flatnonzero(length > 0)
        cosines = (bundled[full].astype(np.float64) @ prototypes.T) / length[full, None]
        best[lo + full] = cosines.argmax(axis=1)
        score[lo + full] = np.clip(cosines.max(axis=1), 0.0, 1.0)
    return best, score, distinct


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray) -> DataFrame:
    """All columns of ``docs`` but text, then lang_pred and score."""
    names = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]
    schema = docs.select(*names).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, score = [], []
            for _, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                best, cosine = classify(buf, off, prototypes)
                label += [languages[k] if k >= 0 else "und" for k in best]
                score.append(cosine)
            own = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                own + [pa.array(label, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64())],
                [*names, "lang_pred", "score"])

    return docs.select(*names, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def keep_known(docs: DataFrame, languages: list[str], prototypes: np.ndarray, least: float) -> DataFrame:
    """The documents, with all their columns, that have a language by a cosine
    of at least ``least``.  The cosine of a text in its own language grows with
    the root of its n distinct trigrams, so below ``FULL`` of them
    ``least * sqrt(n / FULL)`` is asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for _, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                best, cosine, distinct = judge(buf, off, prototypes)
                keep.append((best >= 0) & (cosine >= least * np.sqrt(np.minimum(distinct / FULL, 1.0))))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)


def remainder(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string")) % n


def op3_hyper_language(spark, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "doc_id", "text", "lang")
    part = remainder(F.col("doc_id"), 4)
    languages, prototypes = learn(docs.where(part != 2))
    held = docs.select("doc_id", (part == 2).alias("held_out"), "text")
    return predict(held, languages, prototypes)
