"""LM scoring with a hidden Markov model.

*Tokens* are runs without ASCII white space, A-Z lower-cased, then one end
token a text.  All counts are over every training text.

*Symbols.*  The ``VOCABULARY`` most frequent words (of equal counts those with
the smallest hashes) are symbols of their own; any other word is one of ``CLASSES`` symbols by its last three bytes, times its
share of that class, ``(c + 0.1) / (N_class + 0.1 (V_class + 1))``; the end is
a symbol.  Together they give every text a probability.

*Training.*  Baum-Welch: each pass adds up the expected counts of all training
tokens, in every partition over stretches of at most ``STRETCH`` tokens, and
Spark sums those (as integers, so in any order); ``STATES`` x symbols numbers
reach the driver.  The first parameters come from a few passes over one stretch
of at most ``START_TOKENS`` tokens, at a place drawn by a hash, of each of
about ``START_TEXTS`` training texts; if the sample is empty, from the symbols'
shares with noise.

*Scoring.*  Scaled forward recursion over the whole text gives its exact
likelihood.  The counts of the vocabulary and of about ``LOOKUP`` further
frequent words go to every task; those of all others are joined by the word's
64-bit hash, with the same result.

Defined cases: a null text is empty and has one token, the end; rows that
repeat a doc_id are scored each; a row without a doc_id is scored, but neither
learned from nor marked (its ``held_out`` is null); without training texts the base score is 0
and the model's symbols are equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.llm.hyper_language import remainder
from geotaxa.llm.text import LOWER, Spans, buffer_of, hash_share, pieces, read_documents, word_spans
from geotaxa.session import materialize

STATES, VOCABULARY, CLASSES = 8, 4096, 256
END = VOCABULARY + CLASSES
SYMBOLS = END + 1
LOOKUP = 300_000
STRETCH = 256
START_TEXTS, START_TOKENS = 600, 2048
_SCALE = float(1 << 20)
_FLUSH = 3_000_000
_PART = 400_000


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, row) of every word."""
    low = LOWER[buf]
    s, e, row = word_spans(low, off)
    if not len(s):
        return np.zeros(0, np.int64), s, row
    spans = Spans(low)
    tail = spans.hash(np.maximum(s, e - 3), e) % np.uint64(CLASSES)
    return spans.hash(s, e).view(np.int64), tail.astype(np.int64), row


class Lookup:
    """Counts of frequent words: sorted hashes, counts, and the symbol or -1."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        symbol = np.where(np.arange(len(hashes)) < VOCABULARY, np.arange(len(hashes)), -1)
        self.symbols = symbol[order].astype(np.int16)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count or -1, symbol or -1)."""
        if not len(self.hashes):
            return np.full(len(h), -1), np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = self.hashes[at] == h
        return np.where(hit, self.counts[at], -1), np.where(hit, self.symbols[at], -1)


class Model:
    """start (K), moves (K, K), emit (SYMBOLS, K)."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, emit: np.ndarray):
        self.start, self.moves, self.emit = start, moves, emit

    @staticmethod
    def flat() -> Model:
        return Model(np.full(STATES, 1 / STATES), np.full((STATES, STATES), 1 / STATES), np.full((SYMBOLS, STATES), 1 / SYMBOLS))

    @staticmethod
    def of(counts: np.ndarray, shares: np.ndarray) -> Model:
        """From expected counts; ``shares`` of the symbols smooth the emissions."""
        start, moves, emit = np.split(counts, [STATES, STATES + STATES ** 2])
        moves = moves.reshape(STATES, STATES) + 0.1
        emit = emit.reshape(SYMBOLS, STATES) + 5.0 * shares[:, None]
        start = start + 0.1
        return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


class _Grid:
    """Sequences by step: at step t the first ``live[t]`` (longest first) have a token."""

    def __init__(self, symbols: np.ndarray, size: np.ndarray):
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        self.order = np.argsort(-size, kind="stable")
        self.size, begin = size[self.order], begin[self.order]
        steps = int(self.size[0]) if len(size) else 0
        self.live = np.searchsorted(-self.size, -np.arange(steps), "left")
        self.begin = np.concatenate([[0], np.cumsum(self.live)]).astype(np.int64)
        step = np.repeat(np.arange(steps), self.live)
        place = np.arange(len(symbols)) - self.begin[step]
        self.symbols = symbols[begin[place] + step]

    def slots(self, t: int) -> slice:
        return slice(self.begin[t], self.begin[t + 1])


def log10_likelihood(model: Model, symbols: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each sequence (whole; every one has at least one symbol)."""
    grid = _Grid(symbols, size)
    emit = model.emit[grid.symbols]
    total = np.zeros(len(symbols))
    alpha = np.zeros((0, STATES))
    for t in range(len(grid.live)):
        own = grid.slots(t)
        n = grid.live[t]
        alpha = (model.start if t == 0 else alpha[:n] @ model.moves) * emit[own]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[own] = scale
    place = np.arange(len(symbols)) - np.repeat(grid.begin[:-1], grid.live)
    out = np.zeros(len(size))
    out[grid.order] = np.bincount(place, np.log10(total), len(size))
    return out


def expected_counts(model: Model, symbols: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Baum-Welch counts of all sequences, flat: start, moves, emissions."""
    grid = _Grid(symbols, size)
    steps = len(grid.live)
    emit = model.emit[grid.symbols]
    alpha, scale = np.empty_like(emit), np.empty(len(symbols))
    for t in range(steps):
        own = grid.slots(t)
        a = (model.start if t == 0 else alpha[grid.slots(t - 1)][:grid.live[t]] @ model.moves) * emit[own]
        scale[own] = c = a.sum(axis=1)
        alpha[own] = a / c[:, None]
    moves = np.zeros((STATES, STATES))
    beta = np.ones((grid.live[-1] if steps else 0, STATES))
    gamma = np.empty_like(emit)
    for t in range(steps - 1, -1, -1):
        own, n = grid.slots(t), grid.live[t]
        if len(beta) < n:
            beta = np.concatenate([beta, np.ones((n - len(beta), STATES))])
        gamma[own] = alpha[own] * beta
        if t:
            after = emit[own] * beta / scale[own, None]
            moves += alpha[grid.slots(t - 1)][:n].T @ after
            beta = after @ model.moves.T
    moves *= model.moves
    out = [gamma[grid.slots(0)].sum(axis=0) if steps else np.zeros(STATES), moves.ravel()]
    emitted = np.stack([np.bincount(grid.symbols, gamma[:, k], SYMBOLS) for k in range(STATES)], axis=1)
    return np.concatenate([*out, emitted.ravel()])


def _stretches(symbols: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sizes of the stretches that the sequences are cut into."""
    parts = -(-size // STRETCH)
    cut = np.full(int(parts.sum()), STRETCH)
    last = np.cumsum(parts) - 1
    cut[last] = size - (parts - 1) * STRETCH
    return cut


def _start_counts(model: Model, symbols: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Expected counts over the stretches of the sequences, some at a time."""
    cut = _stretches(symbols, size)
    ends = np.concatenate([[0], np.cumsum(cut)])
    sums, lo = np.zeros(STATES + STATES ** 2 + SYMBOLS * STATES), 0
    while lo < len(cut):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + _PART, "right")) - 1)
        sums += expected_counts(model, symbols[ends[lo]:ends[hi]], cut[lo:hi])
        lo = hi
    return sums


def sequences(lookup: Lookup, buf: np.ndarray, off: np.ndarray):
    """Symbols of all texts, each with its end, their sizes, and the word arrays."""
    h, kind, row = tokens(buf, off)
    count, symbol = lookup.find(h)
    symbol = np.where(symbol >= 0, symbol, VOCABULARY + kind)
    n = len(off) - 1
    size = np.bincount(row, minlength=n) + 1
    out = np.full(len(h) + n, END)
    out[np.arange(len(h)) + row] = symbol
    return out, size, h, kind, row, count, symbol


def start_stretches(coded: DataFrame, wanted: int = 2 * START_TEXTS) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and sizes of one stretch of each drawn text of (symbols, drawn)."""
    size = F.length("symbols") / 2
    spare = F.greatest(size.cast("int") - START_TOKENS, F.lit(0))
    at = F.pmod(F.xxhash64("symbols"), (spare + 1).cast("long")).cast("int")
    rows = coded.where("drawn").select(F.substring("symbols", 2 * at + 1, F.lit(2 * START_TOKENS)).alias("s"))
    # The bound binds only where one drawn doc_id has very many rows.
    blobs = [bytes(r["s"]) for r in rows.orderBy(F.xxhash64("s"), "s").limit(wanted).collect()]
    found = [np.frombuffer(b, np.int16).astype(np.int64) for b in blobs]
    return np.concatenate(found) if found else np.zeros(0, np.int64), np.array([len(x) for x in found], np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """(hash, kind, c) of every word in ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            h, kind = (np.concatenate([x[k] for x in held]) if held else np.zeros(0, np.int64) for k in (0, 1))
            c = np.concatenate([x[2] for x in held]) if held else np.zeros(0, np.int64)
            value, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(value), pa.array(kind[first]), pa.array(
                np.bincount(inverse, c, len(value)).astype(np.int64))], ["hash", "kind", "c"])

        for batch in batches:
            for _, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                h, kind, _ = tokens(buf, off)
                value, first, c = np.unique(h, return_index=True, return_counts=True)
                held.append((value, kind[first], c))
                n += len(value)
                if n > _FLUSH:
                    yield flush()
                    held, n = [], 0
        yield flush()

    return docs.select("text").mapInArrow(run, "hash long, kind long, c long").groupBy("hash").agg(
        F.min("kind").alias("kind"), F.sum("c").alias("c"))


def train(sequence_table: DataFrame, start: np.ndarray | None, start_sizes: np.ndarray | None, shares: np.ndarray,
          passes: int = 4, start_passes: int = 15) -> Model:
    """``passes`` over all of ``sequence_table`` (symbols: binary of int16);
    ``start`` is None without training texts and may be empty with them."""
    rng = np.random.default_rng(12)
    total = STATES + STATES ** 2 + SYMBOLS * STATES
    if start is None:
        return Model.flat()
    noisy = shares[:, None] * rng.gamma(1.0, size=(SYMBOLS, STATES)) * (len(start) or SYMBOLS) / STATES
    model = Model.of(np.concatenate([np.ones(STATES), (np.eye(STATES) * 20 + 1).ravel(), noisy.ravel()]), shares)
    for _ in range(start_passes if len(start) else 0):
        model = Model.of(_start_counts(model, start, start_sizes), shares)

    def counted(model: Model):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(total)
            for batch in batches:
                blobs = [np.frombuffer(b, np.int16) for b in batch.column("symbols").to_pylist()]
                at = 0
                while at < len(blobs):
                    to, n = at, 0
                    while to < len(blobs) and n < _PART:
                        n += len(blobs[to])
                        to += 1
                    symbols = np.concatenate(blobs[at:to]).astype(np.int64)
                    size = np.array([len(b) for b in blobs[at:to]])
                    sums += expected_counts(model, symbols, _stretches(symbols, size))
                    at = to
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.rint(sums[used] * _SCALE).astype(np.int64))], ["k", "x"])
        return run

    for _ in range(passes):
        rows = sequence_table.mapInArrow(counted(model), "k long, x long").groupBy("k").agg(F.sum("x").alias("x")).toArrow()
        sums = np.zeros(total)
        sums[rows.column("k").to_numpy()] = rows.column("x").to_numpy() / _SCALE
        model = Model.of(sums, shares)
    return model


def score_texts(docs: DataFrame, held_out: str = "held_out") -> DataFrame:
    """Learn from the rows of (doc_id, text, held_out) that are not held out
    and score all: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"))
    learned = docs.where("not held_out")
    counts = materialize(count_words(learned), "words")
    texts = learned.count()
    # Words by the size of their count, in sixteenths of a doubling: the least
    # size that the vocabulary reaches into, and as many of the largest sizes
    # as the lookup holds.
    size = F.floor(F.log2("c") * 16)
    least, reached, held = 1 << 20, 0, 0
    for r in counts.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():
        reached = r["size"] if held < VOCABULARY else reached
        held += r["count"]
        if held <= LOOKUP:
            least = r["size"]
        elif held - r["count"] >= VOCABULARY:
            break

    def columns(words: DataFrame) -> np.ndarray:
        table = words.select("hash", "c", "kind").toArrow()
        found = np.stack([table.column(c).to_numpy() for c in ("hash", "c", "kind")]) if table.num_rows else np.zeros((3, 0), np.int64)
        return found[:, np.lexsort((found[0], -found[1]))]

    own = columns(counts.where(size >= reached).orderBy(F.desc("c"), "hash").limit(VOCABULARY))
    more = columns(counts.where(size >= least))
    more = more[:, ~np.isin(more[0], own[0])]
    hashes, top_counts, top_kinds = np.concatenate([own, more], axis=1)
    lookup = Lookup(hashes, top_counts)
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("kind").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        class_n[r["kind"]], class_v[r["kind"]] = r["n"], r["v"]
    words, distinct = int(class_n.sum()), int(class_v.sum())
    n_train = words + texts
    base_size = n_train + 0.1 * (distinct + (texts > 0) + 1)
    # Words with a symbol of their own are not in the classes.
    class_n -= np.bincount(top_kinds[:VOCABULARY], top_counts[:VOCABULARY], CLASSES)
    class_v -= np.bincount(top_kinds[:VOCABULARY], minlength=CLASSES)
    class_size = class_n + 0.1 * (class_v + 1)
    shares = np.zeros(SYMBOLS)
    shares[:min(VOCABULARY, len(hashes))] = top_counts[:VOCABULARY]
    shares[VOCABULARY:END], shares[END] = class_n, texts
    shares = (shares + 0.5) / (shares + 0.5).sum()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                symbols, size, *_ = sequences(lookup, buf, off)
                ends = np.cumsum(size)
                out += [x.tobytes() for x in np.split(symbols.astype(np.int16), ends[:-1])] if len(size) else []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column("drawn")], ["symbols", "drawn"])

    drawn = F.coalesce(hash_share(START_TEXTS, texts), F.lit(False)).alias("drawn")
    coded = materialize(learned.select("text", drawn).mapInArrow(encode, "symbols binary, drawn boolean"), "symbols")
    first, sizes = start_stretches(coded) if texts else (None, None)
    model = train(coded.select("symbols"), first, sizes, shares)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text, and one per text and word that needs a joined count."""
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in pieces(*buffer_of(batch.column("text"))):
                n = hi - lo
                symbols, size, h, kind, row, count, symbol = sequences(lookup, buf, off)
                total = log10_likelihood(model, symbols, size)
                seen = count >= 0
                logs = np.log10(np.maximum(count, 0) + 0.1)
                base = np.bincount(row[seen], logs[seen], n) - size * np.log10(base_size) + np.log10(texts + 0.1)
                rare = seen & (symbol >= VOCABULARY)
                total += np.bincount(row[rare], (logs - np.log10(class_size)[kind])[rare], n)
                known = np.bincount(row[seen], minlength=n) + (texts > 0)
                key = np.stack([row[~seen], h[~seen]])
                pair, first_at, m = np.unique(key, axis=1, return_index=True, return_counts=True) if key.size else (key, key[0], key[0])
                # The class part of the words to join is known here, their counts are not.
                total -= np.bincount(row[~seen], np.log10(class_size)[kind[~seen]], n)
                own = number + np.arange(n)
                number += n
                none = np.zeros(len(m), np.int64)
                cells = [(np.arange(n), pair[0]), (own, own[pair[0]] if len(m) else none), (np.zeros(n, np.int64), m),
                         (own, pair[1]), (size, none), (known, none), (base, none), (total, none)]
                arrays = [pa.array(np.concatenate(c)) for c in cells[1:]]
                which = np.concatenate(cells[0]).astype(np.int64)
                doc = batch.column("doc_id").take(pa.array(lo + which))
                arrays = [doc, *[a.cast(t) for a, t in zip(arrays, [pa.int64()] * 5 + [pa.float64()] * 2)]]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "number", "m", "hash", "n_tokens", "n_known", "base", "total"])

    scored = docs.select("doc_id", "text").mapInArrow(
        score, "doc_id long, number long, m long, hash long, n_tokens long, n_known long, base double, total double")
    joined = scored.join(counts.select("hash", "c"), "hash", "left")
    part = F.col("m") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))
    sums = joined.groupBy("doc_id", "number").agg(
        F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0))).alias("n_known"),
        F.sum(F.col("base") + part).alias("base_score"), F.sum(F.col("total") + part).alias("score"))
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")


def op5_hidden_markov(spark, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    held = remainder(F.col("doc_id"), 10) == 0
    scored = score_texts(docs.withColumn("held_out", F.coalesce(held, F.lit(True))))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 10) == 0).alias("held_out"),
                         "n_tokens", "n_known", "train_tokens", "base_score", "score")
