"""Secret scan: fixed patterns plus a linear-chain conditional random field.

*Patterns* (kinds ``assign``, ``access``, ``hex``) are found leftmost and
non-overlapping, per kind; a match below the kind's length is dropped.

*CRF.*  White-space tokens are tagged B (begin), I (inside) or O (outside of
a secret).  Emissions add the weights of the token's shape (length, character
classes, share of digits), the token itself, its neighbouring tokens (two
before, one after; hashed) and two features of the whole text (share of
symbols, length).  It is trained on a bounded sample of documents
(about ``train_docs`` with and an eighth as many without a keyword, by a hash of
the doc_id), in which the values of pattern matches are the secrets.  Each of
them, of any length, gives stretches around at most ``HITS`` of its values and
one more place, drawn by a hash and cut out where the text lies.  Decoding is
Viterbi over whole texts.  A token at
which O leads by more than any two transitions can change is certainly O, so
the text is cut there and only the stretches between are decoded: the path is
the same as over the whole text.  Runs of B and I that touch no pattern match
are added as kind ``crf``; pattern matches always stay.

Offsets are code points, end exclusive.  Null texts are empty; every row
gives one row; with no document to learn from nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geotaxa.llm.text import LOWER, SPACE, Spans, buffer_of, hash_share, pieces, read_documents

# The patterns and their least lengths.
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "crf")
WINDOW, HITS = 12, 4
STEPS_AT_ONCE = 5_000_000

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[*b"0123456789abcdef"]] = True
# Digits, small letters, capitals and the rest, 16 bits each, summed at once.
_CLASS = np.full(256, 1 << 48, np.uint64)
_CLASS[SPACE] = 0
_CLASS[0x30:0x3A] = 1
_CLASS[0x61:0x7B] = 1 << 16
_CLASS[0x80:] = 1 << 16
_CLASS[0x41:0x5B] = 1 << 32

WORDS = 1024
SHAPES = 7 * 16 * 4
FILES = 4 * 4
# First weight row of each feature group: shape, token, before, two before, after, text.
GROUPS = np.cumsum([0, SHAPES, WORDS, WORDS, WORDS, WORDS])
N_WEIGHTS = int(GROUPS[-1]) + FILES


def _keyword_starts(low: bytes) -> list[int]:
    at = []
    for k in KEYWORDS:
        i = low.find(k)
        while i >= 0:
            at.append(i)
            i = low.find(k, i + 1)
    return sorted(at)


def pattern_matches(data: bytes, low: bytes, hexes: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(start, end, kind, value start, value end) in bytes.  Texts are divided
    by a byte that no pattern holds, so one pass covers many texts."""
    out, end = [], 0
    for i in _keyword_starts(low):
        if i >= end and (m := ASSIGN.match(data, i)):
            end = m.end()
            if len(m[1]) >= LEAST["assign"]:
                out.append((m.start(), end, 0, m.start(1), end))
    i, end = data.find(b"AKIA"), 0
    while i >= 0:
        if i >= end and (m := ACCESS.match(data, i)):
            end = m.end()
            if end - i >= LEAST["access"]:
                out.append((i, end, 1, i, end))
        i = data.find(b"AKIA", i + 1)
    # A run of 24 fills at least one aligned block of 12.
    blocks, end = np.flatnonzero(hexes[:len(hexes) // 12 * 12].reshape(-1, 12).all(axis=1)) * 12, 0
    for i in blocks.tolist():
        if i < end:
            continue
        start = i
        while start and hexes[start - 1]:
            start -= 1
        end = HEX.match(data, i).end()
        if end - start >= LEAST["hex"]:
            out.append((start, end, 2, start, end))
    return sorted(out)


class Piece:
    """The texts of one piece with a line break after each."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.bytes = np.insert(buf, off[1:], 10) if len(off) > 1 else buf
        self.off = off + np.arange(len(off))
        self.data = self.bytes.tobytes()
        low = LOWER[self.bytes]
        self.matches = pattern_matches(self.data, low.tobytes(), _HEX_BYTE[self.bytes])
        word = ~SPACE[self.bytes]
        edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.row = np.searchsorted(self.off[1:], self.start, "right")
        self.hash = Spans(low).hash(self.start, self.end)

    def features(self) -> np.ndarray:
        """Weight rows of each token, one column per feature group."""
        n = len(self.start)
        out = np.zeros((n, 6), np.int64)
        if not n:
            return out
        counts = np.add.reduceat(_CLASS[self.bytes], self.start)
        digit, small, capital, other = (((counts >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4))
        for t in np.flatnonzero(self.end - self.start > 0xFFFF):  # 16 bits may not hold these
            own = _CLASS[self.bytes[self.start[t]:self.end[t]]]
            for k, table in enumerate((digit, small, capital, other)):
                table[t] = np.count_nonzero(own == np.uint64(1 << 16 * k))
        length = np.digitize(self.end - self.start, [4, 8, 16, 24, 32, 40])
        kinds = (digit > 0) * 1 + (small > 0) * 2 + (capital > 0) * 4 + (other > 0) * 8
        share = np.minimum(4 * digit // np.maximum(self.end - self.start, 1), 3)
        out[:, 0] = (length * 16 + kinds) * 4 + share
        word = (self.hash % np.uint64(WORDS - 1)).astype(np.int64) + 1  # 0: no such neighbour
        out[:, 1] = word
        for col, shift in ((2, 1), (3, 2)):
            out[shift:, col] = np.where(self.row[shift:] == self.row[:-shift], word[:-shift], 0)
        out[:-1, 4] = np.where(self.row[:-1] == self.row[1:], word[1:], 0)
        rows = len(self.off) - 1
        size = np.maximum(np.diff(self.off) - 1, 1)
        symbols = np.bincount(self.row, other.astype(np.float64), rows) / size
        file = np.digitize(symbols, [0.02, 0.05, 0.15]) * 4 + np.digitize(size, [500, 2000, 10000])
        out[:, 5] = file[self.row]
        return out + GROUPS


class Model:
    """Weights (rows, 3) for O, B, I and transitions (3, 3)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves
        # Most that the transitions of a token can gain if it is B or I instead of
        # O, over all neighbours or none.
        before = (moves - moves[:, :1]).max(axis=0)
        after = (moves - moves[:1, :]).max(axis=1)
        self.swing = np.maximum(before, 0.0)[1:] + np.maximum(after, 0.0)[1:]

    def tag(self, features: np.ndarray, row: np.ndarray) -> np.ndarray:
        """True for the tokens on the best path's B and I, text by text."""
        secret = np.zeros(len(row), bool)
        emit = np.zeros((len(row), 3))
        for g in range(features.shape[1]):
            emit += self.weights[features[:, g]]
        open_ = np.flatnonzero((emit[:, 1:] + self.swing >= emit[:, :1]).any(axis=1))
        if not len(open_):
            return secret
        cut = np.flatnonzero((np.diff(open_) > 1) | (row[open_][1:] != row[open_][:-1])) + 1
        begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(open_)]])
        order = np.argsort(begin - end, kind="stable")
        first, length = open_[begin[order]], (end - begin)[order]
        lo = 0
        while lo < len(first):  # longest first, as many at a time as the table of steps has room for
            hi = lo + max(1, STEPS_AT_ONCE // int(length[lo]))
            self._decode(emit, row, first[lo:hi], length[lo:hi], secret)
            lo = hi
        return secret

    def _decode(self, emit: np.ndarray, row: np.ndarray, first: np.ndarray, length: np.ndarray, secret: np.ndarray) -> None:
        """Viterbi over stretches (longest first), side by side."""
        # The token before and after a stretch is O, or there is none.
        last_of = first + length
        has_before = (first > 0) & (row[np.maximum(first - 1, 0)] == row[first])
        has_after = (last_of < len(row)) & (row[np.minimum(last_of, len(row) - 1)] == row[first])
        score = np.where(has_before[:, None], self.moves[0], 0.0) + emit[first]
        back = np.zeros((length[0], len(first), 3), np.int8)
        for t in range(1, length[0]):
            live = int(np.searchsorted(-length, -t, "left"))
            options = score[:live, :, None] + self.moves
            back[t, :live] = options.argmax(axis=1)
            score[:live] = options.max(axis=1) + emit[first[:live] + t]
        score += np.where(has_after[:, None], self.moves[:, 0], 0.0)
        state = score.argmax(axis=1)
        for t in range(length[0] - 1, -1, -1):
            live = int(np.searchsorted(-length, -t, "left"))
            secret[first[:live] + t] = state[:live] > 0
            if t:
                state[:live] = back[t, np.arange(live), state[:live]]


NOTHING = Model(np.zeros((N_WEIGHTS, 3)) + [1.0, 0.0, 0.0], np.zeros((3, 3)))


def _gold(piece: Piece) -> np.ndarray:
    """1 for a token that begins a pattern's value, 2 for one that goes on with it."""
    gold = np.zeros(len(piece.start), np.int64)
    for _, _, _, a, b in piece.matches:
        lo, hi = np.searchsorted(piece.end, a, "right"), np.searchsorted(piece.start, b, "left")
        if lo < hi and not gold[lo]:
            gold[lo], gold[lo + 1:hi] = 1, 2
    return gold


def _around(piece: Piece, features: np.ndarray, gold: np.ndarray, centres: np.ndarray,
            window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, gold, is inside the text) of the tokens around each centre."""
    place = centres[:, None] - window + np.arange(2 * window + 1)
    here = (place >= 0) & (place < len(gold))
    place = np.clip(place, 0, len(gold) - 1)
    here &= piece.row[place] == piece.row[centres][:, None]
    return features[place], np.where(here, gold[place], 0), here


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text the stretches to learn from: int16 of (stretch, token, features, gold and inside)."""
    for batch in batches:
        out = []
        for _, _, buf, off in pieces(*buffer_of(batch.column("text"))):
            piece = Piece(buf, off)
            gold, features = _gold(piece), piece.features()
            ends = np.searchsorted(piece.row, np.arange(len(off)))
            for lo, hi in zip(ends[:-1], ends[1:]):
                if lo == hi:
                    out.append(b"")
                    continue
                rng = np.random.default_rng(int(piece.hash[lo:hi].sum(dtype=np.uint64)))
                hits = lo + np.flatnonzero(gold[lo:hi] == 1)
                centres = np.append(rng.choice(hits, min(HITS, len(hits)), replace=False), rng.integers(lo, hi))
                x, y, here = _around(piece, features, gold, centres.astype(np.int64), WINDOW)
                out.append(np.concatenate([x, y[:, :, None], here[:, :, None]], axis=2).astype(np.int16).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["stretches"])


def fit(stretches: list[bytes], steps: int = 80) -> Model:
    """Maximum likelihood (Adam, L2) over stretches of tokens: those around
    pattern values and others from elsewhere.  Every stretch is also learned
    with random words in place of its own, so that shapes carry a secret beside
    a word that no pattern knows."""
    rng = np.random.default_rng(5)
    width, parts, found = 2 * WINDOW + 1, [], 0
    for blob in stretches:
        cells = np.frombuffer(blob, np.int16).reshape(-1, width, 8).astype(np.int64)
        found += int((cells[:, WINDOW, 6] == 1).sum())
        parts.append((cells[:, :, :6], cells[:, :, 6], cells[:, :, 7] == 1))
    if not found:
        return NOTHING
    x, y, here = (np.concatenate(c) for c in zip(*parts))
    unknown = x.copy()
    unknown[:, :, 1:5] = GROUPS[1:5] + rng.integers(1, WORDS, unknown[:, :, 1:5].shape)
    x, y, here = np.concatenate([x, unknown]), np.concatenate([y, y]), np.concatenate([here, here])
    weights, moves = np.zeros((N_WEIGHTS, 3)), np.zeros((3, 3))
    state = [np.zeros_like(a) for a in (weights, weights, moves, moves)]
    batch = len(x)
    for step in range(1, steps + 1):
        emit = weights[x].sum(axis=2) * here[:, :, None]
        alpha = np.zeros((batch, width, 3))
        beta = np.zeros((batch, width, 3))
        alpha[:, 0] = emit[:, 0]
        for t in range(1, width):
            alpha[:, t] = emit[:, t] + _logsum(alpha[:, t - 1, :, None] + moves, 1)
            beta[:, width - 1 - t] = _logsum(moves + (emit[:, width - t] + beta[:, width - t])[:, None, :], 2)
        z = _logsum(alpha[:, -1], 1)[:, None, None]
        gap = np.exp(alpha + beta - z)
        gap[np.arange(batch)[:, None], np.arange(width), y] -= 1
        gap *= here[:, :, None] / batch
        grad_w = np.zeros_like(weights)
        for g in range(x.shape[2]):
            np.add.at(grad_w, x[:, :, g].ravel(), gap.reshape(-1, 3))
        pair = np.exp(alpha[:, :-1, :, None] + moves + (emit + beta)[:, 1:, None, :] - z[..., None])
        grad_m = pair.sum(axis=(0, 1))
        np.add.at(grad_m, (y[:, :-1], y[:, 1:]), -1)
        grad_m /= batch
        for k, (p, g) in enumerate(((weights, grad_w + 1e-4 * weights), (moves, grad_m + 1e-4 * moves))):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model(weights, moves)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis)
    return top + np.log(np.exp(a - np.expand_dims(top, axis)).sum(axis=axis))


def find_secrets(buf: np.ndarray, off: np.ndarray, model: Model) -> list[list[tuple[int, int, int]]]:
    """Per text the spans (start, kind, end), in code points and order."""
    piece = Piece(buf, off)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(off) - 1)]
    spans = [(a, k, b) for a, b, k, _, _ in piece.matches]
    secret = model.tag(piece.features(), piece.row)
    if secret.any():
        covered = np.zeros(len(piece.bytes) + 1, np.int32)
        for a, _, b in spans:
            covered[a] += 1
            covered[b] -= 1
        covered = np.cumsum(np.cumsum(covered) > 0)
        at = np.flatnonzero(secret)
        cut = np.flatnonzero((np.diff(at) > 1) | (piece.row[at][1:] != piece.row[at][:-1])) + 1
        for i, j in zip(at[np.concatenate([[0], cut])], at[np.concatenate([cut, [len(at)]]) - 1]):
            a, b = int(piece.start[i]), int(piece.end[j])
            if covered[b - 1] == (covered[a - 1] if a else 0):
                spans.append((a, 3, b))
    for a, k, b in sorted(spans):
        r = int(np.searchsorted(piece.off[1:], a, "right"))
        base = int(piece.off[r])
        extra = [np.count_nonzero((piece.bytes[base:p] & 0xC0) == 0x80) for p in (a, b)]
        found[r].append((a - base - extra[0], k, b - base - extra[1]))
    return found


def train(docs: DataFrame, train_docs: int = 1500) -> Model:
    """Fit on the bounded sample the module text describes."""
    docs = docs.select("doc_id", "text")
    low = F.lower("text")
    keyword = low.contains("akia")
    for k in KEYWORDS:
        keyword = keyword | low.contains(k.decode())
    counts = docs.agg(F.count_if(keyword), F.count_if(~keyword)).head()
    # The share comes first, so few texts are searched, and only stretches leave their place.
    sampled = (hash_share(train_docs, counts[0]) & keyword) | (hash_share(train_docs // 8, counts[1]) & ~keyword)
    rows = docs.where(sampled).select("text").mapInArrow(_stretches, "stretches binary")
    # Little more than train_docs rows; the bound binds only where one drawn doc_id has very many rows.
    rows = rows.orderBy(F.xxhash64("stretches"), "stretches").limit(2 * train_docs).collect()
    return fit([bytes(r["stretches"]) for r in rows])


def scan_secrets(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document with its spans: doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_added."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fitted = model or train(docs)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                for spans in find_secrets(buf, off, fitted):
                    words = [(k, f"{KINDS[k]}:{a}:{b}") for a, k, b in spans]
                    counts = [sum(k == kind for k, _ in words) for kind in range(4)]
                    base = ",".join(w for k, w in words if k < 3)
                    out.append((*counts[:3], hashlib.sha256(base.encode()).hexdigest(), ",".join(w for _, w in words), counts[3]))
            columns = list(zip(*out)) if out else [[]] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"])

    return docs.mapInArrow(digests, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                    "spans string, n_added long")


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", model: Model | None = None) -> DataFrame:
    """The documents with every span replaced by ``mark``; other columns and
    texts without a span are unchanged.  ``n_chars``, if there, follows the text."""
    fitted = model or train(docs)
    names, schema = docs.columns, docs.schema
    counted = "n_chars" in names and isinstance(schema["n_chars"].dataType, (T.LongType, T.IntegerType))

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, at = None, None, 0
            column = batch.column("text")
            for _, _, buf, off in pieces(*buffer_of(column)):
                for r, spans in enumerate(find_secrets(buf, off, fitted)):
                    if spans:
                        if texts is None:
                            texts = column.to_pylist()
                            sizes = batch.column("n_chars").to_pylist() if counted else []
                        text, done, parts = texts[at + r], 0, []
                        for a, _, b in spans:
                            if b > done:
                                parts += [text[done:max(a, done)], mark if a >= done else ""]
                                done = b
                        texts[at + r] = "".join(parts) + text[done:]
                        if counted:
                            sizes[at + r] = len(texts[at + r])
                at += len(off) - 1
            if texts is not None:
                arrays = dict(zip(batch.schema.names, batch.columns))
                arrays["text"] = pa.array(texts, column.type)
                if counted:
                    arrays["n_chars"] = pa.array(sizes, batch.column("n_chars").type)
                batch = pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))
            yield batch

    return docs.mapInArrow(redact, schema)


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(read_documents(spark, sf_dir, "doc_id", "text"))
