"""Benchmark decontamination by q-gram lemma filtering.

Texts and items are compared as *normal bytes*: A-Z lower-cased, each run of
ASCII characters that are neither letters nor digits one space.  An item is
cut into passages of ``PASSAGE`` bytes, each starting half a passage after the
one before (the last ends with the item); a shorter item is one passage.  A
document leaks a passage of length L if some stretch of it is within
``k = floor(EDITS * L)`` single-byte edits (k is lowered for very short
passages, so that the bound below stays at 1 or more).  A document also leaks
an item if any ``RUN`` bytes of it, wherever they start, are bytes of the
item: every verbatim excerpt of at least ``RUN`` normal bytes is found.

*Lemma.*  Such a stretch shares at least ``L - Q + 1 - k Q`` q-grams with the
passage, all on k + 1 neighbouring diagonals.  Hits are counted in bands of
2 (k + 1) diagonals that overlap by half, so every set of k + 1 diagonals lies
in one band.  Bands that meet the bound are verified by an alignment that
stays inside the band widened by k.  Nothing within the budget is lost.
Verbatim runs are ``RUN - Q + 1`` hits in a row whose bytes are looked up by a
hash of their q-grams and compared.

An item of fewer than Q normal bytes has no q-gram: a document leaks it if
its normal bytes stand there verbatim, on word bounds.

Equal items are indexed once.  The benchmark is read in blocks of at most
``BLOCK`` bytes of different texts by a hash of the item (a longer item is a
block of its own size).  An index takes up to 80 times its text, about 160 MB
a block, in the driver and in each task; there is one at a time, and the
documents are scanned once a block.

Defined cases: null or empty texts and items leak nothing, nor do items
without a normal byte; repeated documents and items give a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.llm.text import LOWER, buffer_of, mix, pieces, read_documents
from geotaxa.session import materialize

Q = 10
PASSAGE = 128
EDITS = 0.08
RUN = 6 * Q
BLOCK = 2 << 20
_KEEP = np.zeros(256, bool)
_KEEP[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_U = np.uint64


def normal(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(normal bytes, offsets, place of each byte in ``buf``)."""
    low = LOWER[buf]
    word = _KEEP[low]
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first separator after a word
    starts = off[:-1][off[:-1] < off[1:]]
    keep[starts] = word[starts]
    at = np.flatnonzero(keep)
    out = np.where(word[at], low[at], 0x20).astype(np.uint8)
    return out, np.searchsorted(at, off), at


def grams(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the Q bytes from each place on."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, _U)
    eight = np.empty(len(data) - 7, _U)
    for o in range(min(8, len(eight))):
        m = (len(data) - o) // 8
        eight[o::8] = np.frombuffer(data[o:o + 8 * m].tobytes(), _U)
    return mix(eight[:n] * _U(0x9E3779B97F4A7C15) + eight[Q - 8:Q - 8 + n])


def run_hash(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the RUN bytes from each place of ``at`` on, by their q-grams."""
    out = np.zeros(len(at), _U)
    for o in range(0, RUN, Q):
        out = mix(out * _U(0x9E3779B97F4A7C15) + h[at + o])
    return out


class Index:
    """Q-grams of one block of different items (item_id, text, times it is in the table)."""

    def __init__(self, items: list[tuple[int, str, int]]):
        self.items = [i for i, _, _ in items]
        self.times = [n for _, _, n in items]
        self.short: dict[int, dict[bytes, list[int]]] = {}  # by length and normal bytes
        own, text, size, flat, whole = [], [], [], [], []
        for number, (_, t, _) in enumerate(items):
            raw = np.frombuffer((t or "").encode(), np.uint8)
            data, _, _ = normal(raw, np.array([0, len(raw)]))
            if len(data) and data[-1] == 0x20:
                data = data[:-1]
            if len(data) < Q:
                if len(data):
                    self.short.setdefault(len(data), {}).setdefault(data.tobytes(), []).append(number)
                continue
            flat.append(data)
            whole.append(number)
            starts = [0] if len(data) <= PASSAGE else sorted({*range(0, len(data) - PASSAGE, PASSAGE // 2), len(data) - PASSAGE})
            for s in starts:
                part = data[s:s + PASSAGE]
                own.append(number)
                size.append(len(part))
                text.append(np.pad(part, (0, PASSAGE - len(part))))
        self.item = np.array(own, np.int64)
        self.size = np.array(size, np.int64)
        self.text = np.array(text, np.uint8).reshape(len(own), PASSAGE)
        self.budget = np.minimum((EDITS * self.size).astype(np.int64), (self.size - Q) // Q)
        self.least = self.size - Q + 1 - self.budget * Q
        found = [grams(self.text[p, :n]) for p, n in enumerate(size)]
        h = np.concatenate(found) if found else np.zeros(0, _U)
        passage = np.repeat(np.arange(len(found)), [len(x) for x in found])
        place = np.concatenate([np.arange(len(x)) for x in found]) if found else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.passage, self.place = passage[order], place[order]
        self.grams, self.begin = np.unique(h[order], return_index=True)
        self.begin = np.append(self.begin, len(h))
        self._runs(flat, whole)

    def _runs(self, flat: list[np.ndarray], whole: list[int]) -> None:
        """Every RUN bytes of the items, one entry per item that has them."""
        self.flat = np.concatenate(flat) if flat else np.zeros(0, np.uint8)
        begin = np.cumsum([0] + [len(x) for x in flat])
        n = np.array([max(0, len(x) - RUN + 1) for x in flat], np.int64)
        at = np.repeat(begin[:-1] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        item = np.repeat(np.array(whole, np.int64), n)
        key = run_hash(grams(self.flat), at)
        order = np.lexsort((at, item, key))
        key, item, at = key[order], item[order], at[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (item[1:] != item[:-1])
        self.run_item, self.run_at = item[fresh], at[fresh]
        self.runs, self.run_begin = np.unique(key[fresh], return_index=True)
        self.run_begin = np.append(self.run_begin, len(self.run_at))

    def maybe(self) -> np.ndarray:
        """By the first 22 bits of a hash: may it be one of the block's?"""
        table = np.zeros(1 << 22, bool)
        table[(self.grams >> _U(42)).astype(np.int64)] = True
        return table


def distances(index: Index, passage: np.ndarray, data: np.ndarray, start: np.ndarray, stop: np.ndarray,
              width: int) -> tuple[np.ndarray, np.ndarray]:
    """(edits, end) of the best stretch for each passage, on the ``width``
    diagonals from ``start`` on; places from ``stop`` on match nothing."""
    shift = np.arange(width)
    score = np.zeros((len(passage), width), np.int64)
    best, end = np.full(len(passage), 1 << 30), np.zeros(len(passage), np.int64)
    for i in range(int(index.size[passage].max())):
        at = start[:, None] + i + shift
        inside = (at >= stop[:, 0:1]) & (at < stop[:, 1:2])
        char = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0)
        new = score + (char != index.text[passage, i][:, None])
        new[:, :-1] = np.minimum(new[:, :-1], score[:, 1:] + 1)
        score = np.minimum.accumulate(new - shift, axis=1) + shift
        over = index.size[passage] == i + 1
        if over.any():
            place = score[over].argmin(axis=1)
            best[over] = score[over].min(axis=1)
            end[over] = start[over] + i + 1 + place
    return best, end


def verbatim_in(index: Index, data: np.ndarray, ends: np.ndarray, h: np.ndarray,
                hit: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """(row, item) -> (start, end) in ``data`` of the RUN bytes they share;
    ``hit``: the places in ``data`` whose q-gram is in the index."""
    steps = RUN - Q
    if len(hit) <= steps or not len(index.runs):
        return {}
    at = hit[:-steps][hit[steps:] - hit[:-steps] == steps]
    row = np.searchsorted(ends[1:], at, "right")
    inside = at + RUN <= ends[row + 1]
    at, row = at[inside], row[inside]
    key = run_hash(h, at)
    entry = np.minimum(np.searchsorted(index.runs, key), len(index.runs) - 1)
    same = index.runs[entry] == key
    at, name = at[same], row[same] * len(index.runs) + entry[same]
    # Each run once a row, with its first and last place.
    name, first, inverse = np.unique(name, return_index=True, return_inverse=True)
    last = np.zeros(len(name), np.int64)
    np.maximum.at(last, inverse, at)
    first = at[first]
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for lo in range(0, len(name), 20_000):
        row, entry = np.divmod(name[lo:lo + 20_000], len(index.runs))
        count = index.run_begin[entry + 1] - index.run_begin[entry]
        use = np.repeat(index.run_begin[entry] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        a, z = np.repeat(first[lo:lo + 20_000], count), np.repeat(last[lo:lo + 20_000], count) + RUN
        pair = np.repeat(row, count) * len(index.items) + index.run_item[use]
        true = np.ones(len(use), bool)
        for o in range(RUN):
            true &= data[a + o] == index.flat[index.run_at[use] + o]
        pair, a, z = pair[true], a[true], z[true]
        pair, inverse = np.unique(pair, return_inverse=True)
        start, end = np.full(len(pair), 1 << 62), np.zeros(len(pair), np.int64)
        np.minimum.at(start, inverse, a)
        np.maximum.at(end, inverse, z)
        for p, x, y in zip(pair.tolist(), start.tolist(), end.tolist()):
            r = divmod(p, len(index.items))
            have = out.get(r, (x, y))
            out[r] = (min(have[0], x), max(have[1], y))
    return out


def short_in(index: Index, data: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """(row, item) -> (start, end) in ``data`` of the first place of each
    short item that stands there on word bounds."""
    out: dict[tuple[int, int], tuple[int, int]] = {}
    if not index.short or not len(data):
        return out
    gap = data == 0x20
    first, edge = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)  # words begin, words can end here
    first[ends] = edge[ends] = True
    first[1:] |= gap
    edge[:-1] |= gap
    start = np.flatnonzero(first[:-1] & ~gap)
    stop = ends[np.searchsorted(ends, start, "right")]
    for size, known in index.short.items():
        at = start[start + size <= stop]
        at = at[edge[at + size]]
        found = np.ascontiguousarray(data[at[:, None] + np.arange(size)]).view(f"S{size}").ravel()
        names = np.array(sorted(known), f"S{size}")
        place = np.minimum(np.searchsorted(names, found), len(names) - 1)
        same = names[place] == found
        row = np.searchsorted(ends[1:], at[same], "right")
        key, first = np.unique(row * len(names) + place[same], return_index=True)
        for k, a in zip(key.tolist(), at[same][first].tolist()):
            for item in known[bytes(names[k % len(names)])]:
                out[k // len(names), item] = (a, a + size)
    return out


def leaks_in(index: Index, maybe: np.ndarray, buf: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, start, end, edits), places in bytes of ``buf``, one per row and item."""
    data, ends, at = normal(buf, off)
    out = {name: (int(at[a]), int(at[z - 1]) + 1, 0) for name, (a, z) in short_in(index, data, ends).items()}
    h = grams(data)
    hit = np.flatnonzero(maybe[(h >> _U(42)).astype(np.int64)])
    if not len(hit) or not len(index.grams):
        return [(r, i, *v) for (r, i), v in sorted(out.items())]
    entry = np.minimum(np.searchsorted(index.grams, h[hit]), len(index.grams) - 1)
    true = index.grams[entry] == h[hit]
    hit, entry = hit[true], entry[true]
    out |= {name: (int(at[a]), int(at[z - 1]) + 1, 0) for name, (a, z) in verbatim_in(index, data, ends, h, hit).items()}
    # Only stretches with enough hits of any kind can meet a bound.
    least, span = int(index.least.min()), PASSAGE + 2 * int(index.budget.max()) + 2
    if len(hit) < least:
        return [(r, i, *v) for (r, i), v in sorted(out.items())]
    dense = np.flatnonzero(hit[least - 1:] - hit[:len(hit) - least + 1] <= span)
    cover = np.zeros(len(hit) + 1, np.int64)
    np.add.at(cover, dense, 1)
    np.add.at(cover, dense + least, -1)
    live = np.cumsum(cover[:-1]) > 0
    hit, entry = hit[live], entry[live]
    count = index.begin[entry + 1] - index.begin[entry]
    use = np.repeat(index.begin[entry] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    place = np.repeat(hit, count)
    passage = index.passage[use]
    row = np.searchsorted(ends[1:], place, "right")
    diagonal = place - index.place[use] - ends[row] + PASSAGE  # not below 0
    stride = index.budget[passage] + 1
    band = diagonal // stride
    wide = int(ends[-1]) + 2 * PASSAGE + 2
    key = (row * len(index.size) + passage) * wide + band
    key, n = np.unique(np.concatenate([key, key[band > 0] - 1]), return_counts=True)
    row, passage, band = key // wide // len(index.size), key // wide % len(index.size), key % wide
    good = n >= index.least[passage]
    row, passage, band = row[good], passage[good], band[good]
    for lo in range(0, len(row), 2000):
        r, p, b = row[lo:lo + 2000], passage[lo:lo + 2000], band[lo:lo + 2000]
        k = index.budget[p]
        start = b * (k + 1) - PASSAGE + ends[r] - k
        edits, end = distances(index, p, data, start, np.stack([ends[r], ends[r + 1]], axis=1), 4 * int(k.max()) + 3)
        for j in np.flatnonzero(edits <= k):
            a = max(int(end[j] - index.size[p[j]]), int(ends[r[j]]))
            z = min(int(end[j]), int(ends[r[j] + 1]))
            name = (int(r[j]), int(index.item[p[j]]))
            have = out.get(name, (1 << 62, -1, 1 << 30))
            out[name] = (min(have[0], int(at[a])), max(have[1], int(at[z - 1]) + 1), min(have[2], int(edits[j])))
    return [(r, i, *v) for (r, i), v in sorted(out.items())]


def benchmark_blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The different items (item_id, text, n), in blocks of bounded size."""
    items = benchmark.where("text is not null").groupBy("item_id", "text").agg(F.count("*").alias("n"))
    total = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = -(-int(total) // BLOCK)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    return [items.where(part == b) for b in range(blocks)]


def index_of(block: DataFrame) -> Index:
    return Index(sorted((tuple(r) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, start, end
    (code points around the leaked passages), edits (of the closest)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = docs.select("doc_id").schema.add(benchmark.select("item_id").schema[0]).add("start", "long").add("end", "long").add("edits", "long")

    def search(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            maybe = index.maybe()
            for batch in batches:
                rows = []
                for lo, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                    for r, item, a, z, edits in leaks_in(index, maybe, buf, off):
                        points = [int(np.count_nonzero((buf[off[r]:x] & 0xC0) != 0x80)) for x in (a, z)]
                        rows += [(lo + r, index.items[item], *points, edits)] * index.times[item]
                cells = list(zip(*rows)) if rows else [[]] * 5
                doc = batch.column("doc_id").take(pa.array(cells[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([doc, *[pa.array(c, pa.int64()) for c in cells[1:]]],
                                                 ["doc_id", "item_id", "start", "end", "edits"])
        return run

    blocks, out = benchmark_blocks(benchmark), None
    for block in blocks:
        found = docs.mapInArrow(search(index_of(block)), schema)
        found = found if len(blocks) == 1 else materialize(found, "leaks")  # and its index can go
        out = found if out is None else out.unionAll(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns."""

    def clean(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            maybe = index.maybe()
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                    for r, *_ in leaks_in(index, maybe, buf, off):
                        keep[lo + r] = False
                yield batch.filter(pa.array(keep))
        return run

    blocks = benchmark_blocks(benchmark)
    for block in blocks:
        docs = docs.mapInArrow(clean(index_of(block)), docs.schema)
        docs = docs if len(blocks) == 1 else materialize(docs, "clean")
    return docs


def op9_qgram_leaks(spark, sf_dir: str) -> DataFrame:
    return find_leaks(read_documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
