"""MinHash near-duplicates with SuperMinHash signatures.

*Sets.*  A document's set holds its distinct k-word shingles (words: runs
without ASCII white space, A-Z lower-cased); with fewer words, the whole
sequence.  Documents with equal sets are one node, named by its smallest
doc_id, so copies never multiply work.

*Signature.*  Every element walks a random permutation of the registers; at
step j it offers ``j + random`` to the register at place j.  The ranks of one
element are correlated, which lowers the variance, and no element has to take
a step above the largest register, so most stop after one or two.

*Banding.*  Registers are cut into bands; two sets at the threshold share none
with a probability of at most ``MISS``.  All pairs of a bucket are verified on
``PLANES`` bits of every register: they must agree as often as sets at the
threshold do but for ``MISS``, and their sizes must allow the threshold.  Buckets
are dealt into parts and a task holds two; pairs that are already connected are
skipped, and a task returns a spanning forest, never its pairs.  The groups of
these verified pairs are *families*: any link lies inside one, and texts that
only share a bucket are in none.

*Verification.*  Inside a family all pairs are compared on full sets, in tasks
of bounded size: families are dealt into size classes (sets in classes that
are not adjacent cannot reach the threshold) and classes into parts, and a
task holds two parts.  A task returns a spanning forest of its links.
Union-find rounds over those give the component.

Defined cases: a null or empty text has an empty set and is linked with
nothing; a row without a doc_id is linked with nothing and kept; rows that
repeat a doc_id are the same document; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.functions.joins import own_shuffle
from geotaxa.llm.graph import components
from geotaxa.llm.text import LOWER, Spans, buffer_of, mix, pieces, read_documents, text_hash, word_spans
from geotaxa.session import materialize

BANDS = 32
MISS = 4e-6
PLANES = 3
PART_PRINTS = 2048
PART_NODES, PART_SHINGLES = 512, 400_000
_U = np.uint64


def band_rows(threshold: float) -> int:
    """Most registers a band may have for the stated probability of a miss."""
    rows = 1
    while rows < 8 and (1 - threshold ** (rows + 1)) ** BANDS <= MISS:
        rows += 1
    return rows


def least_agreeing(threshold: float, registers: int) -> int:
    """Registers whose ``PLANES`` bits agree in sets at the threshold, but for
    a probability of ``MISS`` (the binomial tail: SuperMinHash varies less)."""
    p = threshold + (1 - threshold) / 2 ** PLANES
    below, k = 0.0, -1
    while below <= MISS:
        k += 1
        below += comb(registers, k) * p ** k * (1 - p) ** (registers - k)
    return k


def register_planes(table: np.ndarray) -> np.ndarray:
    """(n, PLANES * words): the lowest bits of all registers, bit by bit."""
    n, registers = table.shape
    words = -(-registers // 64)
    bits = np.zeros((n, PLANES, words * 64), np.uint8)
    for plane in range(PLANES):
        bits[:, plane, :registers] = (table >> np.uint32(plane)) & np.uint32(1)
    return np.packbits(bits, axis=2, bitorder="little").reshape(n, -1).view(_U)


def agreeing(a: np.ndarray, b: np.ndarray, registers: int) -> np.ndarray:
    """Registers that agree in each row of ``a`` and ``b``."""
    words = a.shape[1] // PLANES
    apart = (a ^ b).reshape(len(a), PLANES, words)
    return registers - np.bitwise_count(np.bitwise_or.reduce(apart, axis=1)).sum(axis=1, dtype=np.int64)


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their rows, sorted by row."""
    low = LOWER[buf]
    s, e, row = word_spans(low, off)
    h, owner = text_hash(Spans(low).hash(s, e), k, np.bincount(row, minlength=len(off) - 1))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[fresh], owner[fresh]


def signatures(h: np.ndarray, row: np.ndarray, n: int, registers: int) -> np.ndarray:
    """(n, registers): step in the high byte, 24 random bits below."""
    sig = np.full(n * registers, 0xFFFFFFFF, np.uint32)

    def offer(step: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r = mix(hashes + _U((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        place = step + ((r & _U(0xFFFFFFFF)) % _U(registers - step)).astype(np.int64)
        return place, (r >> _U(40)).astype(np.uint32) | np.uint32(step << 24)

    place, value = offer(0, h)
    np.minimum.at(sig, row * registers + place, value)
    table = sig.reshape(n, registers)
    size = np.bincount(row, minlength=n)
    open_ = np.flatnonzero((table.max(axis=1) >= 1 << 24) & (size > 0))
    begin = np.concatenate([[0], np.cumsum(size)])
    while len(open_):  # some rows at a time: the permutations take memory
        take = max(1, int(np.searchsorted(np.cumsum(size[open_]), 60_000)))
        rows, open_ = open_[:take], open_[take:]
        at = np.concatenate([np.arange(begin[r], begin[r + 1]) for r in rows])
        hashes, owner, first = h[at], row[at], place[at]
        line = np.arange(len(at))
        walk = np.tile(np.arange(registers, dtype=np.uint8 if registers <= 256 else np.int16), (len(at), 1))
        walk[line, 0], walk[line, first] = walk[line, first], walk[line, 0].copy()
        for step in range(1, registers):
            live = table[rows].max(axis=1) >= step << 24
            if not live.all():
                rows = rows[live]
                if not len(rows):
                    break
                keep = np.isin(owner, rows)
                hashes, owner, walk = hashes[keep], owner[keep], walk[keep]
                line = np.arange(len(owner))
            k, value = offer(step, hashes)
            to = walk[line, k]
            walk[line, k] = walk[line, step]
            walk[line, step] = to
            np.minimum.at(sig, owner * registers + to, value)
    return table


def _describe(k: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, _, buf, off in pieces(*buffer_of(batch.column("text"))):
                n = len(off) - 1
                h, row = shingle_sets(buf, off, k)
                table = signatures(h, row, n, BANDS * rows)
                planes = np.ascontiguousarray(register_planes(table))
                print_ = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(
                    (np.arange(n + 1) * planes.shape[1] * 8).astype(np.int32)), pa.py_buffer(planes)])
                table = table.astype(_U).reshape(n, BANDS, rows)
                band = np.tile(mix(np.arange(1, BANDS + 1, dtype=_U)), (n, 1))  # bands share no key
                for r in range(rows):
                    band = mix(band * _U(31) + table[:, :, r])
                keys = []
                for salt in (1, 2):  # order-free sums of mixed hashes name the set
                    total = np.concatenate([np.zeros(1, _U), np.cumsum(mix(h + _U(salt)), dtype=_U)])
                    ends = np.searchsorted(row, np.arange(n + 1))
                    keys.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
                size = np.bincount(row, minlength=n)
                out.append((size, *keys, pa.array(list(band.view(np.int64)), pa.list_(pa.int64())), print_))
            parts = [pa.concat_arrays([pa.array(x) for x in c]) for c in zip(*out)] if out else \
                [pa.array([], pa.int64())] * 3 + [pa.array([], pa.list_(pa.int64())), pa.array([], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *parts], ["doc_id", "n", "k1", "k2", "bands", "print"])

    return run


def forest(group: np.ndarray, part: np.ndarray, across: np.ndarray, size: np.ndarray, prints: np.ndarray,
           percent: int, registers: int) -> np.ndarray:
    """Smallest row that each row reaches over pairs of its group (rows come by
    group) whose prints agree and whose sizes allow the threshold.  ``across``:
    only pairs of two parts count."""
    n = len(group)
    least = least_agreeing(percent / 100, registers)
    end = np.searchsorted(group, group, "right")
    root = np.arange(n)
    a, step = np.arange(n), 0
    while True:
        step += 1
        a = a[a + step < end[a]]
        if not len(a):
            return root
        b = a + step
        small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
        ask = (root[a] != root[b]) & (100 * small >= percent * large) & ~(across[a] & (part[a] == part[b]))
        x, y = a[ask], b[ask]
        met = agreeing(prints[x], prints[y], registers) >= least
        x, y = x[met], y[met]
        while len(x):
            p, q = root[x], root[y]
            apart = p != q
            x, y, p, q = x[apart], y[apart], p[apart], q[apart]
            if not len(x):
                break
            np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
            above = root[root]
            while (above != root).any():
                root, above = above, above[above]


def _bucket_forests(percent: int, registers: int):
    """Rows come by (key, i, j); a group that goes on in the next batch waits for it."""

    def links(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        key, i, j, part, node, size = (table.column(c).to_numpy() for c in ("key", "i", "j", "part", "node", "n"))
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        prints = np.frombuffer(b"".join(table.column("print").to_pylist()), _U).reshape(len(key), -1)
        root = forest(np.cumsum(fresh), part, i != j, size, prints, percent, registers)
        away = root != np.arange(len(root))
        return pa.RecordBatch.from_arrays([pa.array(node[root[away]]), pa.array(node[away])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = [held.column(c)[-1].as_py() for c in ("key", "i", "j")]
            same = np.ones(len(held), bool)
            for c, value in zip(("key", "i", "j"), last):
                same &= held.column(c).to_numpy() == value
            cut = int(np.argmax(same))
            if cut:
                yield links(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield links(held)

    return run


def families(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the nodes (node, n, bands, print) that have a pair
    in a bucket with agreeing prints; any link lies inside a component."""
    registers = BANDS * band_rows(percent / 100)
    banded = nodes.select("node", F.explode("bands").alias("key"))
    crowds = banded.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select(
        "key", F.ceil(F.col("c") / PART_PRINTS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    # Part p meets itself, and each other part once, named by the smaller first.
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(
        F.least(x, F.col("part")).alias("i"), F.greatest(x, F.col("part")).alias("j")))).alias("task")
    shared = banded.join(own_shuffle(crowds), "key").join(nodes.select("node", "n", "print"), "node").withColumn("part", part)
    dealt = shared.select("key", "part", "node", "n", "print", meets).select("key", "task.i", "task.j", "part", "node", "n", "print")
    return components(dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "part").mapInArrow(
        _bucket_forests(percent, registers), "a long, b long"))


def _spanning_links(k: int, percent: int):
    """Links between the texts of one task, as a star per component."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        buf, off = buffer_of(table.column("text"))
        nodes = table.column("node").to_numpy()
        n = len(nodes)
        h, row = shingle_sets(buf, off, k)
        size = np.bincount(row, minlength=n)
        values, index, count = np.unique(h, return_inverse=True, return_counts=True)
        shared = count > 1
        number = np.cumsum(shared) - 1
        own = shared[index]
        col, who = number[index[own]], row[own]
        inter = np.zeros((n, n), np.float32)
        order = np.argsort(col, kind="stable")
        col, who = col[order], who[order]
        width = 8192
        for lo in range(0, int(shared.sum()), width):
            a, b = np.searchsorted(col, [lo, lo + width])
            block = np.zeros((n, width), np.float32)
            block[who[a:b], col[a:b] - lo] = 1
            inter += block @ block.T
        inter = inter.astype(np.int64)
        union = size[:, None] + size[None, :] - inter
        linked = (100 * inter >= percent * union) & (inter > 0)
        label = np.arange(n)
        while True:
            lower = np.where(linked, label[None, :], n).min(axis=1, initial=n)
            lower = np.minimum(label, lower)
            lower = lower[lower]
            if (lower == label).all():
                break
            label = lower
        away = label != np.arange(n)
        return pa.table({"a": nodes[label[away]], "b": nodes[away]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.  Documents
    are linked when 100 * |intersection| >= percent * |union| of their sets."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    threshold = percent / 100
    described = materialize(docs.mapInArrow(_describe(k, band_rows(threshold)),
                                            "doc_id long, n long, k1 long, k2 long, bands array<long>, print binary"), "sets")
    known = described.where("n > 0 and doc_id is not null")
    nodes = materialize(known.groupBy("k1", "k2", "n").agg(F.min(F.struct("doc_id", "bands", "print")).alias("s")).select(
        "k1", "k2", "n", F.col("s.doc_id").alias("node"), "s.bands", "s.print"), "nodes")
    near = families(nodes, percent)

    # Tasks: a family as a whole, or two parts of equal or adjacent size classes.
    member = materialize(near.join(nodes.select("node", "n"), "node").select(
        "node", F.col("component").alias("family"), "n",
        F.floor(F.log("n") / F.lit(-log(threshold)) + F.lit(1e-9)).cast("long").alias("class")), "members")
    parts = F.ceil(F.greatest(F.count("*") / PART_NODES, F.sum("n") / PART_SHINGLES)).cast("long")
    whole = member.groupBy("family").agg(parts.alias("whole"))
    classes = member.groupBy("family", "class").agg(parts.alias("parts"))
    sized = member.join(whole, "family")
    for name, shift in (("own", 0), ("above", 1), ("below", -1)):
        sized = sized.join(classes.select("family", (F.col("class") - shift).alias("class"), F.col("parts").alias(name)),
                           ["family", "class"], "left")
    part = F.pmod(F.xxhash64("node"), F.col("own"))

    def keys(count, low, high):
        """Task keys with each part of a class (none if it is empty)."""
        spread = F.transform(F.sequence(F.lit(0), F.coalesce(count, F.lit(1)) - 1), lambda x: F.struct(
            low(x)[0].alias("c"), low(x)[1].alias("i"), high(x)[0].alias("d"), high(x)[1].alias("j")))
        return F.when(count.isNotNull(), spread).otherwise(F.slice(spread, 1, 0))

    here = F.col("class")
    split = F.concat(
        keys(F.col("own"), lambda x: (here, F.least(x, part)), lambda x: (here, F.greatest(x, part))),
        keys(F.col("above"), lambda x: (here, part), lambda x: (here + 1, x)),
        keys(F.col("below"), lambda x: (here - 1, x), lambda x: (here, part)))
    alone = F.array(F.struct(F.lit(-1).cast("long").alias("c"), F.lit(0).cast("long").alias("i"),
                             F.lit(-1).cast("long").alias("d"), F.lit(0).cast("long").alias("j")))
    tasks = sized.select("node", "family", F.when(F.col("whole") == 1, alone).otherwise(split).alias("tasks"))
    texts = docs.join(tasks, F.col("doc_id") == F.col("node")).select("node", "family", F.explode("tasks").alias("task"), "text")
    links = texts.groupBy("family", "task").applyInArrow(_spanning_links(k, percent), "a long, b long")
    found = components(links)

    named = nodes.select("k1", "k2", "n", "node").join(found, "node", "left").select(
        "k1", "k2", "n", F.coalesce("component", "node").alias("component"))
    rows = described.select("doc_id", "k1", "k2", "n").join(named, ["k1", "k2", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, but for those whose group has a smaller doc_id."""
    gone = near_duplicates(docs, k, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")


def op6_superminhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir, "doc_id", "text"), k=3, percent=85)
