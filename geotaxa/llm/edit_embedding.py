"""Document fingerprints by a randomised edit embedding.

All texts share one random walk: at step j a pointer over the characters
emits the character under it and advances by ``r_j(character)``, a random bit
that depends on step and character alone.  Two texts at a small edit distance
fall into step again soon after each edit, so their outputs differ in few
steps: edit distance becomes Hamming distance.

The whole text is walked.  The output is *bit-sampled* at fixed steps: 128
steps in steps 0..127 and 128 more in each further doubling, so the share of
sampled steps adapts to the length and no text is cut.  A fingerprint is
``<number of samples>:<hex of their bits>``; equal texts have equal
fingerprints.  ``likeness`` weighs each sample by the steps it stands for.

``fingerprint_edits`` compares each text with its half-edited form and with
the next document in descending doc_id order; ``near_links`` groups
fingerprints by bands of sampled bits and verifies every pair that shares one.

Defined cases: a null text is empty; an empty text has fingerprint ``0:``, is
1.0 like an empty text and 0.0 like any other.  Rows without a doc_id come
last in the descending order; rows with the same doc_id are ordered by the
hash of their text.  Every input row gives one row; an empty table none.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.llm.text import read_documents
from geotaxa.session import materialize

SAMPLES = 128
PERIOD = 4096
PART_PRINTS = 512

_rng = np.random.default_rng(1405)
_ROWS = [bytes(r) for r in _rng.integers(0, 2, size=(PERIOD, 256), dtype=np.uint8)] * 2
_BITS = _rng.integers(0, 2, size=(PERIOD, 256), dtype=np.uint8)
_steps: list[int] = list(range(SAMPLES))
_weights: list[float] = [1.0] * SAMPLES


def _sampled(count: int) -> None:
    """Make at least ``count`` sampled steps known; each level doubles the steps."""
    while len(_steps) < count:
        level = len(_steps) // SAMPLES
        width = SAMPLES << (level - 1)
        picks = np.random.default_rng(level).choice(width, SAMPLES, replace=False)
        _steps.extend(int(x) for x in np.sort(picks) + width)
        _weights.extend([width / SAMPLES] * SAMPLES)


def char_codes(text: str) -> bytes:
    """One byte per code point."""
    wide = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return ((wide * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def walk(codes: bytes, at: list[int] | None = None) -> list[int]:
    """Positions under the pointer at the sampled steps, until the text ends.
    ``at``: the positions already known (a shared beginning)."""
    at = at if at is not None else []
    _sampled(len(at) + SAMPLES)
    i, step, n = (at[-1], _steps[len(at) - 1], len(codes)) if at else (0, 0, len(codes))
    try:
        while True:
            if len(at) == len(_steps):
                _sampled(len(at) + 1)
            to = _steps[len(at)]
            while step < to:
                k = step % PERIOD
                rows = _ROWS[k:k + min(to - step, PERIOD)]
                for row in rows:
                    i += row[codes[i]]
                step += len(rows)
            if i >= n:
                return at
            at.append(i)
    except IndexError:
        return at


def bits_of(codes: bytes, at: list[int]) -> np.ndarray:
    if not at:
        return np.zeros(0, np.uint8)
    return _BITS[np.arange(len(at)) % PERIOD, np.frombuffer(codes, np.uint8)[at]]


def fingerprint(bits: np.ndarray) -> str:
    return f"{len(bits)}:{np.packbits(bits).tobytes().hex()}"


def parse_fingerprint(fp: str) -> np.ndarray:
    n, _, text = fp.partition(":")
    return np.unpackbits(np.frombuffer(bytes.fromhex(text), np.uint8))[:int(n)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of equal steps: two bits of different characters agree half the time."""
    both, longest = min(len(a), len(b)), max(len(a), len(b))
    if not longest:
        return 1.0
    _sampled(longest)
    w = np.asarray(_weights[:longest])
    agree = w[:both][a[:both] == b[:both]].sum()
    return float(max(0.0, (2 * agree - w[:both].sum()) / w.sum()))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (bucket, doc_id ascending), each bucket led by the document
    before it, so the next document in descending order is the row before."""
    previous = ("", b"", np.zeros(0, np.uint8))
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("_guest", "doc_id", "text")]
        for guest, doc_id, text in zip(*columns):
            codes = char_codes(text)
            positions = walk(codes)
            bits = bits_of(codes, positions)
            if not guest:
                before, before_codes, before_bits = previous
                half = len(text) // 2
                keep = len(text) - half
                edited = text[:keep] + before[:half]
                changed = codes[:keep] + before_codes[:half]
                shared = positions[:bisect_left(positions, keep)]
                edited_bits = bits_of(changed, walk(changed, shared))
                out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(bits),
                            fingerprint(edited_bits), likeness(bits, edited_bits), likeness(bits, before_bits)))
            previous = (text, codes, bits)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, _TYPES)], _NAMES)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def fingerprint_edits(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its half-edited form, with their likenesses.

    The order by doc_id is dealt into ``buckets`` ranges whose bounds are
    quantiles of doc_id, so the texts are shuffled once.  Each bucket also
    gets the document before its first, which is the largest of the bucket
    below; one row a bucket reaches the driver to find those."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * partitions
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / buckets for k in range(1, buckets)]
    found = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 100 * buckets)).head()[0]
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, ids.fillna(-(1 << 63)).to_numpy(np.int64), "left")
        return pd.Series(at.astype(np.int32))

    digest = F.xxhash64("text")
    ids = docs.select("doc_id").withColumn("_bucket", bucket_of("doc_id"))
    tops = dict(ids.groupBy("_bucket").agg(F.max("doc_id")).orderBy("_bucket").collect())
    order = sorted(tops)
    before = {b: tops[order[k - 1]] for k, b in enumerate(order)}  # the first bucket gets the last document
    wanted = spark.createDataFrame([(int(b), d) for b, d in before.items()], "_bucket int, _top long")
    named = [d for d in set(before.values()) if d is not None]
    last = docs.where(F.col("doc_id").isin(named) if None not in before.values() else
                      F.col("doc_id").isin(named) | F.col("doc_id").isNull())
    # Of several rows with that doc_id the last by the order is the one before.
    last = last.groupBy("doc_id").agg(F.max_by("text", digest).alias("text"))
    guests = last.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("_top"))).select(
        "_bucket", F.lit(True).alias("_guest"), "doc_id", "text")
    rows = docs.withColumn("_bucket", bucket_of("doc_id")).select("_bucket", F.lit(False).alias("_guest"), "doc_id", "text")
    dealt = rows.unionByName(guests).repartition(partitions, "_bucket").sortWithinPartitions(
        "_bucket", F.desc("_guest"), F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    return dealt.mapInArrow(_edits, _SCHEMA)


def _signed(fps: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bits as 1 and -1, 0 after the end; number of bits) of each fingerprint."""
    bits = [parse_fingerprint(fp) for fp in fps]
    size = np.array([len(b) for b in bits], np.int64)
    out = np.zeros((len(fps), int(size.max(initial=0))))
    for row, b in zip(out, bits):
        row[:len(b)] = 2.0 * b - 1
    return out, size


def likenesses(a: list[str], b: list[str]) -> np.ndarray:
    """``likeness`` of each fingerprint of ``a`` with each of ``b`` (equal: all sums are whole numbers)."""
    both, size = _signed([*a, *b])
    width = both.shape[1]
    _sampled(width)
    weights = np.asarray(_weights[:width])
    total = np.concatenate([[1.0], np.cumsum(weights)])  # two empty ones are not asked for
    n = len(a)
    return np.maximum(0.0, (both[:n] * weights) @ both[n:].T / total[np.maximum(size[:n, None], size[None, n:])])


def _bucket_links(threshold: float):
    """Rows come by (key, i, j): all pairs of a bucket's part i with its part j."""

    def links(part: np.ndarray, i: int, j: int, ids: list[int], fps: list[str]) -> Iterator[tuple[int, int, float]]:
        own = np.flatnonzero(part == i)
        other = np.flatnonzero(part == j)
        if i == j and len(own) < 2 or not len(own) or not len(other):
            return
        found = likenesses([fps[k] for k in own], [fps[k] for k in other])
        for x, y in zip(*np.nonzero(found >= threshold)):
            p, q = ids[own[x]], ids[other[y]]
            if p != q and (i != j or x < y):
                yield max(p, q), min(p, q), float(found[x, y])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "other_id", "likeness"]
        task, held = None, []

        def flush() -> list[tuple[int, int, float]]:
            if len(held) < 2:
                return []
            ids, fps, part = zip(*held)
            return list(links(np.array(part), task[1], task[2], ids, fps))

        def batch_of(rows: list[tuple[int, int, float]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows) if rows else [[]] * 3, (pa.int64(), pa.int64(), pa.float64()))], names)

        for batch in batches:
            out: list[tuple[int, int, float]] = []
            columns = [batch.column(c).to_pylist() for c in ("key", "i", "j", "node", "fingerprint", "part")]
            for key, i, j, node, fp, part in zip(*columns):
                if (key, i, j) != task:
                    out += flush()
                    task, held = (key, i, j), []
                held.append((node, fp, part))
            yield batch_of(out)
        yield batch_of(flush())

    return run


def near_links(prints: DataFrame, threshold: float = 0.7, bands: int = 24, bits: int = 14) -> DataFrame:
    """Verified links between near fingerprints: (doc_id, other_id, likeness).

    A band is ``bits`` sampled bits of the last two levels of a fingerprint;
    all pairs that agree on a band are compared.  Equal fingerprints are one
    node, named by its smallest doc_id, which the others are linked with; a
    link between nodes stands for all their copies.  Empty fingerprints are
    linked with nothing.  Buckets above ``PART_PRINTS`` are dealt into parts
    and a task compares two of them, so tasks are bounded; the number of pairs
    grows with the square of a bucket of different fingerprints."""
    rng = np.random.default_rng(77)
    picks = [np.sort(rng.choice(2 * SAMPLES, bits, replace=False)) for _ in range(bands)]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, fp in zip(batch.column("node").to_pylist(), batch.column("fingerprint").to_pylist()):
                have = parse_fingerprint(fp)
                top = max(0, len(have) - 1) // SAMPLES
                for level in {top, max(top - 1, 0)}:
                    part = np.zeros(2 * SAMPLES, np.uint8)
                    own = have[max(level - 1, 0) * SAMPLES:(level + 1) * SAMPLES]
                    part[:len(own)] = own
                    rows += [(f"{level}/{b}/{part[p].tobytes().hex()}", node, fp) for b, p in enumerate(picks)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows) if rows else [[]] * 3, (pa.string(), pa.int64(), pa.string()))], ["key", "node", "fingerprint"])

    prints = prints.select("doc_id", "fingerprint").where("doc_id is not null and fingerprint <> '0:'")
    nodes = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("node")), "prints")
    copies = prints.join(nodes, "fingerprint").where("doc_id <> node").select(
        "doc_id", F.col("node").alias("other_id"), F.lit(1.0).alias("likeness"))
    banded = materialize(nodes.select("node", "fingerprint").mapInArrow(keys, "key string, node long, fingerprint string"), "bands")
    parts = F.ceil(F.count("*") / PART_PRINTS).cast("int")
    buckets = banded.groupBy("key").agg(F.count("*").alias("n"), parts.alias("parts")).where("n > 1").drop("n")
    # Part p meets itself, and each other part once, named by the smaller first.
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(
        F.least(x, F.col("part")).alias("i"), F.greatest(x, F.col("part")).alias("j")))).alias("task")
    dealt = banded.join(buckets, "key").withColumn("part", part).select("key", "node", "fingerprint", "part", meets).select(
        "key", "task.i", "task.j", "node", "fingerprint", "part")
    pairs = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        _bucket_links(threshold), "doc_id long, other_id long, likeness double")
    return copies.unionByName(pairs).distinct()


def op1_edit_fingerprint(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read_documents(spark, sf_dir, "doc_id", "text"))
