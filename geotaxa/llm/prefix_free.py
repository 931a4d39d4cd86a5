"""Exact removal of repeated strings by prefix-free parsing.

Every byte covered by a ``WINDOW``-byte string that also starts earlier (at a
smaller (doc_id, start)) is removed; strings are judged on the input.

*Parse.*  A rolling hash of ``GRAM`` bytes triggers the phrases: the trigger
of a window is its smallest hash (the first, if it is there twice), and
neighbouring windows with the same trigger are one phrase, together with the
bytes they reach.  The trigger depends on the window's bytes alone, so equal
windows lie at the same place of phrases with the same trigger, in whatever
text.  Phrases are dealt in about every 40 bytes.

*Dictionary order.*  Phrase occurrences are range-partitioned and sorted by
(trigger, phrase, doc_id, start): occurrences of one dictionary entry stand
together, and entries with the same trigger next to each other.  Each range
is read as a stream, with one row kept in memory:

* every occurrence of an entry but the first is repeated as a whole;
* an entry that shares its trigger with no other has no window elsewhere;
* the first occurrences of the others are *contested*: their bytes go to the
  task of their trigger, which compares their windows one by one; the windows
  of a trigger with very many phrases are sorted like the entries instead.

The order is by 64-bit hashes of trigger and phrase (suffixes only have to
meet their equals, not their alphabetical neighbours); a window of the corpus
order is named by 128 bits.  Repetitive text makes few entries, so the
contested part, the only one that is compared by window, stays small.

Copies inside one piece of a partition are settled there and only pass
through the sort under a key of their own, so a third of all rows with one
phrase or window reaches a task as one row a piece.  Ranges split a trigger
with many different phrases; entries at the ends of a range count as
contested, which costs work but changes nothing.

Defined cases: null texts are empty; a text shorter than a window keeps all;
rows that repeat a doc_id are one document (they do not remove each other);
rows without a doc_id have no place in the order, so they keep all their bytes
and remove none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.llm.text import Spans, buffer_of, mix, pieces, read_documents

WINDOW, GRAM = 100, 24
GROUP = 4096
_GRAMS = WINDOW - GRAM + 1
_PLACE = np.uint64((1 << 30) - 1)
_NAMES = ["g", "h", "doc", "place"]
_SCHEMA = "g long, h long, doc long, place long"
# place: start << 16 | windows << 9 | trigger's distance from the start << 1 | settled
_U = np.uint64


def _pack(start, windows, lead, settled):
    return start << 16 | windows << 9 | lead << 1 | settled


def phrases(spans: Spans, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, windows, distance of the trigger, trigger hash, phrase hash) of every phrase."""
    n = int(off[-1])
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, none, none
    at = np.arange(n - GRAM + 1)
    low = (spans.hash(at, at + GRAM) & ~_PLACE) | at.astype(_U)
    width = 1
    while 2 * width <= _GRAMS:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = _GRAMS - width
    low = np.minimum(low[:len(low) - rest], low[rest:])
    trigger = (low & _PLACE).astype(np.int64)  # of the window at each place
    inside = np.zeros(n - WINDOW + 2, np.int32)
    full = off[1:] - off[:-1] >= WINDOW
    inside[off[:-1][full]] += 1
    inside[off[1:][full] - WINDOW + 1] -= 1
    window = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(window):
        return none, none, none, none, none
    own = trigger[window]
    new = np.ones(len(window), bool)
    new[1:] = (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(window)))
    start, lead = window[first], own[first] - window[first]
    g = spans.hash(own[first], own[first] + GRAM)
    return start, count, lead, g.view(np.int64), spans.hash(start, start + count - 1 + WINDOW).view(np.int64)


def settle(g: np.ndarray, h: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows for the sort; of equal (g, h) only the first stays under that key."""
    order = np.lexsort((place, doc, h, g))
    g, h, doc, place = g[order], h[order], doc[order], place[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
    later = (doc != doc[head]) | (place >> 16 != place[head] >> 16)
    own = mix(doc.view(_U) * _U(31) + place.view(_U)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (
        np.where(later, own, g), np.where(later, 0, h), doc, np.where(later, place | 1, place))], _NAMES)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc").to_numpy()
        for lo, _, buf, off in pieces(*buffer_of(batch.column("text"))):
            start, count, lead, g, h = phrases(Spans(buf), off)
            row = np.searchsorted(off[1:], start, "right")
            yield settle(g, h, ids[lo + row], _pack(start - off[row], count, lead, 0))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contested phrases of each text."""
    for batch in batches:
        ids = batch.column("doc").to_numpy()
        lists = batch.column("phrases").to_pylist()
        buf, off = buffer_of(batch.column("text"))
        data = buf.tobytes()
        rows = [(x["g"], data[off[r] + (x["place"] >> 16):off[r] + (x["place"] >> 16) + (x["place"] >> 9 & 0x7F) - 1 + WINDOW],
                 ids[r], x["place"]) for r, found in enumerate(lists) for x in found]
        cells = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cells, (pa.int64(), pa.binary(), pa.int64(), pa.int64()))], ["g", "content", "doc", "place"])


def _windows(g: np.ndarray, contents: list[bytes], doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """(name, hash, doc, place) of every window of the phrases; the name holds
    the trigger and its distance, so only equal windows agree on both."""
    spans = Spans(np.frombuffer(b"".join(contents), np.uint8))
    begin = np.concatenate([[0], np.cumsum([len(c) for c in contents])])[:-1]
    count = place >> 9 & 0x7F
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(begin, count) + step
    lead = np.repeat(place >> 1 & 0xFF, count) - step
    name = mix(np.repeat(g, count).view(_U) + lead.astype(_U)).view(np.int64)
    start = np.repeat(place >> 16, count) + step
    return name, spans.hash(at, at + WINDOW).view(np.int64), np.repeat(doc, count), _pack(start, 1, 0, 0)


def _repeated(name: np.ndarray, h: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, place) of the windows that occur earlier among these, in runs."""
    order = np.lexsort((place, doc, h, name))
    name, h, doc, place = name[order], h[order], doc[order], place[order]
    first = np.ones(len(name), bool)
    first[1:] = (name[1:] != name[:-1]) | (h[1:] != h[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(name)), 0))
    later = (doc != doc[head]) | (place != place[head])
    doc, start = doc[later], place[later] >> 16
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    run = np.flatnonzero(new)
    # Runs longer than the field holds go on in the next row.
    new[np.flatnonzero(~new)[(np.flatnonzero(~new) - run[np.cumsum(new)[~new] - 1]) % 100 == 0]] = True
    run = np.flatnonzero(new)
    return doc[run], _pack(start[run], np.diff(np.append(run, len(doc))), 0, 0)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by trigger.  Phrases of one trigger are compared window
    by window in memory, many triggers at once; a trigger with more than
    ``GROUP`` phrases gives its windows to a sort of their own instead."""

    def settled(doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        name = mix(doc.view(_U) * _U(31) + place.view(_U)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (name, np.zeros(len(doc), np.int64), doc, place | 1)], _NAMES)

    held, hot = None, None
    for batch in batches:
        rows = [batch.column("g").to_numpy(), batch.column("content").to_pylist(),
                batch.column("doc").to_numpy(), batch.column("place").to_numpy()]
        if not len(rows[0]):
            continue
        if held is not None:
            rows = [np.concatenate([held[0], rows[0]]), held[1] + rows[1],
                    np.concatenate([held[2], rows[2]]), np.concatenate([held[3], rows[3]])]
        if hot is not None and rows[0][0] == hot:
            n = int(np.searchsorted(rows[0] != hot, True)) if (rows[0] != hot).any() else len(rows[0])
            yield settle(*_windows(rows[0][:n], rows[1][:n], rows[2][:n], rows[3][:n]))
            rows = [x[n:] for x in rows]
        while len(rows[0]):
            last = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1 if (rows[0] != rows[0][-1]).any() else 0
            if last:
                take = min(last, GROUP)
                while take < last and rows[0][take] == rows[0][take - 1]:
                    take += 1
                yield settled(*_repeated(*_windows(*[x[:take] for x in rows])))
                rows = [x[take:] for x in rows]
                continue
            if len(rows[0]) > GROUP:
                hot = rows[0][0]
                yield settle(*_windows(*rows))
                rows = [x[:0] for x in rows]
            break
        held = rows if len(rows[0]) else None
    if held is not None:
        yield settled(*_repeated(*_windows(*held)))


def _stream(batches: Iterator[pa.RecordBatch], contested: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted.  Gives (doc, place, g), g null for repeated windows."""

    def rows(repeated: tuple, open_: tuple) -> pa.RecordBatch:
        doc, place = (np.concatenate(x) for x in zip(repeated, open_[:2]))
        g = np.concatenate([np.zeros(len(repeated[0]), np.int64), open_[2]])
        null = np.arange(len(g)) < len(repeated[0])
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(place), pa.array(g, mask=null)], ["doc", "place", "g"])

    none = np.zeros(0, np.int64)
    last = None      # (g, h, doc, start of the entry's first occurrence)
    pending = None   # first entry of a trigger, until a second one is seen
    edge = None      # the range's first trigger
    for batch in batches:
        g, h, doc, place = (batch.column(c).to_numpy() for c in _NAMES)
        settled = (place & 1) > 0
        out = [(doc[settled], place[settled])]
        g, h, doc, place = g[~settled], h[~settled], doc[~settled], place[~settled]
        if not len(g):
            yield rows(out[0], (none, none, none))
            continue
        start = place >> 16
        first = np.ones(len(g), bool)
        first[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
        first[0] = last is None or (g[0], h[0]) != last[:2]
        head = np.maximum.accumulate(np.where(first, np.arange(len(g)), -1))
        known = head >= 0
        first_doc = np.where(known, doc[head], last[2] if last else 0)
        first_start = np.where(known, start[head], last[3] if last else 0)
        later = (doc != first_doc) | (start != first_start)
        repeated = tuple(np.concatenate(x) for x in zip(out[0], (doc[later], place[later])))
        open_ = (none, none, none)
        if contested:
            at = np.flatnonzero(first)
            edge = g[0] if edge is None else edge
            before = np.concatenate([[last[0] if last else g[0]], g[at][:-1]]) if len(at) else none
            same = (g[at] == before) & ((np.arange(len(at)) > 0) | (last is not None))
            shared = same.copy()
            shared[:-1] |= same[1:]
            shared |= g[at] == edge
            extra = (none, none, none)
            if pending is not None and len(at):
                if same[0]:
                    extra = tuple(np.array([x]) for x in pending)
                pending = None
            if len(at) and not shared[-1]:
                pending = (doc[at[-1]], place[at[-1]], g[at[-1]])
            keep = at[shared]
            open_ = tuple(np.concatenate(x) for x in zip(extra, (doc[keep], place[keep], g[keep])))
        last = (g[-1], h[-1], int(first_doc[-1]), int(first_start[-1]))
        yield rows(repeated, open_)
    if pending is not None:
        yield rows((none, none), tuple(np.array([x]) for x in pending))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _stream(batches, True)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _stream(batches, False)


def removed_mask(n: int, places: np.ndarray) -> np.ndarray:
    """Bytes of a text covered by the windows that ``places`` name."""
    edge = np.zeros(n + 1, np.int32)
    start = np.minimum(places >> 16, n)  # beyond only if rows of one doc_id differ in text
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + (places >> 9 & 0x7F) - 1 + WINDOW, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        places = batch.column("places").to_pylist()
        buf, off = buffer_of(batch.column("text"))
        for r, found in enumerate(places):
            text = buf[off[r]:off[r + 1]]
            gone = removed_mask(len(text), np.array(found or [], np.int64))
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
            kept = text[~gone].tobytes()
            out.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        cells = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), *[pa.array(c, t) for c, t in zip(cells, kinds)]],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    and ``kept``, the remaining bytes."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    # Both joins below filter null ids the same way, so they share one shuffle
    # of the text; rows without an id are added at the end.
    keyed = texts.where("doc is not null")
    parsed = keyed.mapInArrow(_parse, _SCHEMA)
    entries = parsed.repartitionByRange(partitions, "g", "h").sortWithinPartitions("g", "h", "doc", "place") \
        .mapInArrow(_entries, "doc long, place long, g long")
    marked = entries.groupBy("doc").agg(
        F.collect_list(F.when(F.col("g").isNull(), F.col("place"))).alias("places"),
        F.collect_list(F.when(F.col("g").isNotNull(), F.struct("place", "g"))).alias("phrases"))
    dealt = keyed.repartition(partitions, "doc")
    contents = dealt.join(marked, "doc").where(F.size("phrases") > 0) \
        .select("doc", "text", "phrases").mapInArrow(_contents, "g long, content binary, doc long, place long")
    windows = contents.repartition(partitions, "g").sortWithinPartitions("g").mapInArrow(_resolve, _SCHEMA)
    again = windows.repartition(partitions, "g", "h").sortWithinPartitions("g", "h", "doc", "place") \
        .mapInArrow(_repeats, "doc long, place long, g long")
    more = again.groupBy("doc").agg(F.collect_list("place").alias("more"))
    empty = F.array().cast("array<long>")
    found = dealt.join(marked, "doc", "left").join(more, "doc", "left").select(
        "doc", "text", F.concat(F.coalesce("places", empty), F.coalesce("more", empty)).alias("places"))
    return found.unionByName(texts.where("doc is null").withColumn("places", empty)) \
        .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op4_prefix_free(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read_documents(spark, sf_dir, "doc_id", "text")).drop("kept")
