"""Prefix trie of conversations: union-find over sorted-neighbour LCP edges.

Every conversation is a sequence of turns; each distinct sequence of its first
d turns is a node of depth d.  Nodes are not found by grouping prefixes: whole
conversations are sorted, and the trie follows from the depths at which
neighbours part.

1. *Turns.*  A turn becomes the first 128 bits of its SHA-256 and its word
   count; texts are never shuffled.  Turns are range-sorted by (conversation,
   turn), so one with a third of all rows lies in many partitions.  Each
   partition scans its rows once (place, prefix fingerprint, words so far);
   what a partition adds to a conversation that goes on from the one before is
   carried over in a table of one row a partition.  A prefix fingerprint is the
   sum of turn times base to its place, modulo 2^64, twice: it moves by an
   offset, a factor and nothing else, so rebuilt conversations need no rescan.
2. *Leaves.*  Conversations with equal fingerprints and lengths are one leaf;
   their ids are range-sorted and hashed as a stream.
3. *Sorted neighbours.*  A leaf's key is the row of its prefix fingerprints; it
   is cut where no other leaf shares the prefix (tested at 64, 128, 256, ...
   turns), so a key is at most twice as long as the longest prefix that two
   different conversations share, and long private tails never meet in a row.
   Keys are range-sorted; the LCP of two neighbours is an edge of that depth.
4. *Union-find.*  Within a partition edges are taken in descending depth (a
   stack of open components does that in one pass over the sorted leaves).
   Every merge of components creates a branching node.  A component that can
   still grow across an end of the partition is *contracted* to its sums; the
   contracted forests of 64 partitions are merged across their boundaries by
   the same pass, then those of 64 such groups, until one is left.
5. *Chains.*  The nodes between a branching node and its parent have its
   members, so their values follow from the words along its smallest member.

Rows per task are bounded everywhere but in two places that the result asks
for: the ids of one node's ends are hashed in order by one task (as slices of
65,536 ids, not as rows), and rows that are equal in conversation, turn and
content cannot be split.

Defined cases: null role and text are empty; a null turn comes first, equal
turns are ordered by the SHA-256 of ``<length of role>:<role><text>``, equal
rows are separate turns; rows without a conv_id are left out; a table without
conversations has no nodes, not even the root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.session import materialize

SHARE = 20              # conversations that begin like c - c % SHARE
HEADS = 3               # the most turns taken from there
CUT = 64                # first depth at which shared prefixes are tested
GROUP = 64              # forests merged by one task
SLICE = 1 << 16         # ids of one row of an unfinished hash
BUCKET = 256            # depths of one join bucket of the output
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def _power(exponent: int) -> int:
    return pow(_BASE, exponent, 1 << 64) if exponent >= 0 else pow(_INVERSE, -exponent, 1 << 64)


def _powers(exponents: np.ndarray) -> np.ndarray:
    """Base to each exponent; few distinct values."""
    values, at = np.unique(exponents, return_inverse=True)
    return np.array([_power(int(e)) for e in values], _U)[at]


def _u(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(_U)


def _i(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _batch(**columns) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == _U else c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


# ---------------------------------------------------------------- turns
def turn_rows(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(content, 256), 1, 32)).alias("token"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("x"))


_TURNS = "pid long, conv long, k long, f1 long, f2 long, w long, x long, last boolean, edge boolean"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> place, fingerprint and words so far within this
    partition.  ``last`` marks the last row of a conversation here, ``edge``
    that row of the first and the last conversation of the partition."""
    pid = TaskContext.get().partitionId()
    held, rows, opening = None, None, None

    def out(rows: list[np.ndarray], last: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        conv, k, f1, f2, w, x = rows
        return _batch(pid=np.full(len(conv), pid, np.int64), conv=conv, k=k, f1=f1, f2=f2, w=w, x=x, last=last, edge=edge)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv, x = _i(batch, "conv"), _i(batch, "x")
        token = np.frombuffer(b"".join(batch.column("token").to_pylist()), ">u8").astype(_U).reshape(n, 2)
        at = np.arange(n)
        new = np.ones(n, bool)
        new[1:] = conv[1:] != conv[:-1]
        new[0] = held is None or conv[0] != held[0]
        start = np.maximum.accumulate(np.where(new, at, -1))
        goes_on = start < 0
        k = at - np.where(goes_on, 0, start) + 1
        power = np.cumprod(np.full(n, _BASE, _U), dtype=_U)[k - 1]

        def so_far(values: np.ndarray) -> np.ndarray:
            total = np.cumsum(values, dtype=values.dtype)
            return total - np.where(start > 0, total[start - 1], values.dtype.type(0))

        f = [so_far(token[:, j] * power) for j in (0, 1)]
        w = so_far(x)
        if goes_on.any():
            factor = np.where(goes_on, _U(_power(held[1])), _U(1))
            f = [np.where(goes_on, _U(held[2 + j]), _U(0)) + factor * f[j] for j in (0, 1)]
            k, w = k + np.where(goes_on, held[1], 0), w + np.where(goes_on, held[4], 0)
        held = (int(conv[-1]), int(k[-1]), int(f[0][-1]), int(f[1][-1]), int(w[-1]))
        opening = int(conv[0]) if opening is None else opening
        own = [conv, k, f[0], f[1], w, x]
        rows = own if rows is None else [np.concatenate(p) for p in zip(rows, own)]
        last = rows[0][1:] != rows[0][:-1]
        yield out([r[:-1] for r in rows], last, last & (rows[0][:-1] == opening))
        rows = [r[-1:] for r in rows]
    if rows is not None:
        yield out(rows, np.ones(1, bool), np.ones(1, bool))


def _carry(chunks: pd.DataFrame) -> pd.DataFrame:
    """What earlier partitions hold of one conversation, for each of its partitions."""
    out, n, f1, f2, w = [], 0, 0, 0, 0
    for c in chunks.sort_values("pid").itertuples():
        out.append((c.pid, c.conv, n, *(f - (1 << 64) if f >> 63 else f for f in (f1, f2)), w))
        f1, f2 = ((f + _power(n) * int(g)) & _MASK for f, g in ((f1, c.f1), (f2, c.f2)))
        n, w = n + int(c.k), w + int(c.w)
    return pd.DataFrame(out, columns=["pid", "conv", "cn", "c1", "c2", "cw"])


def _whole(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Place, fingerprints and words so far in the whole conversation."""
    factor = _powers(_i(batch, "cn"))
    f1, f2 = (_u(batch, f"c{j}") + factor * _u(batch, f"f{j}") for j in (1, 2))
    return _i(batch, "cn") + _i(batch, "k"), f1, f2, _i(batch, "cw") + _i(batch, "w")


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        r, f1, f2, w = _whole(batch)
        yield _batch(conv=_i(batch, "conv"), r=r, f1=f1, f2=f2, w=w)


# ---------------------------------------------------------------- rebuilt conversations
_REBUILT = ("conv long, h long, kb long, len long, m long, o1 long, o2 long, ow long, b1 long, b2 long, bw long, "
            "e1 long, e2 long, ew long, " + ", ".join(f"h{j}1 long, h{j}2 long, h{j}w long" for j in range(1, HEADS + 1)))


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation: turns taken from its base (kb), length, the factor and
    offsets that turn its own prefix values into rebuilt ones, values at the end."""
    for batch in batches:
        h, n, bn = (_i(batch, c) for c in ("h", "n", "bn"))
        kb, more = np.minimum(h, bn), np.maximum(n - h, 0)
        at = np.arange(len(h))

        def head(prefix: str, place: np.ndarray, part: str, of) -> np.ndarray:
            table = np.stack([np.zeros(len(h), np.int64), *[_i(batch, f"{prefix}{j}{part}") for j in range(1, HEADS + 1)]])
            return of(table[place, at])

        unsigned = lambda v: v.view(_U)
        same = lambda v: v
        place = np.where(more > 0, h, 0)
        o1, o2, ow = head("s", place, "1", unsigned), head("s", place, "2", unsigned), head("s", place, "w", same)
        b1, b2, bw = head("b", kb, "1", unsigned), head("b", kb, "2", unsigned), head("b", kb, "w", same)
        m = _powers(kb - h)
        e1, e2 = (np.where(more > 0, b + m * (_u(batch, t) - o), b) for b, t, o in ((b1, "t1", o1), (b2, "t2", o2)))
        ew = np.where(more > 0, bw + _i(batch, "tw") - ow, bw)
        heads = {f"h{j}{p}": _i(batch, f"b{j}{p}") for j in range(1, HEADS + 1) for p in "12w"}
        yield _batch(conv=_i(batch, "conv"), h=h, kb=kb, len=kb + more, m=m, o1=o1, o2=o2, ow=ow, b1=b1, b2=b2, bw=bw,
                     e1=e1, e2=e2, ew=ew, **heads)


def _path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns after the first h as rows of the rebuilt conversation."""
    for batch in batches:
        r, f1, f2, w = _whole(batch)
        h, m = _i(batch, "h"), _u(batch, "m")
        keep = r > h
        g1, g2 = (_u(batch, f"b{j}") + m * (f - _u(batch, f"o{j}")) for j, f in ((1, f1), (2, f2)))
        rows = (_i(batch, "conv"), _i(batch, "kb") + r - h, g1, g2, _i(batch, "bw") + w - _i(batch, "ow"), _i(batch, "x"))
        yield _batch(**dict(zip(("conv", "d", "g1", "g2", "w", "x"), (c[keep] for c in rows))))


# ---------------------------------------------------------------- leaves
_CLASSES = "e1 long, e2 long, len long, conv long, copies long, ids binary, sha string"


def _classes(slice_ids: int):
    """Rows sorted by (e1, e2, len, conv) -> one row per leaf with the hash of
    its ids.  Leaves at an end of the partition, and very large ones, give
    slices of their ids instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sliced, rows = None, [], True, []

        def close(part: bool) -> None:
            text = ",".join(map(str, ids)).encode()
            rows.append((*key, ids[0], len(ids), text if part else None, None if part else hashlib.sha256(text).hexdigest()))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.binary(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                              ["e1", "e2", "len", "conv", "copies", "ids", "sha"])

        for batch in batches:
            for e1, e2, length, conv in zip(*(batch.column(c).to_pylist() for c in ("e1", "e2", "len", "conv"))):
                if (e1, e2, length) != key:
                    if key is not None:
                        close(sliced)
                        sliced = False
                    key, ids = (e1, e2, length), []
                elif len(ids) == slice_ids:
                    close(True)
                    ids, sliced = [], True
                ids.append(conv)
            yield flush()
            rows = []
        if key is not None:
            close(True)
            yield flush()

    return run


def _finish_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices sorted by (e1, e2, len, conv) -> (conv, copies, sha)."""
    key, first, copies, sha, rows = None, None, 0, None, []
    for batch in batches:
        for e1, e2, length, conv, n, ids in zip(*(batch.column(c).to_pylist() for c in ("e1", "e2", "len", "conv", "copies", "ids"))):
            if (e1, e2, length) != key:
                if key is not None:
                    rows.append((first, copies, sha.hexdigest()))
                key, first, copies, sha = (e1, e2, length), conv, 0, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids)
            copies += n
    if key is not None:
        rows.append((first, copies, sha.hexdigest()))
    columns = list(zip(*rows)) if rows else [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                     ["conv", "copies", "sha"])


def leaves_of(rebuilt: DataFrame, partitions: int, slice_ids: int = SLICE) -> DataFrame:
    """(conv, copies, sha): the smallest conversation of each group of equal
    ones, their number and the hash of their ids."""
    order = ["e1", "e2", "len", "conv"]
    found = rebuilt.select(*order).repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(_classes(slice_ids), _CLASSES)
    found = materialize(found, "leaves")
    parts = found.where("sha is null").repartition(partitions, "e1", "e2", "len").sortWithinPartitions(*order)
    return found.where("sha is not null").select("conv", "copies", "sha").unionByName(
        parts.mapInArrow(_finish_classes, "conv long, copies long, sha string"))


_LEAVES = "conv long, d long, g1 long, g2 long, w long, copies long, sha string, key binary, ws binary"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A leaf's path as bytes: 16 per turn of fingerprint, 8 of words so far."""
    for batch in batches:
        path = batch.column("path")
        row = np.repeat(np.arange(len(path)), path.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        turn = path.flatten()
        d, g1, g2, w = (turn.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        order = np.lexsort((d, row))
        order = order[d[order] > 0]
        end = np.concatenate([[0], np.cumsum(np.bincount(row[order], minlength=len(path)))])
        key = np.stack([g1[order], g2[order]], axis=1).astype(">i8").tobytes()
        ws = w[order].astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("conv", "d", "g1", "g2", "w", "copies", "sha")],
             pa.array([key[16 * a:16 * b] for a, b in zip(end[:-1], end[1:])], pa.binary()),
             pa.array([ws[8 * a:8 * b] for a, b in zip(end[:-1], end[1:])], pa.binary())],
            ["conv", "d", "g1", "g2", "w", "copies", "sha", "key", "ws"])


# ---------------------------------------------------------------- union-find
_FOREST = ("node boolean, unit long, seq long, d long, g1 long, g2 long, w long, n long, conv long, kids long, leaves long, "
           "saved long, sha string, pd long, p1 long, p2 long, lcp long, key binary, ws binary")
_FIELDS = [f.split()[0] for f in _FOREST.split(", ")]
_KINDS = [{"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in _FOREST.split(", ")]


def lcp(a: bytes, b: bytes) -> int:
    """Equal leading turns of two keys."""
    lo, hi = 0, min(len(a), len(b)) // 16
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[16 * lo:16 * mid] == b[16 * lo:16 * mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class Component:
    """A node and the sums over those of its subtrees that are closed."""

    __slots__ = ("d", "g1", "g2", "w", "n", "conv", "kids", "leaves", "saved", "sha", "open")

    def __init__(self, d, g1, g2, w, n=0, conv=None, kids=0, leaves=0, saved=0, sha=None):
        self.d, self.g1, self.g2, self.w, self.n, self.conv = d, g1, g2, w, n, conv
        self.kids, self.leaves, self.saved, self.sha, self.open = kids, leaves, saved, sha, False

    def count(self, n: int, conv: int | None) -> None:
        self.n += n
        if conv is not None:
            self.conv = conv if self.conv is None else min(self.conv, conv)

    def merge(self, other: Component) -> None:
        """Another part of the same node."""
        self.count(other.n, other.conv)
        self.kids, self.leaves, self.saved = self.kids + other.kids, self.leaves + other.leaves, self.saved + other.saved
        self.sha = self.sha or other.sha


class Forest:
    """Union-find over one run of sorted components.

    ``stack`` holds the components that edges can still reach, from the
    shallowest to the deepest; an edge of depth l closes all deeper ones, the
    deepest first, and each close is a merge.  ``whole`` says that nothing lies
    before or behind the run; otherwise components that reach its first or its
    last member are contracted to items of the next round."""

    def __init__(self, unit: int, whole: bool):
        self.unit, self.whole = unit, whole
        self.stack: list[Component] = []
        self.items: list[Component] = []
        self.rows: list[tuple] = []
        self.first = self.last = (b"", b"")

    def _row(self, node: bool, c: Component, **more) -> None:
        values = dict(node=node, unit=self.unit, d=c.d, g1=c.g1, g2=c.g2, w=c.w, n=c.n, conv=c.conv, kids=c.kids,
                      leaves=c.leaves, saved=c.saved, sha=c.sha) | more
        self.rows.append(tuple(values.get(f) for f in _FIELDS))

    def close(self, child: Component, parent: Component) -> None:
        if child.open:
            self.items.append(child)
            parent.open = True
            return
        child.leaves = child.leaves if child.kids else 1
        parent.count(child.n, child.conv)
        parent.kids += 1
        parent.leaves += child.leaves
        parent.saved += child.saved + (child.n - 1) * (child.w - parent.w)
        self._row(True, child, pd=parent.d, p1=parent.g1, p2=parent.g2)

    def at(self, depth: int, key: bytes, ws: bytes) -> Component:
        """A bare component for the node of ``depth`` on a path."""
        if depth == 0:
            return Component(0, 0, 0, 0)
        g1, g2 = np.frombuffer(key, ">i8", 2, 16 * (depth - 1)).tolist()
        return Component(depth, g1, g2, int(np.frombuffer(ws, "<i8", 1, 8 * (depth - 1))[0]))

    def add(self, c: Component, edge: int | None, path: tuple[bytes, bytes] = (b"", b"")) -> None:
        """The next component; ``edge`` is its LCP with the one before, ``path``
        the key that holds the node there unless the component is that node."""
        if edge is None:
            c.open = not self.whole
            self.stack.append(c)
            return
        stack = self.stack
        while stack[-1].d > edge:
            child = stack.pop()
            if not stack or stack[-1].d < edge:
                stack.append(Component(edge, c.g1, c.g2, c.w) if c.d == edge else self.at(edge, *path))
            self.close(child, stack[-1])
        if c.d == edge:
            stack[-1].merge(c)
        else:
            stack.append(c)

    def finish(self) -> None:
        if not self.stack:
            return
        if self.whole:
            if self.stack[0].d > 0:
                self.stack.insert(0, Component(0, 0, 0, 0))
            while len(self.stack) > 1:
                child = self.stack.pop()
                self.close(child, self.stack[-1])
            root = self.stack.pop()
            root.leaves = root.leaves if root.kids else 1
            self._row(True, root)
            return
        valley = len(self.items)
        items = self.items + self.stack
        for seq, c in enumerate(items):
            edge = None if seq == 0 else c.d if seq <= valley else items[seq - 1].d
            self._row(False, c, seq=seq, lcp=edge, **dict(zip(("key", "ws"), self.first)) if seq == 0 else {})
        # The last leaf's path stands in a row of its own behind the items.
        self._row(False, items[-1], seq=len(items), d=None, **dict(zip(("key", "ws"), self.last)))
        self.stack, self.items = [], []

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * len(_FIELDS)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], _FIELDS)


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted leaves of one partition -> nodes and contracted items."""
    forest = Forest(TaskContext.get().partitionId(), False)
    before = None
    for batch in batches:
        for conv, d, g1, g2, w, copies, sha, key, ws in zip(*(batch.column(c).to_pylist() for c in (
                "conv", "d", "g1", "g2", "w", "copies", "sha", "key", "ws"))):
            leaf = Component(d, g1, g2, w, copies, conv, sha=sha)
            forest.add(leaf, None if before is None else lcp(before[0], key), before or (b"", b""))
            if before is None:
                forest.first = (key, ws)
            before = forest.last = (key, ws)
        yield forest.flush()
    forest.finish()
    yield forest.flush()


def _merge_across(level: int, whole: bool, size: int):
    """Items sorted by (unit, seq) -> nodes and items of groups of ``size`` units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, group = None, None
        for batch in batches:
            for row in batch.to_pylist():
                unit = (row["unit"] & 0xFFFFFFFF) // size
                if unit != group:
                    if forest:
                        forest.finish()
                        yield forest.flush()
                    forest, group = Forest(level << 32 | unit, whole), unit
                path = (row["key"], row["ws"])
                if row["d"] is None:
                    forest.last = path
                    continue
                c = Component(*(row[f] for f in ("d", "g1", "g2", "w", "n", "conv", "kids", "leaves", "saved", "sha")))
                if row["seq"] > 0:
                    forest.add(c, row["lcp"])
                elif forest.stack:
                    forest.add(c, lcp(forest.last[0], path[0]), path)
                else:
                    forest.first = path
                    forest.add(c, None)
            yield forest.flush() if forest else Forest(0, False).flush()
        if forest:
            forest.finish()
            yield forest.flush()

    return run


def branching_nodes(leaves: DataFrame, partitions: int, size: int = GROUP) -> DataFrame:
    """All branching nodes and leaves of the trie, with ``pconv``, the smallest
    member of each one's parent (null at the root)."""
    grown = leaves.repartitionByRange(partitions, "key").sortWithinPartitions("key").mapInArrow(_grow, _FOREST)
    rounds = [materialize(grown, "forest")]
    units, level = partitions, 0
    while not rounds[1:] or units > 1:
        level += 1
        units = -(-units // size)
        group = F.expr(f"(unit & 4294967295) div {size}")
        items = rounds[-1].where("not node").withColumn("_group", group)
        dealt = items.repartition(units, "_group").sortWithinPartitions("unit", "seq").drop("_group")
        rounds.append(materialize(dealt.mapInArrow(_merge_across(level, units == 1, size), _FOREST), "forest"))
    nodes = rounds[0].where("node")
    for more in rounds[1:]:
        nodes = nodes.unionByName(more.where("node"))
    # A parent's smallest member goes to each unit that closed children of it
    # once, then to those children: a parent of very many is spread by unit.
    asked = nodes.where("pd is not null").select("unit", "p1", "p2").distinct()
    known = nodes.select(F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("conv").alias("pconv"))
    return nodes.join(asked.join(known, ["p1", "p2"]), ["unit", "p1", "p2"], "left")


# ---------------------------------------------------------------- the trie
def prefix_trie(conversations: DataFrame, size: int = GROUP, slice_ids: int = SLICE) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  ``size``
    partitions' forests are merged by one task, ``slice_ids`` ids make a slice."""
    spark = conversations.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = ["conv", "turn", "token"]
    turns = materialize(turn_rows(conversations).repartitionByRange(partitions, *sort).sortWithinPartitions(*sort)
                        .mapInArrow(_scan, _TURNS), "turns")
    chunks = turns.where("last").select("pid", "conv")
    carry = turns.where("edge").select("pid", "conv", "k", "f1", "f2", "w").groupBy("conv").applyInPandas(
        _carry, "pid long, conv long, cn long, c1 long, c2 long, cw long")
    carry = materialize(carry.where("cn > 0"), "carry")

    heads = turns.where(f"k <= {HEADS} or last").join(carry, ["pid", "conv"], "left").mapInArrow(
        _heads, "conv long, r long, f1 long, f2 long, w long")
    at = lambda j, c, name: F.max(F.when(F.col("r") == j, F.col(c))).alias(name)
    own = materialize(heads.groupBy("conv").agg(
        F.max("r").alias("n"), *[F.max_by(c, "r").alias(t) for c, t in (("f1", "t1"), ("f2", "t2"), ("w", "tw"))],
        *[at(j, c, f"s{j}{p}") for j in range(1, HEADS + 1) for c, p in (("f1", "1"), ("f2", "2"), ("w", "w"))]), "heads")
    base = own.select(F.col("conv").alias("base"), F.col("n").alias("bn"),
                      *[F.col(f"s{j}{p}").alias(f"b{j}{p}") for j in range(1, HEADS + 1) for p in "12w"])
    begun = own.withColumn("base", F.col("conv") - F.col("conv") % SHARE) \
               .withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % (HEADS + 1))
    rebuilt = materialize(begun.join(base, "base", "left").mapInArrow(_rebuild, _REBUILT), "rebuilt")

    leaves = materialize(rebuilt.join(leaves_of(rebuilt, partitions, slice_ids), "conv"), "leaves")
    info = leaves.select("conv", "h", "kb", "m", "o1", "o2", "ow", "b1", "b2", "bw")
    placed = chunks.join(info, "conv").join(carry, ["pid", "conv"], "left")
    behind = turns.select("pid", "conv", "k", "f1", "f2", "w", "x").join(placed, ["pid", "conv"]).mapInArrow(
        _path, "conv long, d long, g1 long, g2 long, w long, x long")
    zero = F.lit(0).cast("long")
    taken = [F.struct(zero.alias("d"), zero.alias("g1"), zero.alias("g2"), zero.alias("w"), zero.alias("x"))]
    for j in range(1, HEADS + 1):
        words = F.col(f"h{j}w") - (F.col(f"h{j - 1}w") if j > 1 else 0)
        taken.append(F.struct(F.lit(j).cast("long").alias("d"), F.col(f"h{j}1").alias("g1"), F.col(f"h{j}2").alias("g2"),
                              F.col(f"h{j}w").alias("w"), words.alias("x")))
    front = leaves.select("conv", F.explode(F.filter(F.array(*taken), lambda t: t["d"] <= F.col("kb"))).alias("t")).select("conv", "t.*")
    paths = materialize(behind.unionByName(front), "paths")

    tested = paths.where(f"d >= {CUT} and d % {CUT} = 0 and bit_count(d div {CUT}) = 1")
    shared = own_prefix(tested)
    cut = paths.join(shared, "conv", "left").where(F.col("d") <= F.coalesce("cut", F.lit(CUT)))
    collected = cut.groupBy("conv").agg(F.collect_list(F.struct("d", "g1", "g2", "w")).alias("path"))
    ends = leaves.select("conv", F.col("len").alias("d"), F.col("e1").alias("g1"), F.col("e2").alias("g2"),
                         F.col("ew").alias("w"), "copies", "sha")
    nodes = branching_nodes(ends.join(collected, "conv").mapInArrow(_keys, _LEAVES), partitions, size)

    parts = nodes.select("conv", F.coalesce(F.col("pd") + 1, zero).alias("lo"), F.col("d").alias("hi"), "n", "kids", "leaves",
                         "saved", F.col("w").alias("hw"), "sha", "pconv")
    parts = parts.withColumn("bucket", F.explode(F.sequence(F.expr(f"lo div {BUCKET}"), F.expr(f"hi div {BUCKET}"))))
    rows = paths.select("conv", "d", "w", "x", F.expr(f"d div {BUCKET}").alias("bucket"))
    rows = rows.join(parts, ["conv", "bucket"]).where("d between lo and hi")
    top = F.col("d") == F.col("hi")
    return rows.select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") == 0, None).when(F.col("d") == F.col("lo"), F.col("pconv")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(top, F.col("kids")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + (F.col("n") - 1) * (F.col("hw") - F.col("w") + F.col("x"))).alias("saved_tokens"),
        F.when(top, F.coalesce("sha", F.lit(EMPTY_SHA))).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"))


def own_prefix(tested: DataFrame) -> DataFrame:
    """(conv, cut): for conversations that share a tested prefix with another
    leaf, twice the longest of them; the prefix of that length is their own."""
    common = tested.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("g1", "g2")
    return tested.join(common, ["g1", "g2"], "left_semi").groupBy("conv").agg((2 * F.max("d")).alias("cut"))


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


def oracle_sql() -> str:
    """Prefixes as lists of hashed turns; CRC-32 bit by bit."""
    # Codes below 256 are bytes to take in, 256 is one shift of the register.
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''),
    lambda c: list_prepend(ascii(c)::bigint, [256, 256, 256, 256, 256, 256, 256, 256])))),
    lambda r, v: case when v < 256 then xor(r, v) when r % 2 = 1 then xor(r >> 1, 3988292384) else r >> 1 end))"""
    return f"""
with turns as (select conv_id, sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as t,
  len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as x, turn from conversations where conv_id is not null),
own as (select conv_id, list(t order by turn nulls first, t) as ts, list(x order by turn nulls first, t) as xs from turns group by conv_id),
h as (select *, ({crc}) % 4 as h from own),
rebuilt as (select h.conv_id, list_concat(coalesce(b.ts[1:h.h], []), h.ts[h.h + 1:]) as ts,
  list_concat(coalesce(b.xs[1:h.h], []), h.xs[h.h + 1:]) as xs from h left join own b on b.conv_id = h.conv_id - h.conv_id % {SHARE}),
paths as (select conv_id, unnest(range(0, len(ts) + 1)) as d, ts, xs from rebuilt),
keyed as (select conv_id, d, d = len(ts) as ends, array_to_string(ts[1:d], '') as p, array_to_string(ts[1:d - 1], '') as up,
  case when d = 0 then 0 else xs[d] end as x from paths),
nodes as (select p, min(conv_id) as conv_id, any_value(d) as depth, any_value(up) as up, count(*) as n, any_value(x) as x,
  sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256 from keyed group by p),
kids as (select up as p, count(*) as n_children from nodes where depth > 0 group by up),
full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (p)),
sums as (select k.p, sum(case when f.n_children = 0 then 1 else 0 end) as n_leaves, sum((f.n - 1) * f.x) as saved_tokens
  from full_nodes f join keyed k on k.conv_id = f.conv_id and k.d <= f.depth group by k.p)
select f.conv_id, f.depth::bigint as depth, u.conv_id as parent_conv_id, f.n as n_convs, f.n_children::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, f.ends_sha256
from full_nodes f join sums s using (p) left join nodes u on f.depth > 0 and u.p = f.up"""
