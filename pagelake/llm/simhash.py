"""Operator 4: SimHash near-duplicate groups by bit-sliced comparison.

Fingerprints: a bit is set where more than half of a text's shingle hashes have
it.  Distinct fingerprints are cut into ``radius + 1`` bands; two of them within
the radius agree in one band at least, so comparing within bands finds every
link.  A band's members lie in blocks of 64 lanes whose 64 bit planes are held
vertically: one XOR per plane feeds the distances of 64 pairs into carry-save
counters, and a (query, block) task is abandoned once all its lanes exceed the
radius.  A band with more than ``cell`` members is dealt out as pairs of member
groups, each pair a cell of its own, so that no task holds a whole hot band.

A cell returns a spanning forest of its links (at most one edge per member),
which keeps every connection without emitting all pairs.

Defined cases: texts without words (null, empty, blank) have fingerprint zero and
link like any other; repeated rows share a fingerprint and a component; a null
doc_id never becomes component_id unless its component has no other.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, arrow_text, documents_of, materialize, row_id, shuffle_tasks
from .graph import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
CELL = 8192
_STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a UTF-8 text over word shingles, repeats included."""
    words = text.translate(LOWER_TABLE).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces[: len(words) - shingle] + 1).tolist()]
    ends = [*spaces[shingle - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends)), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), _STEP):
        part = hashes[lo : lo + _STEP]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(docs: DataFrame, shingle: int, seed: int, row: str | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = arrow_text(batch.column("text"))
            fps = np.array([fingerprint(data[a:b].tobytes(), shingle, seed) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], np.uint64)
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "doc_id": batch.column("doc_id"), "fp": pa.array(fps.view(np.int64))})

    src = documents_of(docs, row_id(row))
    return src.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, fp long")


# ---------------------------------------------------------------- bit-sliced comparison


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(blocks, 64) uint64: word [b, p] holds bit p of the 64 fingerprints of block b, one per lane."""
    pad = (-len(fps)) % 64
    bits = np.unpackbits(np.concatenate([fps, np.zeros(pad, np.uint64)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = bits.reshape(-1, 64, 64).transpose(0, 2, 1)  # block, plane, lane
    return np.ascontiguousarray(np.packbits(lanes, axis=2, bitorder="little")).view(np.uint64)[:, :, 0]


def _within(planes: np.ndarray, fps: np.ndarray, query: np.ndarray, block: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For tasks (query fingerprint, block, lanes that count): the tasks that keep a lane within the radius,
    and those lanes.  ``radius + 1`` saturates the carry-save counters."""
    stages = max(1, int(radius).bit_length())
    counters = [np.zeros(len(query), np.uint64) for _ in range(stages)]
    over = ~lanes
    alive = np.arange(len(query))
    for p in range(64):
        carry = planes[block, p] ^ (np.uint64(0) - ((fps[query] >> np.uint64(p)) & np.uint64(1)))
        for s in range(stages):
            counters[s], carry = counters[s] ^ carry, counters[s] & carry
        over |= carry
        if radius + 1 < 1 << stages:  # a count past the radius that the counters can still hold
            over |= _greater(counters, radius)
        if p % 8 == 7:
            keep = over != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not keep.all():
                alive, over, query, block = alive[keep], over[keep], query[keep], block[keep]
                counters = [c[keep] for c in counters]
            if not len(alive):
                break
    return alive, ~over, query


def _greater(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count exceeds ``radius``."""
    more, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for s in range(len(counters) - 1, -1, -1):
        if radius >> s & 1:
            equal = equal & counters[s]
        else:
            more = more | (equal & counters[s])
            equal = equal & ~counters[s]
    return more


def _roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest member reachable from each, over links that arrive in parts."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            ra, rb = root[a], root[b]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            open_ = low != high
            if not open_.any():
                break
            a, b, low, high = a[open_], b[open_], low[open_], high[open_]
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def link_cell(fps: np.ndarray, group: np.ndarray, radius: int, task_step: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (member index, root index) of the links among fingerprints sorted by ``group``;
    only members of one group are compared."""
    n = len(fps)
    planes = bit_planes(fps)
    stop = np.searchsorted(group, group, "right")
    index = np.arange(n)
    first_block, last_block = (index + 1) // 64, (stop - 1) // 64  # later members only: each pair once
    spans = np.where(index + 1 < stop, last_block - first_block + 1, 0)

    def pairs():
        edge = np.cumsum(spans)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(edge, (edge[lo - 1] if lo else 0) + task_step, "right")))
            count = spans[lo:hi]
            query = np.repeat(index[lo:hi], count)
            if len(query):
                step = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count)
                block = np.repeat(first_block[lo:hi], count) + step
                low = np.maximum(query + 1 - block * 64, 0)
                high = np.minimum(stop[query] - block * 64, 64)
                ones = np.uint64(0xFFFFFFFFFFFFFFFF)
                lanes = (ones << low.astype(np.uint64)) & (ones >> (64 - high).astype(np.uint64))
                alive, mask, q = _within(planes, fps, query, block, lanes, radius)
                if len(alive):
                    bits = np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    at, lane = np.nonzero(bits)
                    yield q[at], block[alive[at]] * 64 + lane
            lo = hi

    root = _roots(n, pairs())
    moved = np.flatnonzero(root != index)
    return moved, root[moved]


def _links(distinct: DataFrame, radius: int, cell: int) -> DataFrame:
    """(u, v) spanning edges over all bands of a table of distinct fingerprints ``fp``."""
    bands = radius + 1
    width = -(-64 // bands)

    def value(b: int):
        bits = min(width, 64 - b * width)
        return F.shiftrightunsigned("fp", b * width) if bits == 64 else F.shiftrightunsigned("fp", b * width).bitwiseAND((1 << bits) - 1)

    # equal hashes of two bands only compare more pairs
    banded = distinct.select("fp", F.explode(F.array([F.xxhash64(F.lit(b), value(b)) for b in range(bands)])).alias("band"))
    # a band beyond `cell` members is dealt to groups g, and to cells (g, h): every two groups meet in one
    hot = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell).select("band", F.ceil(F.col("n") / cell).cast("int").alias("groups"))
    dealt = banded.join(hot, "band", "left").withColumn("groups", F.coalesce("groups", F.lit(1))).withColumn("g", F.pmod(F.xxhash64("fp"), F.col("groups")).cast("int"))
    cells = dealt.select("fp", "band", "g", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("h")).select(
        "fp", F.xxhash64("band", F.least("g", "h"), F.greatest("g", "h")).alias("cell")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp, key = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False)])
                key = np.concatenate([key, batch.column("cell").to_numpy(zero_copy_only=False)])
            whole = len(key) if batch is None or not len(key) else int(np.searchsorted(key, key[-1], "left"))
            if whole:
                moved, root = link_cell(fp[:whole].view(np.uint64), key[:whole], radius)
                yield pa.RecordBatch.from_pydict({"u": pa.array(fp[moved]), "v": pa.array(fp[root])})
                fp, key = fp[whole:], key[whole:]

    placed = cells.repartition(shuffle_tasks(distinct.sparkSession), "cell").sortWithinPartitions("cell", "fp")
    return placed.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, cell: int = CELL, row: str | None = None) -> DataFrame:
    """Per document: row, doc_id, fp (signed 64 bits), component (smallest fingerprint reachable) and component_id
    (smallest doc_id reachable); documents link where fingerprints differ in ``radius`` bits or fewer.
    ``row`` names a column of stored row numbers."""
    rows = materialize(_fingerprints(docs, shingle, seed, row), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = connected_components(_links(distinct.select("fp"), radius, cell))
    members = distinct.join(links, distinct["fp"] == links["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("component"))
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(members.join(smallest, "component").select("fp", "component", "component_id"), "simhash-groups")
    return rows.join(named, "fp").select("row", "doc_id", "fp", "component", "component_id")


def hex_fingerprint(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
