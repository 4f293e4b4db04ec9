"""Operator 9: exact deduplication with a cuckoo-filter index of live digests.

Texts are lower-cased (A-Z only) and named by their SHA-256.  Digests are dealt
to tasks by hash; a task keeps its live digests in rows and a cuckoo filter
whose slots point to those rows.  A new digest that the filter does not know is
inserted at once; one that it may know is verified against the stored digests
of its two buckets, so a chance hit never merges different texts.  A digest
whose last document goes is deleted from its slot.  When an insertion finds no
place, the table doubles and is rebuilt from the stored digests.

Copies are combined within each batch before the shuffle, so that a text that
makes up a third of all rows reaches its task as one row per batch.

Defined cases: null text counts as empty; a null doc_id ranks below all others;
of rows that share the largest doc_id of a text exactly one stays (the last in
the table's own order); extra columns are ignored; an empty table gives an
empty index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, arrow_text, documents_of, materialize, mix64, row_id, shuffle_tasks

SLOTS = 4
KICKS = 500
_NO_ID = -(1 << 63)


class CuckooIndex:
    """A cuckoo filter (16-bit tags, four slots a bucket) over rows of stored 256-bit digests."""

    def __init__(self, buckets: int = 256):
        self.keys = np.zeros((0, 4), np.uint64)
        self.live = np.zeros(0, bool)
        self.size = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.tags = np.zeros((buckets, SLOTS), np.uint16)  # 0: an empty slot
        self.rows = np.full((buckets, SLOTS), -1, np.int64)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tag, first bucket, second bucket); the second is the first XOR a hash of the tag."""
        mask = np.uint64(len(self.tags) - 1)
        tag = (mix64(keys[:, 1]) >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
        one = mix64(keys[:, 0]) & mask
        return tag, one.astype(np.int64), ((one ^ mix64(tag.astype(np.uint64))) & mask).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each digest, -1 where it is not live: tags propose, stored digests decide."""
        tag, one, two = self._places(keys)
        out = np.full(len(keys), -1, np.int64)
        for bucket in (one, two):
            for slot in range(SLOTS):
                may = np.flatnonzero((out < 0) & (self.tags[bucket, slot] == tag))
                row = self.rows[bucket[may], slot]
                same = (self.keys[row] == keys[may]).all(1)
                out[may[same]] = row[same]
        return out

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Insert distinct digests that are not live; returns their rows."""
        start, need = self.size, self.size + len(keys)
        if need > len(self.keys):
            room = max(need, 2 * len(self.keys), 1024)
            self.keys = np.concatenate([self.keys, np.zeros((room - len(self.keys), 4), np.uint64)])
            self.live = np.concatenate([self.live, np.zeros(room - len(self.live), bool)])
        new = np.arange(start, need)
        self.keys[new], self.live[new], self.size = keys, True, need
        self._place(new)
        return new

    def _place(self, rows: np.ndarray) -> None:
        while self.live[: self.size].sum() > 0.9 * self.tags.size:
            rows = self._grow()
        while len(rows):
            rows = self._try(rows)
            if len(rows) and not self._kick_in(rows):
                rows = self._grow()
            else:
                break

    def _grow(self) -> np.ndarray:
        """Double the table; all live rows are to be placed anew from their stored digests."""
        self._clear(2 * len(self.tags))
        return np.flatnonzero(self.live[: self.size])

    def _try(self, rows: np.ndarray) -> np.ndarray:
        """Put rows into free slots of either bucket; returns those without one."""
        tag, one, two = self._places(self.keys[rows])
        todo = np.arange(len(rows))
        for bucket in (one, two):
            for _ in range(SLOTS):
                if not len(todo):
                    break
                free = self.tags[bucket[todo]] == 0
                able = np.flatnonzero(free.any(1))
                _, first = np.unique(bucket[todo[able]], return_index=True)  # one row per bucket and round
                put = able[first]
                b, s = bucket[todo[put]], free[put].argmax(1)
                self.tags[b, s], self.rows[b, s] = tag[todo[put]], rows[todo[put]]
                todo = np.delete(todo, put)
        return rows[todo]

    def _kick_in(self, rows: np.ndarray) -> bool:
        """Place rows one by one, moving others to their second bucket; False if one found no place."""
        mask = len(self.tags) - 1
        tag, one, _ = self._places(self.keys[rows])
        for row, t, b in zip(rows.tolist(), tag, one.tolist()):
            for k in range(KICKS):
                free = np.flatnonzero(self.tags[b] == 0)
                s = int(free[0]) if len(free) else (row + k) % SLOTS
                t, self.tags[b, s] = self.tags[b, s], t
                row, self.rows[b, s] = int(self.rows[b, s]), row
                if t == 0:
                    break
                b = (b ^ int(mix64(np.array([t], np.uint64))[0])) & mask
            else:
                return False
        return True

    def remove(self, rows: np.ndarray) -> None:
        """Delete live rows from their slots."""
        tag, one, two = self._places(self.keys[rows])
        for bucket in (one, two):
            at, slot = np.nonzero((self.rows[bucket] == rows[:, None]) & (self.tags[bucket] == tag[:, None]))
            self.tags[bucket[at], slot] = 0
            self.rows[bucket[at], slot] = -1
        self.live[rows] = False


def _digests(docs: DataFrame, row: str | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = arrow_text(batch.column("text"))
            sha = [hashlib.sha256(data[a:b].tobytes().translate(LOWER_TABLE)).digest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "doc_id": batch.column("doc_id"), "digest": pa.array(sha, pa.binary())})

    return documents_of(docs, row_id(row)).select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, digest binary")


_ENTRY = "digest binary, keep_id long, keep_row long, n long"


def _key_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 4)


def _reduced(keys: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: np.ndarray):
    """One entry per distinct digest: its largest (id, row) and the sum of n."""
    order = np.lexsort((rows, ids, keys[:, 3], keys[:, 2], keys[:, 1], keys[:, 0]))
    keys, ids, rows, n = keys[order], ids[order], rows[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])) if len(keys) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(keys)]]).astype(np.int64) - 1 if len(keys) else first
    return keys[last], ids[last], rows[last], np.add.reduceat(n, first) if len(keys) else n


def _entry_batch(keys, ids, rows, n) -> pa.RecordBatch:
    raw = np.ascontiguousarray(keys).tobytes()
    return pa.RecordBatch.from_pydict({
        "digest": pa.array([raw[i : i + 32] for i in range(0, len(raw), 32)], pa.binary()),
        "keep_id": pa.array(ids, mask=ids == _NO_ID),
        "keep_row": pa.array(rows),
        "n": pa.array(n),
    })


def _entries(batch) -> tuple[np.ndarray, ...]:
    ids = batch.column("keep_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    rows, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("keep_row", "n"))
    return _key_array(batch.column("digest")), ids, rows, n


def changes(digests: DataFrame, sign: int = 1) -> DataFrame:
    """Entries to insert (``sign`` 1) or delete (-1) for rows of (row, doc_id, digest), combined within each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            yield _entry_batch(*_reduced(_key_array(batch.column("digest")), ids, rows, np.full(len(ids), sign, np.int64)))

    return digests.select("row", "doc_id", "digest").mapInArrow(run, _ENTRY)


def update_index(index: DataFrame | None, *parts: DataFrame, tasks: int | None = None) -> DataFrame:
    """The index after inserting and deleting ``parts``: one entry per live digest (keep_id, keep_row, n).

    A deletion lowers n; at 0 the digest leaves the filter and the index.  keep_id stays the largest id
    that was ever inserted while the digest was live."""
    frames = [f for f in (index, *parts) if f is not None]
    total = frames[0].select("digest", "keep_id", "keep_row", "n")
    for f in frames[1:]:
        total = total.union(f.select("digest", "keep_id", "keep_row", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        ids, rows, n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        gone = []
        for batch in batches:
            k, i, r, c = _entries(batch)
            gone.append(tuple(x[c < 0] for x in (k, i, r, c)))
            k, i, r, c = _reduced(*(x[c > 0] for x in (k, i, r, c)))
            at = index.find(k)
            new = at < 0
            at[new] = index.add(k[new])
            if index.size > len(ids):
                room = max(index.size, 2 * len(ids)) - len(ids)
                ids = np.concatenate([ids, np.full(room, _NO_ID)])
                rows = np.concatenate([rows, np.full(room, -1)])
                n = np.concatenate([n, np.zeros(room, np.int64)])
            better = (i > ids[at]) | ((i == ids[at]) & (r > rows[at]))
            ids[at[better]], rows[at[better]] = i[better], r[better]
            n[at] += c
        for part in gone:
            k, _, _, c = _reduced(*part)
            at = index.find(k)
            known = at >= 0
            n[at[known]] += c[known]
            empty = at[known][n[at[known]] <= 0]
            if len(empty):
                index.remove(empty)
        live = np.flatnonzero(index.live[: index.size])
        for lo in range(0, len(live), 1 << 16):
            part = live[lo : lo + (1 << 16)]
            yield _entry_batch(index.keys[part], ids[part], rows[part], n[part])

    return total.repartition(tasks or shuffle_tasks(total.sparkSession), "digest").mapInArrow(run, _ENTRY)


def deduplicate(docs: DataFrame, tasks: int | None = None, row: str | None = None) -> DataFrame:
    """Per document: row, doc_id, digest, keep_id, group_size, kept; of equal texts the largest doc_id stays.
    ``row`` names a column of stored row numbers."""
    rows = materialize(_digests(docs, row), "digests")
    index = materialize(update_index(None, changes(rows), tasks=tasks), "cuckoo-index")
    return rows.join(index, "digest").select("row", "doc_id", "digest", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"))
