"""Operator 1: token-id files with fixed-width bit packing.

``write_token_files`` sorts documents by doc_id over range partitions, encodes
them and writes one file per partition.  Every id takes the minimum number of
bits of the vocabulary.  File layout, all integers little-endian::

    "TPK1" | bits u32 | block_ids u32 | 0 u32
    blocks of ``block_ids`` ids (the last may be shorter), each from a byte border
    doc_ids i64[n] | null flags u8[n] | first id of each document i64[n + 1] | block offsets i64[m + 1]
    n u64 | m u64 | ids u64 | "TPK1"

so a reader finds any document by its table entry, seeks the blocks that hold
it and unpacks them with numpy, without touching the rest.

Order: doc_id ascending, null ids first, then a hash of the text (equal rows
are interchangeable).  A null text is empty and holds the end id alone; an
empty table gives files without documents.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .common import shuffle_tasks, text_blocks
from .tokens import encoder

MAGIC = b"TPK1"
BLOCK_IDS = 1 << 16
READ_IDS = 1 << 20
SPLIT_BYTES = 64 << 20


def bits_for(vocab: int) -> int:
    return max(1, int(vocab - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits per id, least significant first, padded to a whole byte."""
    ids = np.ascontiguousarray(ids, "<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    table = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(table.ravel(), bitorder="little").tobytes()


def unpack_ids(raw: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", count).astype("<u4")
    table = np.zeros((count, 32), np.uint8)
    table[:, :bits] = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[: count * bits].reshape(count, bits)
    return np.packbits(table, axis=1, bitorder="little").view("<u4").ravel()


class TokenFileWriter:
    """Appends documents; holds one block and the document table."""

    def __init__(self, sink, bits: int, block_ids: int = BLOCK_IDS):
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        self.doc_ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.firsts: list[np.ndarray] = []
        self.offsets = [16]
        self.total = 0
        self.rest = np.zeros(0, np.uint32)
        sink.write(MAGIC + np.array([bits, block_ids, 0], "<u4").tobytes())

    def _block(self, ids: np.ndarray) -> None:
        raw = pack_ids(ids, self.bits)
        self.sink.write(raw)
        self.offsets.append(self.offsets[-1] + len(raw))

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.nulls.append(nulls)
        self.firsts.append(self.total + np.cumsum(counts) - counts)
        self.total += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) - len(ids) % self.block_ids
        for lo in range(0, whole, self.block_ids):
            self._block(ids[lo : lo + self.block_ids])
        self.rest = ids[whole:]

    def close(self) -> dict:
        if len(self.rest):
            self._block(self.rest)
        doc_ids = np.concatenate([*self.doc_ids, np.zeros(0, np.int64)])
        nulls = np.concatenate([*self.nulls, np.zeros(0, np.uint8)])
        firsts = np.concatenate([*self.firsts, [self.total]])
        tail = doc_ids.astype("<i8").tobytes() + nulls.astype(np.uint8).tobytes() + firsts.astype("<i8").tobytes()
        tail += np.array(self.offsets, "<i8").tobytes()
        tail += np.array([len(doc_ids), len(self.offsets) - 1, self.total], "<u8").tobytes() + MAGIC
        self.sink.write(tail)
        self.sink.close()
        return {"docs": len(doc_ids), "ids": self.total, "bytes": self.offsets[-1] + len(tail)}


class TokenFile:
    """Random access to one file's documents."""

    def __init__(self, path: str):
        self.source = files.open_read(path)
        size = self.source.size()
        foot = self.source.read_at(28, size - 28)
        head = self.source.read_at(16, 0)
        if head[:4] != MAGIC or foot[24:] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        self.bits, self.block_ids = np.frombuffer(head[4:12], "<u4").tolist()
        n, m, self.total = np.frombuffer(foot[:24], "<u8").astype(np.int64).tolist()
        at = size - 28 - 8 * (m + 1) - 8 * (n + 1) - n - 8 * n
        raw = self.source.read_at(size - 28 - at, at)
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.nulls = np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool)
        self.firsts = np.frombuffer(raw, "<i8", n + 1, 9 * n)
        self.offsets = np.frombuffer(raw, "<i8", m + 1, 9 * n + 8 * (n + 1))

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi-1 of the file: reads and unpacks only the blocks that hold them."""
        if hi <= lo:
            return np.zeros(0, "<u4")
        b0, b1 = lo // self.block_ids, (hi - 1) // self.block_ids + 1
        raw = self.source.read_at(int(self.offsets[b1] - self.offsets[b0]), int(self.offsets[b0]))
        parts = []
        for b in range(b0, b1):
            count = min(self.block_ids, self.total - b * self.block_ids)
            at, end = (int(self.offsets[i] - self.offsets[b0]) for i in (b, b + 1))
            parts.append(unpack_ids(raw[at:end], count, self.bits))
        return np.concatenate(parts)[lo - b0 * self.block_ids : hi - b0 * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.firsts[k]), int(self.firsts[k + 1]))


def with_end_ids(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids with ``end_id`` after each document, ids per document with the end)."""
    counts = np.diff(offsets)
    return np.insert(ids, offsets[1:], np.uint32(end_id)), counts + 1


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, tasks: int | None = None, block_ids: int = BLOCK_IDS) -> dict:
    """Encode ``docs`` (doc_id, text) and write token files into ``folder``; returns the manifest."""
    spark = docs.sparkSession
    tasks = tasks or shuffle_tasks(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        name = files.attempt_name(part, ".tok")
        out = TokenFileWriter(files.open_write(f"{folder}/{name}"), bits_for(max(enc.vocab, end_id + 1)), block_ids)
        for batch in batches:
            ids_col = batch.column("doc_id")
            doc_ids = ids_col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            nulls = ids_col.is_null().to_numpy(zero_copy_only=False)
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                flat, at = enc.encode(data, offs)
                out.add(doc_ids[lo:hi], nulls[lo:hi], *with_end_ids(flat, at, end_id))
        done = out.close()
        yield pa.RecordBatch.from_pylist([{"part": part, "name": name, **done}])

    rows = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange(tasks, "doc_id", "h")
        .sortWithinPartitions("doc_id", "h")
        .select("doc_id", "text")
        .mapInArrow(write, "part long, name string, docs long, ids long, bytes long")
        .collect()  # one row per task
    )
    entries, start = [], 0
    for r in sorted(rows, key=lambda r: r.part):
        entries.append({"name": r.name, "start": start, "docs": r.docs, "ids": r.ids, "bytes": r.bytes})
        start += r.ids
    files.write_manifest(folder, entries, tokenizer=tokenizer, end_id=end_id)
    return files.read_manifest(folder)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked, ids of every document in the files of ``folder``.

    One task per 64 MB of a file: the file's own table splits it by documents."""
    plan = [
        (f"{folder}/{e['name']}", e["start"], k, pieces)
        for e in files.read_manifest(folder)["files"]
        for pieces in [max(1, -(-e["bytes"] // SPLIT_BYTES))]
        for k in range(pieces)
        if e["docs"]
    ]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.to_pylist():
                f = TokenFile(t["path"])
                n = len(f.doc_ids)
                lo, stop = n * t["k"] // t["pieces"], n * (t["k"] + 1) // t["pieces"]
                while lo < stop:
                    hi = int(np.searchsorted(f.firsts, f.firsts[lo] + READ_IDS, "right")) - 1
                    hi = min(stop, max(hi, lo + 1))
                    firsts = f.firsts[lo : hi + 1]
                    ids = f.ids(int(firsts[0]), int(firsts[-1]))
                    view, at = memoryview(ids).cast("B"), ((firsts - firsts[0]) * 4).tolist()
                    crc = np.fromiter((zlib.crc32(view[a:b]) for a, b in zip(at[:-1], at[1:])), np.int64, hi - lo)
                    cols = {
                        "doc_id": pa.array(f.doc_ids[lo:hi], mask=f.nulls[lo:hi]),
                        "start": pa.array(t["start"] + firsts[:-1]),
                        "n_tokens": pa.array(np.diff(firsts)),
                        "ids_crc32": pa.array(crc),
                    }
                    if with_ids:
                        cols["ids"] = pa.ListArray.from_arrays(pa.array((firsts - firsts[0]).astype(np.int32)), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_pydict(cols)
                    lo = hi

    todo = spark.createDataFrame(plan, "path string, start long, k int, pieces int").repartition(max(1, min(len(plan), 4 * shuffle_tasks(spark))), "path", "k")
    return todo.mapInArrow(read, schema)
