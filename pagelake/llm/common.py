"""Shared helpers: table access, the shared folder, Arrow text blocks and byte-level words.

Texts are handled as the UTF-8 bytes that Arrow already holds, in blocks of a
few MB, so that a task's working memory follows the block (or the one longest
text), never the partition.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_LOCAL_ROOT: list[str] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A folder of our own is taken only where the setting is absent and the
    master is local (tests); on a cluster the missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append("file://" + tempfile.mkdtemp(prefix="pagelake-llm-"))
    return _LOCAL_ROOT[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Within, Spark hands rows to Python in Arrow batches of about ``size`` bytes at most.

    An executor holds a batch several times over outside its heap (vectors that double, the stream's buffer), as does
    the Python worker; by default a batch may have 10,000 texts.  Holds for jobs that run within; rows stay the same.
    """
    before = spark.conf.get(_BATCH_SETTING)
    given = before.lower().rstrip("b")
    if not given.isdigit() or not 0 < int(given) <= size:
        spark.conf.set(_BATCH_SETTING, f"{size}b")
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents_of(df: DataFrame, *extra: str) -> DataFrame:
    """doc_id and text (null stays null) plus ``extra``, with a ``row`` id that tells equal rows apart."""
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)


def with_row(df: DataFrame) -> DataFrame:
    return df.withColumn("row", F.monotonically_increasing_id())


def row_id(stored: str | None = None) -> Column:
    """The ``row`` of a document: its stored number, or Spark's number, which holds for this one scan only."""
    return (F.monotonically_increasing_id() if stored is None else F.col(f"`{stored}`").cast("bigint")).alias("row")


def _just_read(df: DataFrame) -> bool:
    """Whether ``df`` is a Parquet file or folder read by its absolute path, without options or any further step."""
    for file in df.inputFiles()[:1]:
        for listed in (file, os.path.dirname(file)):
            for path in (listed, urlsplit(listed).path):
                with suppress(AnalysisException):  # no such path: its name is not written as it was listed
                    if df.sameSemantics(df.sparkSession.read.schema(df.schema).parquet(path)):
                        return True
    return False


def _file_rows(df: DataFrame) -> list[tuple[str, int]] | None:
    """(path, rows) of the Parquet files that ``df`` reads whole; None for any other frame."""
    if not _just_read(df):
        return None
    at = df.metadataColumn("_metadata")
    sizes = df.groupBy(at["file_path"].alias("path")).agg(F.count(F.lit(1)).alias("n"), F.max(at["row_index"]).alias("last"))
    files = sorted(tuple(r) for r in sizes.collect())  # one row per file
    return [(path, n) for path, n, _ in files] if all(n == last + 1 for _, n, last in files) else None  # else a file is read twice


def number_rows(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` with a number for each row that every scan finds again, and the column that holds it (``row``, lengthened where taken).

    A table just read from Parquet files takes the place of the row in its file, after the rows of the files before it,
    and is not written again.  Any other frame is written with its numbers."""
    taken, name = {c.lower() for c in df.columns}, "row"
    while any(c.startswith(name) for c in taken):
        name += "_"
    files = _file_rows(df)
    if files is None:
        return materialize(df.withColumn(name, F.monotonically_increasing_id()), label), name
    path, place, before = f"{name}_path", f"{name}_place", f"{name}_before"
    starts = np.cumsum([0] + [n for _, n in files]).tolist()
    first = df.sparkSession.createDataFrame([(p, start) for (p, _), start in zip(files, starts)], f"{path} string, {before} long")
    at = df.metadataColumn("_metadata")
    placed = df.select("*", at["file_path"].alias(path), at["row_index"].alias(place)).join(F.broadcast(first), path)
    return placed.withColumn(name, F.col(before) + F.col(place)).drop(path, place, before), name


def crc_split(doc_id: Column) -> Column:
    """The held-out rows of the label contracts: crc32 of the decimal doc_id modulo 4 is 2 (a null id is ``''``)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


# ---------------------------------------------------------------- Arrow text


def arrow_text(column) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, int64 offsets of length n+1) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def text_blocks(column, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offs = arrow_text(column)
    for lo, hi in blocks(offs, size):
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]


def joined_blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes and offsets of their texts) in blocks of about ``size`` bytes, wherever Spark cut its batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) > size:
            rows = pa.concat_batches(held)
            *full, last = text_blocks(rows.column("text"), size)
            for lo, hi, data, offs in full:
                yield rows.slice(lo, hi - lo), data, offs
            held = [rows.slice(last[0])]
    if held:
        rows = pa.concat_batches(held)
        for lo, hi, data, offs in text_blocks(rows.column("text"), size):
            yield rows.slice(lo, hi - lo), data, offs


# ---------------------------------------------------------------- bytes and words

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_TABLE = LOWER.tobytes()

#: word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits, a-z and every non-ASCII byte
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = True
WORD_BYTE[97:123] = True
WORD_BYTE[128:] = True

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_MASK = (1 << 64) - 1
_BASE_INV = np.uint64(pow(_BASE, -1, 1 << 64))
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 1 << 16


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_POW = _powers(_CHUNK, _BASE)
_POW_INV = _powers(_CHUNK + 1, int(_BASE_INV))
_STEP = np.uint64(pow(_BASE, _CHUNK, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span [start, end), computed for all spans at once.

    Prefix sums of code(byte) * B^i modulo 2^64 give every span's polynomial,
    and the inverse power of its start makes it independent of the place.
    """
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    if n:
        term = _BYTE_CODE[data]
        reps = -(-n // _CHUNK)
        if reps == 1:
            term *= _POW[:n]
        else:
            scale = _powers(reps, int(_STEP))
            for k in range(reps):
                term[k * _CHUNK : (k + 1) * _CHUNK] *= _POW[: min(_CHUNK, n - k * _CHUNK)] * scale[k]
        np.cumsum(term, out=total[1:])
    inv_step = _powers(n // _CHUNK + 1, pow(int(_STEP), -1, 1 << 64))
    out = total[ends] - total[starts]
    out *= _POW_INV[starts % _CHUNK]
    out *= inv_step[starts // _CHUNK]
    return mix64(out + (ends - starts).astype(np.uint64) * _MULT)


def runs(flag: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a text boundary ends a run."""
    n = len(flag)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = flag.copy()
    first[1:] &= ~flag[:-1] | cut[1:n]
    last = flag.copy()
    last[:-1] &= ~flag[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1
