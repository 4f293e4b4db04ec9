"""Operator 10: sum-of-squares packing of documents into token sequences.

Documents are encoded whole and closed by an end id; only those longer than a
sequence are cut, into full sequences behind one shorter first piece.  A full
piece is a sequence by itself.  The others are dealt to groups of bounded size;
each group holds the number of open sequences per residual gap and puts every
piece, longest first, where the sum of the squared numbers becomes smallest (a
new sequence counts as a gap, equal sums take the smallest gap).  The pieces of
sequences that stayed open, a small share, are dealt and packed again across
groups by the same rule, ``ROUNDS`` times in all.

Defined cases: a null or empty text is its end id alone, one piece; an empty
table gives no pieces; repeated documents are packed each; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents_of, materialize, text_blocks, with_row
from .tokens import encoder

CAPACITY = 1024
GROUP = 1 << 16
ROUNDS = 3


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: full ones behind a first piece of the rest."""
    first = (n - 1) % capacity + 1
    return [first] + [capacity] * ((n - first) // capacity)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, in the order given; bins are numbered from 0."""
    open_bins: list[list[int]] = [[] for _ in range(capacity)]
    count = np.zeros(capacity, np.int64)  # open bins per gap; a full bin is closed and counts nothing
    bins, offsets, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        gap, best = capacity, 2 * count[capacity - s] + 1  # change of the sum with a new bin
        if count[s] and 1 - 2 * count[s] <= best:
            gap, best = s, 1 - 2 * count[s]  # a bin that becomes full
        after, before = count[1 : capacity - s], count[s + 1 :]
        if len(before):
            change = np.where(before > 0, after - before, len(lengths) + 1)
            k = int(np.argmin(change))
            value = 2 * (change[k] + 1)
            if before[k] and (value < best or value == best and gap == capacity):
                gap = s + 1 + k
        if gap == capacity:
            b, used = used, used + 1
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            open_bins[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets


def _pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                flat, at = enc.encode(data, offs)
                flat = np.insert(flat, at[1:], np.uint32(end_id))
                total = np.diff(at) + 1
                first = (total - 1) % capacity + 1
                pieces = (total - first) // capacity + 1
                doc = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.where(piece == 0, first[doc], capacity)
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                ends = np.cumsum(length)
                view = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
                crc = np.fromiter((zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist())), np.int64, len(ends))
                cols = {
                    "row": batch.column("row").slice(lo, hi - lo).take(pa.array(doc)),
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)),
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array(crc),
                }
                if with_ids:
                    cols["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(cols)

    schema = "row long, doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return with_row(documents_of(docs)).select("row", "doc_id", "text").mapInArrow(run, schema)


def _packed(items: DataFrame, group_size: int, capacity: int) -> DataFrame:
    """``items`` (row, piece, length, ...) with grp, bin, offset and closed (its sequence is full): packed
    within groups of about ``group_size`` pieces."""
    groups = max(1, -(-items.count() // group_size))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        length = pdf["length"].to_numpy()
        pdf["bin"], pdf["offset"] = sum_of_squares(length, capacity)
        pdf["closed"] = np.bincount(pdf["bin"], length)[pdf["bin"]] == capacity
        return pdf

    src = items.withColumn("grp", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("int"))
    added = [T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("closed", T.BooleanType())]
    return src.groupBy("grp").applyInPandas(pack, T.StructType([*src.schema.fields, *added]))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, group_size: int = GROUP, with_ids: bool = False) -> DataFrame:
    """Per piece: row, doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids if asked)."""
    pieces = materialize(_pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces")
    columns = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]
    rest = pieces.where(F.col("length") < capacity).select(*columns)
    # sequence numbers: round, group and bin side by side; full pieces count downwards from -1
    out = pieces.where(F.col("length") == capacity).select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    for r in range(ROUNDS):
        packed = materialize(_packed(rest, group_size, capacity), "packed")
        number = F.lit(r << 61).cast("bigint").bitwiseOR(F.shiftleft(F.col("grp").cast("bigint"), 31)).bitwiseOR(F.col("bin"))
        done = packed if r == ROUNDS - 1 else packed.where("closed")
        out = out.union(done.select(*columns, number.alias("sequence_id"), "offset"))
        rest = packed.where("NOT closed").select(*columns)
    return out.join(pieces.select("row", "piece", "ids"), ["row", "piece"]) if with_ids else out
