"""Operator 12: vector bin packing by the dot-product heuristic, for instruction data and documents.

An example asks for tokens, one segment and loss-bearing tokens; a sequence has a
limit for each.  The open sequence takes, of all examples that still fit under
every limit, the one whose demand has the largest dot product with the room that
is left; demands and room are shares of the limits, weighted by the mean demand
in each dimension.  It is closed when nothing fits.  Examples are dealt to groups
of about ``GROUP`` and packed group by group.

``pack_examples`` keeps examples whole (instruction data).  ``pack_documents``
encodes texts, closes each by an end id and may cut: pieces of a full sequence
are cut off first; where no whole rest fits, the head of the longest one fills
the sequence and its tail goes back; a sequence that stays open at the end of a
group is cut into sequences whose lengths are powers of two, which need no
padding.  In documents every id bears loss.

Defined cases: a null or empty text is its end id alone; an empty table gives no
pieces; repeated rows are packed each; ties are taken in order of length, loss
and row; an example that exceeds a limit by itself, or has a null demand, gets a
null sequence; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents_of, materialize, text_blocks, with_row
from .tokens import encoder

GROUP = 1 << 13


class Limits(NamedTuple):
    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


def dot_product(length: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool = False) -> np.ndarray:
    """Rows (item, begin, take, sequence, offset) that place every item; each must fit under the limits by itself.

    With ``cut`` (every token bears loss) an item may be placed in several parts.
    """
    if cut:
        kinds = np.stack([np.arange(1, limits.tokens + 1)] * 2, 1)
        kind = length - 1
    else:
        kinds, kind = np.unique(np.stack([length, loss], 1), axis=0, return_inverse=True)
    need, bears = kinds[:, 0], kinds[:, 1]
    waiting: list[list[tuple[int, int]]] = [[] for _ in kinds]  # (item, begin) per kind, the first item on top
    for i in range(len(length) - 1, -1, -1):
        waiting[kind[i]].append((i, 0))
    number = np.bincount(kind, minlength=len(kinds))
    mean = np.array([length.mean() / limits.tokens, 1 / limits.segments, loss.mean() / limits.loss]) if len(length) else np.zeros(3)
    by_need, by_loss, by_segment = mean[0] * need / limits.tokens, mean[2] * bears / limits.loss, mean[1] / limits.segments
    out, left, sequence = [], len(length), 0
    while left:
        tokens, segments, losses, offset = *limits, 0
        while left and segments and tokens:
            score = by_need * (tokens / limits.tokens) + by_loss * (losses / limits.loss) + by_segment * (segments / limits.segments)
            there = number > 0
            fits = there & (need <= tokens) & (bears <= losses)
            longer = cut and bool(there[tokens:].any())
            if segments == 1 and longer:
                fits &= need == tokens  # the last segment fills the sequence
            k = int(np.argmax(np.where(fits, score, -1.0)))
            if fits[k]:
                take = int(need[k])
            elif longer and losses:
                k = int(np.argmax(np.where(there, score, -1.0)))
                take = min(tokens, losses)
            else:
                break
            item, begin = waiting[k].pop()
            number[k] -= 1
            if take < need[k]:
                waiting[need[k] - take - 1].append((item, begin + take))
                number[need[k] - take - 1] += 1
            else:
                left -= 1
            out.append((item, begin, take, sequence, offset))
            tokens, segments, losses, offset = tokens - take, segments - 1, losses - (take if cut else int(bears[k])), offset + take
        sequence += 1
    return np.array(out, np.int64).reshape(-1, 5)


def cut_to_powers(placed: np.ndarray, capacity: int) -> np.ndarray:
    """``placed`` with every sequence that is neither full nor a power of two long cut into powers of two, largest first."""
    if not len(placed):
        return placed
    total = np.bincount(placed[:, 3], placed[:, 2]).astype(np.int64)
    odd = (total < capacity) & (total & (total - 1) != 0)
    out, number = [placed[~odd[placed[:, 3]]]], len(total)
    for s in np.flatnonzero(odd).tolist():
        rest = [1 << b for b in range(int(total[s]).bit_length() - 1, -1, -1) if total[s] >> b & 1]
        room, offset = rest.pop(0), 0
        for item, begin, take, _, _ in placed[placed[:, 3] == s].tolist():
            while take:
                if not room:
                    room, offset, number = rest.pop(0), 0, number + 1
                part = min(take, room)
                out.append(np.array([[item, begin, part, number, offset]], np.int64))
                begin, take, room, offset = begin + part, take - part, room - part, offset + part
        number += 1
    return np.concatenate(out)


def _grouped(items: DataFrame, group_size: int) -> DataFrame:
    groups = max(1, -(-items.count() // group_size))
    return items.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).groupBy("grp")


def pack_examples(examples: DataFrame, tokens: str = "n_tokens", loss: str = "n_loss", limits: Limits = Limits(), group_size: int = GROUP) -> DataFrame:
    """Per example: row, all its columns under ``example``, sequence_id and offset (in tokens)."""
    src = materialize(with_row(examples.select(F.struct("*").alias("example"))).withColumn("need", F.col(f"example.{tokens}").cast("bigint")).withColumn("bears", F.col(f"example.{loss}").cast("bigint")), "examples")
    fits = F.coalesce(F.col("need").between(0, limits.tokens) & F.col("bears").between(0, limits.loss), F.lit(False))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["need", "bears", "row"], kind="stable").reset_index(drop=True)
        placed = dot_product(pdf["need"].to_numpy(), pdf["bears"].to_numpy(), limits)
        got = pdf.iloc[placed[:, 0]]
        return pd.DataFrame({"row": got["row"].to_numpy(), "sequence_id": (got["grp"].to_numpy().astype(np.int64) << 31) | placed[:, 3], "offset": placed[:, 4]})

    placed = _grouped(src.where(fits & (F.col("need") > 0)).select("row", "need", "bears"), group_size).applyInPandas(pack, "row long, sequence_id long, offset long")
    return src.join(placed, "row", "left").select("row", "example", "sequence_id", "offset")


def conversation_examples(conversations: DataFrame, tokenizer: str, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, n_tokens and n_loss (ids of the turns whose role bears loss) of every conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_pydict({"conv_id": part.column("conv_id"), "role": part.column("role"), "n": pa.array(np.diff(enc.encode(data, offs)[1]))})

    turns = conversations.select("conv_id", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    counted = turns.mapInArrow(run, f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, role string, n long")
    return counted.groupBy("conv_id").agg(F.sum("n").alias("n_tokens"), F.sum(F.when(F.col("role").isin(*loss_roles), F.col("n")).otherwise(0)).alias("n_loss"))


def _pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Full pieces and the rest behind them, per document; the rest with its ids in little-endian 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                flat, at = enc.encode(data, offs)
                flat = np.insert(flat, at[1:], np.uint32(end_id)).astype("<u4", copy=False)
                total = np.diff(at) + 1
                number = -(-total // capacity)
                doc = np.repeat(np.arange(hi - lo), number)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                start = piece * capacity
                length = np.minimum(capacity, total[doc] - start)
                ends = np.cumsum(length)
                view = memoryview(np.ascontiguousarray(flat)).cast("B")
                spans = [view[4 * a : 4 * b] for a, b in zip((ends - length).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "row": batch.column("row").slice(lo, hi - lo).take(pa.array(doc)),
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                    "doc_tokens": pa.array(total[doc]),
                    "ids": pa.array([None if n == capacity else bytes(s) for n, s in zip(length.tolist(), spans)], pa.binary()),
                })

    schema = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    return with_row(documents_of(docs)).select("row", "doc_id", "text").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, limits: Limits = Limits(), group_size: int = GROUP) -> DataFrame:
    """Per piece: row, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if limits.loss < limits.tokens:
        raise ValueError("every id of a document bears loss: the limit of loss-bearing tokens must reach that of tokens")
    pieces = materialize(_pieces(docs, tokenizer, end_id, limits.tokens), "pieces")
    columns = ["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], kind="stable").reset_index(drop=True)
        length = pdf["length"].to_numpy()
        placed = cut_to_powers(dot_product(length, length, limits, cut=True), limits.tokens)
        item, begin, take = placed[:, 0], placed[:, 1], placed[:, 2]
        got, ids = pdf.iloc[item], pdf["ids"].to_numpy()
        crc = got["ids_crc32"].to_numpy().copy()
        for k in np.flatnonzero(take < length[item]).tolist():
            crc[k] = zlib.crc32(memoryview(ids[item[k]])[4 * begin[k] : 4 * (begin[k] + take[k])])
        number = (got["grp"].to_numpy().astype(np.int64) << 31) | placed[:, 3]
        return pd.DataFrame({"row": got["row"].to_numpy(), "doc_id": got["doc_id"].astype("Int64").to_numpy(), "start": got["start"].to_numpy() + begin, "length": take, "ids_crc32": crc, "doc_tokens": got["doc_tokens"].to_numpy(), "sequence_id": number, "offset": placed[:, 4]})

    schema = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    rest = _grouped(pieces.where(F.col("length") < limits.tokens), group_size).applyInPandas(pack, schema)
    full = pieces.where(F.col("length") == limits.tokens).select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return full.union(rest)
