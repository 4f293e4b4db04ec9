"""Operator 3: benchmark decontamination by winnowing.

Every text is cut into words; each run of ``k`` words has a hash, and of every
``window - k + 1`` consecutive hashes the smallest (the rightmost of equals) is
kept as a fingerprint.  The choice depends on the words of the window alone, so
a span of ``window`` words that a document shares with an item always carries
one fingerprint of both.  Fingerprints are joined, and each hit is extended
over the words beside it; every extension of at least ``window`` words marks
them.  Items of fewer words are one window of their own length, found by the
hash of the whole item at every place of a document.

Hashes only propose: each hit compares the words themselves.  Before the join
documents drop fingerprints that a Bloom filter of the benchmark excludes; the
filter is used up to ``BLOOM_MAX_BYTES`` (checked by count), beyond it all
fingerprints go to the join, with the same result.

Defined cases: null and empty texts have no words, no hits and are not
contaminated; an item without words never occurs; equal items count by each
distinct item_id; null item_ids are not listed; repeated documents each give a
row; an empty benchmark marks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, WORD_BYTE, documents_of, materialize, mix64, row_id, runs, span_hashes, text_blocks

WINDOW = 13
K = 7
BLOOM_MAX_BYTES = 32 << 20
_GRAM = 0x2545F4914F6CDD1D


class Words:
    """The words of a block of texts: byte spans, hashes and the text each word belongs to."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        self.starts, self.ends = runs(WORD_BYTE[self.data], offsets)
        self.first = np.searchsorted(self.starts, offsets)  # first word of each text
        self.counts = np.diff(self.first)
        self.hashes = span_hashes(self.data, self.starts, self.ends)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the k words from each place, whether they lie in one text)."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            out = out * np.uint64(_GRAM) + self.hashes[j : n - k + 1 + j]
        text_end = np.repeat(self.first[1:], self.counts)
        return mix64(out + np.uint64(k)), np.arange(n - k + 1) + k <= text_end[: n - k + 1]

    def fingerprints(self, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes that winnowing keeps in texts of at least ``window`` words."""
        grams, _ = self.grams(k)
        w = window - k + 1
        n = len(self.hashes) - window + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        best, at = grams[:n].copy(), np.arange(n)
        for j in range(1, w):
            other = grams[j : n + j]
            lower = other <= best
            best[lower] = other[lower]
            at[lower] = np.flatnonzero(lower) + j
        inside = np.arange(n) + window <= np.repeat(self.first[1:], self.counts)[:n]
        places = np.unique(at[inside])
        return places, grams[places]

    def words(self, raw: bytes, lo: int, hi: int) -> str:
        return " ".join(raw[a:b].decode("utf-8") for a, b in zip(self.starts[lo:hi].tolist(), self.ends[lo:hi].tolist()))


def _bloom_slots(hashes: np.ndarray, bits: int):
    for s in (0, 17, 34, 51):
        yield (mix64(hashes + np.uint64(s)) % np.uint64(bits)).astype(np.int64)


def _test_rows(items: DataFrame, k: int, window: int) -> DataFrame:
    """One row per benchmark fingerprint: words before, at and after it, and the item.  ``size`` is the
    number of words of a short item, else 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item_ids = batch.column("item_id").to_pylist()
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                w, rows = Words(data, offs), []
                raw = w.data.tobytes()
                places, fps = w.fingerprints(k, window)
                owner = np.searchsorted(w.first, places, "right") - 1
                for p, f, t in zip(places.tolist(), fps.view(np.int64).tolist(), owner.tolist()):
                    a, b = max(int(w.first[t]), p - window + k), min(int(w.first[t + 1]), p + window)
                    rows.append({"fp": f, "size": 0, "item_before": w.words(raw, a, p), "item_words": w.words(raw, p, b), "item_id": item_ids[lo + t]})
                for t in np.flatnonzero((w.counts > 0) & (w.counts < window)).tolist():
                    a, n = int(w.first[t]), int(w.counts[t])
                    one = w.hashes[a : a + n]
                    h = np.zeros(1, np.uint64)
                    for x in one:
                        h = h * np.uint64(_GRAM) + x
                    rows.append({"fp": int(mix64(h + np.uint64(n)).view(np.int64)[0]), "size": n, "item_before": "", "item_words": w.words(raw, a, a + n), "item_id": item_ids[lo + t]})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([("fp", pa.int64()), ("size", pa.int64()), ("item_before", pa.string()), ("item_words", pa.string()), ("item_id", pa.int64())]))

    src = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "fp long, size long, item_before string, item_words string, item_id long")


def _bloom(test: DataFrame, count: int) -> np.ndarray | None:
    """A Bloom filter (16 bits a key) of all benchmark fingerprints, merged from one bit set per task."""
    size = max(1 << 10, 2 * count)
    if size > BLOOM_MAX_BYTES:
        return None

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size * 8, bool)
        for batch in batches:
            for s in _bloom_slots(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), size * 8):
                bits[s] = True
        yield pa.RecordBatch.from_pydict({"bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    total = np.zeros(size, np.uint8)
    for r in test.select("fp").coalesce(4).mapInArrow(fill, "bits binary").collect():  # four rows of a checked size
        total |= np.frombuffer(r.bits, np.uint8)
    return total


def _candidates(docs: DataFrame, k: int, window: int, sizes: list[int], bloom: np.ndarray | None, row: str | None) -> DataFrame:
    """Per document its number of words and, for each distinct fingerprint with its neighbours, the places."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bloom)  # at most BLOOM_MAX_BYTES
    struct = pa.struct([("fp", pa.int64()), ("size", pa.int64()), ("before", pa.string()), ("words", pa.string()), ("at", pa.list_(pa.int64()))])

    def possible(hashes: np.ndarray) -> np.ndarray:
        keep = np.arange(len(hashes))
        if shared.value is None:
            return keep
        bits = len(shared.value) * 8
        for s in (0, 17, 34, 51):
            slot = (mix64(hashes[keep] + np.uint64(s)) % np.uint64(bits)).astype(np.int64)
            keep = keep[(shared.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0]
        return keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                w = Words(data, offs)
                found: list[dict] = [{} for _ in range(hi - lo)]
                raw = w.data.tobytes()
                places, fps = w.fingerprints(k, window)
                keep = possible(fps)
                hits = [(0, places[keep], fps[keep])]
                for n in sizes:
                    grams, whole = w.grams(n)
                    at = np.flatnonzero(whole)
                    at = at[possible(grams[at])]
                    hits.append((n, at, grams[at]))
                for n, at, hs in hits:
                    owner = np.searchsorted(w.first, at, "right") - 1
                    for p, f, t in zip(at.tolist(), hs.view(np.int64).tolist(), owner.tolist()):
                        first, stop = int(w.first[t]), int(w.first[t + 1])
                        a, b = (p, p + n) if n else (max(first, p - window + k), min(stop, p + window))
                        key = (f, n, w.words(raw, a, p), w.words(raw, p, b))
                        found[t].setdefault(key, []).append(p - first)
                hits_col = [[{"fp": f, "size": n, "before": x, "words": y, "at": at} for (f, n, x, y), at in d.items()] for d in found]
                yield pa.RecordBatch.from_pydict({
                    "row": batch.column("row").slice(lo, hi - lo),
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "n_words": pa.array(w.counts.astype(np.int64)),
                    "hits": pa.array(hits_col, pa.list_(struct)),
                })

    src = documents_of(docs, row_id(row))
    return src.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, n_words long, hits array<struct<fp:long,size:long,before:string,words:string,at:array<long>>>")


def _shared_prefix(a, b):
    """Number of leading words that two word arrays share."""
    n = F.least(F.size(a), F.size(b))
    same = F.filter(F.transform(F.sequence(F.lit(0), n), lambda i: F.when((i == n) | ~F.get(a, i).eqNullSafe(F.get(b, i)), i)), lambda x: x.isNotNull())
    return F.get(same, F.lit(0))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, row: str | None = None) -> DataFrame:
    """Per document: row, doc_id, n_words, spans (sorted disjoint [start, end) word ranges that items cover),
    n_hit (words in them) and items (sorted distinct item_ids as strings).
    ``row`` names a column of stored row numbers."""
    test = materialize(_test_rows(benchmark, k, window).dropDuplicates(), "winnow-test")
    stats = test.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.when(F.col("size") > 0, F.col("size"))).alias("sizes")).first()
    found = materialize(_candidates(docs, k, window, sorted(stats.sizes), _bloom(test, stats.n), row), "winnow-docs")

    hits = found.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
    joined = hits.join(test, ["fp", "size"])
    words = lambda c: F.filter(F.split(c, " "), lambda x: x != "")
    pairs = joined.select(
        "row", "item_id", "size", "at",
        F.reverse(words("before")).alias("db"), F.reverse(words("item_before")).alias("ib"), words("words").alias("dw"), words("item_words").alias("iw"),
    ).select(
        "row", "item_id", "size", "at",
        F.when(F.col("size") > 0, 0).otherwise(_shared_prefix(F.col("db"), F.col("ib"))).alias("left"),
        _shared_prefix(F.col("dw"), F.col("iw")).alias("right"),
    )
    enough = F.when(F.col("size") > 0, F.col("size")).otherwise(window)
    true_hits = pairs.where((F.col("right") >= F.when(F.col("size") > 0, F.col("size")).otherwise(k)) & (F.col("left") + F.col("right") >= enough))
    spans = true_hits.select("row", "item_id", F.explode("at").alias("p"), "left", "right").select(
        "row", "item_id", (F.col("p") - F.col("left")).alias("s"), (F.col("p") + F.col("right")).alias("e")
    )
    by_row = spans.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("s", "e"))).alias("ranges"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    merged = F.aggregate(
        "ranges",
        F.expr("CAST(array() AS ARRAY<STRUCT<s: BIGINT, e: BIGINT>>)"),
        lambda acc, r: F.when(
            (F.size(acc) > 0) & (r["s"] <= F.element_at(acc, -1)["e"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], r["e"]).alias("e"))),
            ),
        ).otherwise(F.concat(acc, F.array(r))),
    )
    by_row = by_row.select("row", merged.alias("spans"), "items")
    empty_spans, empty_items = F.expr("CAST(array() AS ARRAY<STRUCT<s: BIGINT, e: BIGINT>>)"), F.expr("CAST(array() AS ARRAY<STRING>)")
    return (
        found.select("row", "doc_id", "n_words")
        .join(by_row, "row", "left")
        .select("row", "doc_id", "n_words", F.coalesce("spans", empty_spans).alias("spans"), F.coalesce("items", empty_items).alias("items"))
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, r: a + r["e"] - r["s"]))
    )


def is_contaminated(n_hit, n_words, percent: int = 5):
    """At least one hit word, and hit words at least ``percent`` per cent of all."""
    return (n_hit > 0) & (n_hit * 100 >= n_words * percent)
