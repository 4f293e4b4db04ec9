"""Operator 11: phrases of two and three words, counted by double-array tries over word numbers.

1. Words are counted per language; those of at least ``min_count`` get numbers, and
   every text becomes a stream of word numbers, -1 where a piece ends or a rarer
   word stands: a phrase across such a place cannot reach ``min_count`` (Apriori).
2. Candidate pairs: each block adds its pairs into hashed buckets of 40 bits; a
   bucket's sum bounds the count of each pair in it, so that pairs of buckets below
   ``min_count`` are left out.  Candidate triples: places where both pairs reach
   ``min_count``, under the same bound.  Pairs and triples are shuffled packed, one
   row per piece of a stream and part of the hashes, and a part is summed in numpy.
3. Candidates are dealt by a hash of their numbers to shards of about ``SHARD`` and each
   shard becomes a double-array trie in a file of the shared folder, over the places of
   its numbers in its own sorted list, so that its size does not follow the corpus.  A
   task deals the positions of its streams by the same hash, each to the one shard that
   may hold the phrase there, loads one shard after the other, advances its positions one
   level at a time in numpy, and bincounts the accepting states; the counts are summed.

Scores, the drop rule and the ranks are column expressions.  Decimal arithmetic is
exact below 10^12 occurrences of one phrase.

Defined cases: a null lang is ``und``, a null text is empty; texts without words add
nothing; ties are ranked by count, then by the phrase's bytes; repeated rows count
each; an empty table gives no rows; extra columns are ignored; a long text is read
piece by piece.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, materialize, mix64, runs, scratch_path, shuffle_tasks, small_batches, text_blocks
from .files import filesystem, open_read, open_write

MIN_COUNT = 10
TOP = 2000
COVER_PERCENT = 50
SHARD = 1 << 18
BLOCK = 1 << 20
_PROBES = 128  # bases tried for one set of children
_STREAM = 1 << 21  # word numbers whose positions a task deals to the shards at a time
_NUMBERED = 1 << 24  # bytes of text whose words a task looks up in all shards of words at a time
_PIECE = 1 << 18  # places of these that are sorted at a time
_ROWS = 1 << 16  # rows that a task hands to Spark at a time
_PART = 1 << 19  # occurrences in a part of the candidates, on average at most
_PACKED = "part long, rows binary, n binary"

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _SEPARATOR.copy()
_GAP[[9, 32]] = True


# ---------------------------------------------------------------- words


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """(langs per text, lower-cased bytes, offsets) in blocks of about ``BLOCK`` bytes; a longer text is cut
    behind separators, which no phrase crosses."""
    langs = batch.column("lang")
    for lo, hi, data, offs in text_blocks(batch.column("text"), BLOCK):
        names = langs.slice(lo, hi - lo).to_pylist()
        if hi - lo > 1 or len(data) <= 2 * BLOCK:
            yield names, LOWER[data], offs
            continue
        begin = 0
        while begin < len(data):
            end, size = min(len(data), begin + BLOCK), BLOCK
            while end < len(data):
                cut = np.flatnonzero(_SEPARATOR[data[begin:end]])
                if len(cut):
                    end = begin + int(cut[-1]) + 1
                    break
                size *= 2
                end = min(len(data), begin + size)
            yield names, LOWER[data[begin:end]], np.array([0, end - begin])
            begin = end


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(words, their text, whether a phrase may go on from the word before)."""
    flag = ~_GAP[data]
    starts, ends = runs(flag, offs)
    text = np.searchsorted(offs, starts, "right") - 1
    gaps = np.concatenate([np.zeros(1, np.int32), np.cumsum(_SEPARATOR[data], dtype=np.int32)])
    joined = np.zeros(len(starts), bool)
    joined[1:] = (text[1:] == text[:-1]) & (gaps[starts[1:]] == gaps[ends[:-1]])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[flag].tobytes()))
    return column.dictionary_encode(), text, joined


def _per_lang(names: list[str], text: np.ndarray, words: pa.DictionaryArray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, places of its words, their dictionary indices) of a block."""
    known = {n: k for k, n in enumerate(dict.fromkeys(names))}
    code = np.array([known[n] for n in names], np.int64)[text] if len(text) else np.zeros(0, np.int64)
    index = words.indices.to_numpy(zero_copy_only=False)
    for name, k in known.items():
        at = np.flatnonzero(code == k)
        if len(at):
            yield name, at, index[at]


def _word_counts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, data, offs in _blocks(batch):
                words, text, _ = _words(data, offs)
                for lang, _, index in _per_lang(names, text, words):
                    count = np.bincount(index, minlength=len(words.dictionary))
                    there = np.flatnonzero(count)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(there), pa.string()), "word": words.dictionary.take(pa.array(there)).cast(pa.string()), "n": pa.array(count[there])})

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _numbered(words: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """Words (lang, word, n) with a dense number ``id``, also written to ``folder`` in files of about ``SHARD`` words."""
    total = words.count()
    shards = max(1, -(-total // SHARD))
    dealt = words.withColumn("shard", F.pmod(F.xxhash64("lang", "word"), F.lit(shards)).cast("int"))
    sizes = dict(dealt.groupBy("shard").count().collect())  # one row per shard
    first = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(shards)])]).tolist()

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["lang", "word"]).reset_index(drop=True)
        shard = int(pdf["shard"].iloc[0])
        pdf["id"] = first[shard] + np.arange(len(pdf))
        sink = io.BytesIO()
        pq.write_table(pa.table({"lang": pa.array(pdf["lang"], pa.string()), "word": pa.array(pdf["word"], pa.large_string()), "id": pa.array(pdf["id"], pa.int32())}), sink)
        with open_write(f"{folder}/words-{shard}") as out:  # a second attempt writes the same bytes
            out.write(sink.getvalue())
        return pdf

    got = materialize(dealt.groupBy("shard").applyInPandas(number, "lang string, word string, n long, shard int, id long"), "words")
    return got, shards


def _streams(docs: DataFrame, folder: str, shards: int) -> DataFrame:
    """Word numbers of every block as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, dict] = {}

        def shard(k: int) -> dict:
            if k not in kept:
                kept.clear()
                with open_read(f"{folder}/words-{k}") as f:
                    table = pq.read_table(f).combine_chunks()  # in the order of the languages
                for lang in pc.unique(table["lang"]).to_pylist():
                    part = table.filter(pc.equal(table["lang"], lang)).combine_chunks()
                    kept.setdefault(k, {})[lang] = (part["word"].chunk(0), part["id"].to_numpy())
            return kept[k]

        there = [k for k in range(shards) if _exists(f"{folder}/words-{k}")]

        def numbered(held: list[tuple[pa.DictionaryArray, np.ndarray, np.ndarray]], langs: list[str]) -> Iterator[pa.RecordBatch]:
            words = pa.chunked_array([w for w, _, _ in held]).unify_dictionaries()
            dictionary = words.chunk(0).dictionary
            index = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in words.chunks])
            code = np.concatenate([c for _, c, _ in held])
            places = [np.flatnonzero(code == c) for c in range(len(langs))]
            ids = np.full(len(index), -1, np.int32)
            for k in there:
                known = shard(k)
                for lang, at in zip(langs, places):
                    if lang in known:
                        column, number = known[lang]
                        found = pc.index_in(dictionary, value_set=column).fill_null(-1).to_numpy(zero_copy_only=False)[index[at]]
                        ids[at[found >= 0]] = number[found[found >= 0]]
            begin = 0
            for w, _, joined in held:
                part = ids[begin : begin + len(w)]
                begin += len(w)
                part = np.insert(part, np.flatnonzero(~joined), -1)
                dull = (part[1:] < 0) & (part[:-1] < 0)
                part = part[np.concatenate([[True], ~dull])] if len(part) else part
                yield pa.RecordBatch.from_pydict({"ids": pa.array([part.astype("<i4").tobytes()], pa.binary())})

        held, size, codes = [], 0, {}
        for batch in batches:
            for names, data, offs in _blocks(batch):
                words, text, joined = _words(data, offs)
                lang = np.array([codes.setdefault(n, len(codes)) for n in names], np.int32)
                held.append((words, lang[text] if len(text) else np.zeros(0, np.int32), joined))
                size += len(data)
                if size >= _NUMBERED:
                    yield from numbered(held, list(codes))
                    held, size, codes = [], 0, {}
        if held:
            yield from numbered(held, list(codes))

    return materialize(docs.mapInArrow(run, "ids binary"), "word-streams")


def _exists(path: str) -> bool:
    system, inner = filesystem(path)
    return system.get_file_info(inner).is_file


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The streams of a task, -1 between them, about ``_STREAM`` numbers at a time."""
    held, size = [], 0
    for batch in batches:
        for raw in batch.column("ids"):
            held += [np.frombuffer(raw.as_buffer(), "<i4"), np.array([-1], np.int32)]
            size += len(held[-2])
            if size >= _STREAM:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _handed(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``_ROWS``."""
    for lo in range(0, len(columns[0]), _ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + _ROWS]) for x in columns], names)


# ---------------------------------------------------------------- tries


class Trie:
    """A double-array trie over number sequences of equal length: state ``s`` goes to ``base[s] + x`` if ``check`` there is ``s``.

    The trie knows the numbers that occur in it by their places in ``letters``.  States below ``size`` are those of the first
    numbers; ``accept`` holds the place of a sequence in its sorted list.
    """

    def __init__(self, letters: np.ndarray, base: np.ndarray, check: np.ndarray, accept: np.ndarray):
        self.letters, self.base, self.check, self.accept = letters, base, check, accept

    @classmethod
    def build(cls, rows: np.ndarray) -> "Trie":
        """From distinct rows [n, length] in ascending order."""
        width = rows.shape[1]
        letters, rows = np.unique(rows, return_inverse=True)
        rows = rows.reshape(-1, width)
        size = int(rows[:, 0].max()) + 1
        base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        check[np.unique(rows[:, 0])] = -2  # children of the root
        state, rng = rows[:, 0].astype(np.int64), np.random.default_rng(0)  # the same trie in every attempt
        for level in range(1, rows.shape[1]):
            prefix = np.concatenate([[True], (rows[1:, : level + 1] != rows[:-1, : level + 1]).any(1)])
            child = np.flatnonzero(prefix)
            owner, x = state[child], rows[child, level].astype(np.int64)
            cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            number = np.diff(np.append(cut, len(owner)))
            low, used = size, len(check)
            for g in np.argsort(-number, kind="stable").tolist():
                if number[g] == 1:
                    break
                mine = x[cut[g] : cut[g] + number[g]]
                lowest, highest = low - int(mine[0]), used - int(mine[-1])
                tries = rng.integers(lowest, highest, max(1, min(_PROBES, (1 << 20) // len(mine)))) if highest > lowest else np.zeros(0, np.int64)
                good = (check[tries[:, None] + mine] == -1).all(1)
                if good.any():
                    b = int(tries[np.argmax(good)])
                else:  # behind all others; the places between the children stay free for smaller sets
                    b = used - int(mine[0])
                    used += int(mine[-1] - mine[0]) + 1
                    if used > len(check):
                        grow = max(used, len(check) * 5 // 4) - len(check)
                        base, check = np.append(base, np.zeros(grow, np.int32)), np.append(check, np.full(grow, -1, np.int32))
                base[owner[cut[g]]] = b
                check[b + mine] = owner[cut[g]]
            base, check = base[:used], check[:used]
            lone = cut[number == 1]
            free = low + np.flatnonzero(check[low:] == -1)[: len(lone)]
            if len(free) < len(lone):
                grow = len(lone) - len(free)
                free = np.append(free, len(check) + np.arange(grow))
                base, check = np.append(base, np.zeros(grow, np.int32)), np.append(check, np.full(grow, -1, np.int32))
            base[owner[lone]] = free - x[lone]
            check[free] = owner[lone]
            state = (base[owner] + x)[np.cumsum(prefix) - 1]
        accept = np.full(len(check), -1, np.int32)
        accept[state] = np.arange(len(rows))
        return cls(letters.astype(np.int32), base, check, accept)

    def _letters(self, ids: np.ndarray) -> np.ndarray:
        """Places of numbers in ``letters``, -1 for any other number."""
        found = np.minimum(np.searchsorted(self.letters, ids), len(self.letters) - 1)
        return np.where(self.letters[found] == ids, found, -1)

    def walk(self, ids: np.ndarray, length: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(position, place in the list) of every occurrence of a sequence in ``ids``, or of those that begin at ``at``."""
        if at is None:
            at = np.arange(max(0, len(ids) - length + 1))
        state = self._letters(ids[at])
        go = (state >= 0) & (state < len(self.check))
        go[go] = self.check[state[go]] == -2
        at, state = at[go], state[go]
        for level in range(1, length):
            x = self._letters(ids[at + level])
            to = self.base[state].astype(np.int64) + x
            go = (x >= 0) & (to >= 0) & (to < len(self.check))
            go[go] = self.check[to[go]] == state[go]
            at, state = at[go], to[go]
        return at, self.accept[state]

    def walks(self, ids: np.ndarray, length: int, at: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``walk`` from ``_PIECE`` positions at a time."""
        at = np.arange(max(0, len(ids) - length + 1)) if at is None else at
        for lo in range(0, len(at), _PIECE):
            yield self.walk(ids, length, at[lo : lo + _PIECE])

    def save(self, path: str) -> None:
        with open_write(path) as out:
            out.write(np.array([len(self.letters), len(self.check)], "<i8").tobytes())
            for a in (self.letters, self.base, self.check, self.accept):
                out.write(a.astype("<i4").tobytes())

    @classmethod
    def load(cls, path: str) -> "Trie":
        with open_read(path) as f:
            raw = f.read()
        m, n = np.frombuffer(raw, "<i8", 2).tolist()
        return cls(np.frombuffer(raw, "<i4", m, 16), *np.frombuffer(raw, "<i4", 3 * n, 16 + 4 * m).reshape(3, n))


def _shard_of(rows: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each sequence [n, length] of word numbers."""
    return ((_hashes(rows) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _dealt(ids: np.ndarray, length: int, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, the positions whose ``length`` numbers it may hold): every position without -1 goes to one shard."""
    whole = ids >= 0
    at = np.flatnonzero(np.logical_and.reduce([whole[i : max(0, len(ids) - length + 1) + i] for i in range(length)]))
    if shards == 1:
        yield 0, at
        return
    pieces = [at[lo : lo + _PIECE] for lo in range(0, len(at), _PIECE)]
    shard = np.concatenate([_shard_of(np.stack([ids[x + i] for i in range(length)], 1), shards) for x in pieces] or [np.zeros(0, np.int32)])
    order = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    ends = np.cumsum(np.bincount(shard, minlength=shards))
    for k in range(shards):
        yield k, at[order[ends[k - 1] if k else 0 : ends[k]]]


def _walked(streams: Iterator[np.ndarray], length: int, folder: str, shards: int) -> Iterator[tuple[np.ndarray, int, Trie, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """(stream, shard, its trie, its ``walks`` from the positions dealt to it) of every shard, stream by stream."""
    last: dict[int, Trie] = {}
    there = {k for k in range(shards) if _exists(f"{folder}/trie-{k}")}
    for ids in streams:
        for k, at in _dealt(ids, length, shards):
            if k in there and len(at):
                if k not in last:
                    last.clear()
                    last[k] = Trie.load(f"{folder}/trie-{k}")
                yield ids, k, last[k], last[k].walks(ids, length, at)


def _build_tries(candidates: DataFrame, columns: list[str], folder: str) -> tuple[DataFrame, int]:
    """Candidates with their shard and place, and the number of shards, whose tries lie in ``folder``."""
    shards = max(1, -(-candidates.count() // SHARD))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(columns).reset_index(drop=True)
        Trie.build(pdf[columns].to_numpy(np.int64)).save(f"{folder}/trie-{pdf['shard'].iloc[0]}")
        pdf["place"] = np.arange(len(pdf))
        return pdf

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = _shard_of(np.stack([batch.column(c).to_numpy() for c in columns], 1), shards)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(shard)], [*columns, "shard"])

    schema = ", ".join(f"{c} long" for c in columns) + ", shard int"
    dealt = candidates.select(*columns).mapInArrow(deal, schema)
    return materialize(dealt.groupBy("shard").applyInPandas(build, f"{schema}, place long"), "candidates"), shards


def _counted(streams: DataFrame, candidates: DataFrame, columns: list[str], folder: str, min_count: int) -> tuple[DataFrame, int]:
    """Candidates whose occurrences, counted by the tries, reach ``min_count``: the columns, shard, place and ``f``."""
    dealt, shards = _build_tries(candidates, columns, folder)
    length = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, k, trie, walks in _walked(_joined(batches), length, folder, shards):
            count = np.zeros(len(trie.accept), np.int32)
            for _, place in walks:
                found = np.bincount(place)
                count[: len(found)] += found.astype(np.int32)
            hit = np.flatnonzero(count)
            yield from _handed([np.full(len(hit), k, np.int32), hit, count[hit].astype(np.int64)], ["shard", "place", "f"])

    found = streams.mapInArrow(run, "shard int, place long, f long").groupBy("shard", "place").agg(F.sum("f").alias("f"))
    return materialize(dealt.join(found.where(F.col("f") >= min_count), ["shard", "place"]), "counted"), shards


# ---------------------------------------------------------------- candidates


def _bounded(local: DataFrame, columns: list[str], min_count: int) -> DataFrame:
    """Distinct candidates of ``local`` (bucket, columns, n) whose bucket's sum reaches ``min_count``."""
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("lo", F.min), ("hi", F.max))]
    sums = materialize(local.groupBy("bucket").agg(F.sum("n").alias("n"), *ends).where(F.col("n") >= min_count), "buckets")
    one = F.expr(" AND ".join(f"lo_{c} = hi_{c}" for c in columns))
    alone = sums.where(one).select(*[F.col(f"lo_{c}").alias(c) for c in columns])
    shared = sums.where(~one).select("bucket")
    if shared.isEmpty():
        return alone
    return materialize(alone.union(local.join(shared, "bucket", "left_semi").select(*columns).distinct()), "bounded")


def _hashes(rows: np.ndarray) -> np.ndarray:
    """A hash of each pair or triple of numbers below 2^32, whose upper 40 bits are its bucket."""
    out = mix64(rows[:, 0].astype(np.uint64) << np.uint64(32) | rows[:, 1].astype(np.uint64))
    return out if rows.shape[1] == 2 else mix64(out ^ rows[:, 2].astype(np.uint64))


def _summed(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, rows, sums of n) in the order of the hashes; equal rows are one, but for those of two rows with one hash."""
    hashes = _hashes(rows)
    order = np.argsort(hashes)
    hashes, rows, n = hashes[order], rows[order], n[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(rows)), bool), (rows[1:] != rows[:-1]).any(1)]))
    return hashes[first], rows[first], np.add.reduceat(n, first) if len(first) else n


def _packed(rows: np.ndarray, parts: int) -> pa.RecordBatch:
    """Occurrences as one row per part of the hashes: its distinct candidates and their counts as 32-bit integers."""
    hashes, rows, n = _summed(rows, np.ones(len(rows), np.int32))
    part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(part)), bool), part[1:] != part[:-1]]))
    bounds = np.append(first, len(part)).astype(np.int32)
    packed = [pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds * (4 * width)), pa.py_buffer(x.astype("<i4").tobytes())]) for x, width in ((rows, rows.shape[1]), (n, 1))]
    return pa.RecordBatch.from_arrays([pa.array(part[first]), *packed], ["part", "rows", "n"])


def _unpacked(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit integers [n, width] of all binary values, where each value begins and the last ends)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 4
    values = np.frombuffer(column.buffers()[2], "<i4")[offsets[0] : offsets[-1]]
    return values.reshape(-1, width), (offsets - offsets[0]) // width


def _reaching(packed: DataFrame, columns: list[str], min_count: int) -> DataFrame:
    """Rows (bucket, columns, n) of the buckets whose sum reaches ``min_count``; a task sums one part after the other."""
    width = len(columns)

    def reaching(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        hashes, rows, n = _summed(np.concatenate([r for r, _ in held]), np.concatenate([c for _, c in held]).astype(np.int64))
        if len(rows):
            bucket = (hashes >> np.uint64(24)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            keep = np.repeat(np.add.reduceat(n, first) >= min_count, np.diff(np.append(first, len(n))))
            yield from _handed([bucket[keep], *rows[keep].astype(np.int64).T, n[keep]], ["bucket", *columns, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None  # of the last part, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part").to_numpy()
            (rows, starts), (n, _) = _unpacked(batch.column("rows"), width), _unpacked(batch.column("n"), 1)
            n, at = n[:, 0], 0
            if part[-1] != last:
                at = starts[np.searchsorted(part, part[-1])]
                yield from reaching([*held, (rows[:at], n[:at])])
                held, last = [], part[-1]
            held.append((rows[at:], n[at:]))
        if held:
            yield from reaching(held)

    spread = packed.repartition(shuffle_tasks(packed.sparkSession), "part").sortWithinPartitions("part")
    return materialize(spread.mapInArrow(run, "bucket long, " + ", ".join(f"{c} long" for c in columns) + ", n long"), "reaching")


def _pairs(streams: DataFrame, min_count: int, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids in _joined(batches):
            every = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            for lo in range(0, len(every), _PIECE):
                at = every[lo : lo + _PIECE]
                yield _packed(np.stack([ids[at], ids[at + 1]], 1), parts)

    columns = ["a", "b"]
    return _bounded(_reaching(streams.mapInArrow(run, _PACKED), columns, min_count), columns, min_count)


def _triples(streams: DataFrame, pairs: DataFrame, folder: str, min_count: int, parts: int) -> DataFrame:
    """Triples whose two pairs are both in ``pairs``, marked position by position with the pairs' tries."""
    _, shards = _build_tries(pairs.select("a", "b"), ["a", "b"], folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def marked(ids: np.ndarray, pair: np.ndarray) -> Iterator[pa.RecordBatch]:
            every = np.flatnonzero(pair[:-1] & pair[1:])
            for lo in range(0, len(every), _PIECE):
                at = every[lo : lo + _PIECE]
                yield _packed(np.stack([ids[at], ids[at + 1], ids[at + 2]], 1), parts)

        last, pair = None, None
        for ids, _, _, walks in _walked(_joined(batches), 2, folder, shards):
            if ids is not last:
                if last is not None:
                    yield from marked(last, pair)
                last, pair = ids, np.zeros(len(ids) + 1, bool)
            for at, _ in walks:
                pair[at] = True
        if last is not None:
            yield from marked(last, pair)

    columns = ["a", "b", "c"]
    return _bounded(_reaching(streams.mapInArrow(run, _PACKED), columns, min_count), columns, min_count)


# ---------------------------------------------------------------- scores


def _score(a: str, left: str, right: str) -> str:
    big = "CAST({} AS DECIMAL(12,0))"
    return f"(CAST(1000000 AS DECIMAL(7,0)) * ({big.format(a)} * {big.format(a)})) div ({big.format(left)} * {big.format(right)})"


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, cover_percent: int = COVER_PERCENT) -> DataFrame:
    """Every phrase that stays after the drop rule: lang, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    folder = scratch_path(spark, "tries")
    with small_batches(spark):  # all Python steps run here
        counts = materialize(_word_counts(texts), "word-counts")
        words, shards = _numbered(counts.where(F.col("n") >= min_count), folder)
        streams = _streams(texts, folder, shards)
        parts = max(4 * shuffle_tasks(spark), (words.agg(F.sum("n")).first()[0] or 0) // _PART)
        two, _ = _counted(streams, _pairs(streams, min_count, parts), ["a", "b"], f"{folder}/2", min_count)
        three, _ = _counted(streams, _triples(streams, two, f"{folder}/2f", min_count, parts), ["a", "b", "c"], f"{folder}/3", min_count)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))

    def word(number: str) -> DataFrame:
        return words.select(F.col("id").alias(number), F.col("lang").alias(f"lang_{number}"), F.col("word").alias(f"w_{number}"), F.col("n").alias(f"n_{number}"))

    longer = three.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("c").alias("b")))).alias("p"), "f").groupBy("p.a", "p.b").agg(F.max("f").alias("longest"))
    pairs = two.select("a", "b", "f").join(longer, ["a", "b"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < cover_percent * F.col("f")))
    pairs = pairs.join(word("a"), "a").join(word("b"), "b")
    out2 = pairs.select(F.col("lang_a").alias("lang"), F.concat_ws(" ", "w_a", "w_b").alias("phrase"), F.col("f").alias("a"), F.col("n_a").alias("l"), F.col("n_b").alias("r"), F.expr(_score("f", "n_a", "n_b")).alias("score"))
    head = two.select("a", "b", F.col("f").alias("f_head"))
    tail = two.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_tail"))
    cuts = three.select("a", "b", "c", "f").join(head, ["a", "b"]).join(tail, ["b", "c"]).join(word("a"), "a").join(word("b"), "b").join(word("c"), "c")
    cuts = cuts.withColumn("first", F.expr(_score("f", "n_a", "f_tail"))).withColumn("second", F.expr(_score("f", "f_head", "n_c")))
    early = F.col("first") <= F.col("second")
    out3 = cuts.select(
        F.col("lang_a").alias("lang"),
        F.concat_ws(" ", "w_a", "w_b", "w_c").alias("phrase"),
        F.col("f").alias("a"),
        F.when(early, F.col("n_a")).otherwise(F.col("f_head")).alias("l"),
        F.when(early, F.col("f_tail")).otherwise(F.col("n_c")).alias("r"),
        F.least("first", "second").alias("score"),
    )
    return out2.union(out3).join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top_phrases(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each lang, with ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("bigint"))
