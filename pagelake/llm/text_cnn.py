"""Operator 7: toxicity classifier, a convolutional network over hashed word embeddings.

A word's vector is the sum of the table rows of its hash and of the hashes of
its first 4, 5 and 6 bytes, so that inflections share most of a vector.  Filters
of several widths slide over the words of the whole text, each keeps its largest
response, and a linear layer gives the log-odds.  The network is trained on every
labelled row: rows are dealt by doc_id to shards of about ``SHARD_ROWS``, whose word
ids lie in files of the shared folder.  One task per shard trains a copy of the network
on all rows of its shard, a few MB at a time; after 1, 2, 4 and 8 epochs Spark sums what
the copies moved, and all go on from their mean; the driver only holds the averaged network, which is of
fixed size.  Sums are of whole numbers, so that their order does not matter.  Rows of
the table that no training text used are zero.  A fifth of the rows, by hash of
the doc_id, is not trained on and calibrates a threshold per language, from counts
over cells of the log-odds.

Defined cases: null and empty texts and others without words score 0; with labels
of one class only every other text gets that class's score, with none 0.5; a language without enough
calibration rows takes the common threshold; of a repeated doc_id the row lowest in
hash order is learned from; repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, WORD_BYTE, crc_split, documents_of, joined_blocks, row_id, runs, scratch_path, span_hashes, text_blocks
from .files import filesystem, open_read, open_write
from .labelled import labelled_rows, prior_shift, training_labels

SHARD_ROWS = 1 << 13
JOIN_ROWS = 1 << 18  # labelled ids that are broadcast to the scan of texts; more are joined by a shuffle
TRAIN_BYTES = 1 << 21  # texts that a task shuffles and trains on at a time
CALIBRATION = 5  # one row in so many calibrates the thresholds
CELLS = 1024  # cells of one unit of log-odds, from -20 to 20
POINT = float(1 << 32)  # sums of the copies are in whole numbers of 1 / POINT
BUCKETS = 1 << 17
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 12
PREFIXES = (4, 5, 6)
EPOCHS = 8
TABLE_RATE = 0.1
KEEP_WORDS = 0.85
MIN_LANGUAGE_ROWS = 40
SCORE_BYTES = 1 << 20


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(int32 (words, 1 + prefixes) table rows, words per text) of a byte block."""
    data = LOWER[data]
    starts, ends = runs(WORD_BYTE[data], offsets)
    ids = [span_hashes(data, starts, ends)]
    ids += [span_hashes(data, starts, np.minimum(ends, starts + p)) * np.uint64(2 * p + 1) for p in PREFIXES]
    return np.stack([(h >> np.uint64(40)).astype(np.int32) & (BUCKETS - 1) for h in ids], 1), np.diff(np.searchsorted(starts, offsets))


class TextCNN:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
        self.taps = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.base = np.zeros(1, np.float32)
        self.shift = 0.0
        self.thresholds: dict[str, float] = {}
        self.threshold = 0.5

    def _pooled(self, ids: np.ndarray, counts: np.ndarray):
        """Largest responses (texts, filters) and where they were; texts are set apart by zero words."""
        gap = max(WIDTHS)
        begin = np.cumsum(counts + gap) - (counts + gap)
        end = begin + np.maximum(counts, 1)  # responses that start at a word of the text
        x = np.zeros((int((counts + gap).sum()) + gap + 1, DIM), np.float32)
        place = np.arange(len(ids)) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
        vectors = self.table[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            vectors += self.table[ids[:, k]]
        x[place] = vectors
        pooled, where = [], []
        for w, taps, bias in zip(WIDTHS, self.taps, self.bias):
            y = x[: len(x) - w + 1] @ taps[0]
            for j in range(1, w):
                y += x[j : len(x) - w + 1 + j] @ taps[j]
            top = np.maximum.reduceat(y, np.stack([begin, end], 1).ravel(), 0)[::2]
            pooled.append(top + bias)
            where.append((y, top))
        return x, np.concatenate(pooled, 1), where, place, begin, end

    def dense(self) -> list[np.ndarray]:
        """The parameters beside the table."""
        return [self.out, self.base] + [p for pair in zip(self.taps, self.bias) for p in pair]

    def log_odds(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(counts):
            return np.zeros(0)
        pooled = self._pooled(ids, counts)[1]
        return np.maximum(pooled, 0) @ self.out + self.base[0] + self.shift

    def score(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Likelihood of label 1; 0 for texts without words."""
        return np.where(counts > 0, 1 / (1 + np.exp(-np.clip(self.log_odds(ids, counts).astype(np.float64), -40, 40))), 0.0)

    def _step(self, ids, counts, y, state, rate: float) -> None:
        x, pooled, where, place, begin, end = self._pooled(ids, counts)
        active = np.maximum(pooled, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ self.out + self.base[0], -40, 40)))
        d = ((p - y) / len(y)).astype(np.float32)
        grads = [active.T @ d, np.array([d.sum()], np.float32)]
        d_pool = np.where(pooled > 0, d[:, None] * self.out, 0).astype(np.float32)
        dx = np.zeros_like(x)
        for k, (w, (resp, top)) in enumerate(zip(WIDTHS, where)):
            g = d_pool[:, k * FILTERS : (k + 1) * FILTERS]
            at = np.stack([begin[t] + (resp[begin[t] : end[t]] == top[t]).argmax(0) for t in range(len(begin))])  # (texts, filters)
            d_taps = np.zeros_like(self.taps[k])
            for j in range(w):
                rows = x[at + j]  # texts, filters, dim
                d_taps[j] = np.einsum("tfd,tf->df", rows, g)
                np.add.at(dx, at + j, g[:, :, None] * self.taps[k][j].T[None])
            grads += [d_taps, g.sum(0)]
        for i, (param, grad) in enumerate(zip(self.dense(), grads)):  # Adam
            m, v = state.setdefault(i, [np.zeros_like(param), np.zeros_like(param)])
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            param -= rate * (m / (1 - 0.9 ** state["t"])) / (np.sqrt(v / (1 - 0.999 ** state["t"])) + 1e-8)
        moved = np.flatnonzero(np.abs(dx).sum(1)[place])
        if len(moved):  # Adagrad on the table rows that the largest responses used
            rows = ids[moved].ravel()
            grad = np.repeat(dx[place[moved]], ids.shape[1], 0)
            uniq, back = np.unique(rows, return_inverse=True)
            total = np.zeros((len(uniq), DIM), np.float32)
            np.add.at(total, back, grad)
            state["table"][uniq] += (total * total).mean(1)
            self.table[uniq] -= TABLE_RATE * total / np.sqrt(state["table"][uniq] + 1e-8)[:, None]
        state["t"] += 1


def constant_cnn(label: float | None, seed: int = 7) -> TextCNN:
    """The network of labels of one class, or of none."""
    model = TextCNN(seed)
    model.out[:] = 0
    model.base[0] = 0.0 if label is None else (20.0 if label else -20.0)
    return model


def fit_cnn(ids: list[np.ndarray], y: np.ndarray, langs: list[str | None], shift: float = 0.0, epochs: int = EPOCHS, batch: int = 32, seed: int = 7) -> TextCNN:
    """Train here on four fifths of a bounded sample of texts, calibrate the thresholds on the rest."""
    if len(set(y.tolist())) < 2:
        return constant_cnn(y[0] if len(y) else None, seed)
    model = TextCNN(seed)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    test, train = order[: len(y) // 5], order[len(y) // 5 :]
    state: dict = {"t": 1, "table": np.zeros(BUCKETS, np.float32)}
    # texts without known words, as clean ones: what the network has never seen is no sign of label 1
    ids, y = [*ids, np.zeros((0, 1 + len(PREFIXES)), np.int32)], np.append(y, np.float32(0))
    train = np.append(train, np.full(1 + len(train) // 100, len(y) - 1))
    for epoch in range(epochs):
        rng.shuffle(train)
        for lo in range(0, len(train), batch):
            # each text shows a random share of its words, so that every telling word learns to stand alone
            texts = [ids[i][rng.random(len(ids[i])) < KEEP_WORDS] for i in train[lo : lo + batch]]
            model._step(np.concatenate(texts), np.array([len(t) for t in texts]), y[train[lo : lo + batch]], state, 0.01 / (1 + epoch))
    used = np.zeros(BUCKETS, bool)
    for i in train:
        used[ids[i].ravel()] = True
    model.table[~used] = 0
    model.shift = shift
    score = np.concatenate([model.score(ids[i], np.array([len(ids[i])])) for i in test])
    model.threshold = best_threshold(score, y[test])
    tags = np.array([langs[i] or "" for i in test])
    for lang in sorted(set(tags.tolist())):
        mine = tags == lang
        if mine.sum() >= MIN_LANGUAGE_ROWS and 0 < y[test][mine].sum() < mine.sum():
            model.thresholds[lang] = best_threshold(score[mine], y[test][mine])
    return model


def best_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap between two scores whose cut has the largest F1."""
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + max(1, y.sum()))
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


# ---------------------------------------------------------------- training on all labelled rows


def _write_shards(docs: DataFrame, known: DataFrame, rows: int, folder: str) -> tuple[int, np.ndarray]:
    """Files of word ids, labels and languages, and (their number, which table rows the texts to train on use)."""
    shards = max(1, -(-rows // SHARD_ROWS))
    texts = documents_of(docs, _language(docs)).where(F.col("doc_id").isNotNull() & ~crc_split(F.col("doc_id")))
    row = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang", "label")).alias("r")
    if rows <= JOIN_ROWS:
        least = texts.join(F.broadcast(known), "doc_id").repartition(shards, "doc_id").groupBy("doc_id").agg(row)
    else:
        least = texts.join(known, "doc_id").groupBy("doc_id").agg(row).repartition(shards, "doc_id")
    apart = (F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATION)) == 0).alias("apart")
    dealt = least.select("doc_id", "r.text", "r.lang", "r.label", apart).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, out, writer = np.zeros(BUCKETS, bool), None, None
        for part, data, offs in joined_blocks(batches, TRAIN_BYTES):
            ids, counts = word_ids(data, offs)
            ends = np.concatenate([[0], np.cumsum(counts)]) * ids.shape[1]
            table = pa.table({
                "label": part.column("label"), "lang": part.column("lang"), "apart": part.column("apart"),
                "ids": pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(ids.ravel(), pa.int32())),
            })
            used[ids[np.repeat(~part.column("apart").to_numpy(zero_copy_only=False), counts)].ravel()] = True
            if writer is None:  # a second attempt writes the same rows
                out = open_write(f"{folder}/shard-{TaskContext.get().partitionId()}")
                writer = pq.ParquetWriter(out, table.schema, compression="zstd")
            writer.write_table(table)  # a row group
        if writer is not None:
            writer.close()
            out.close()
        yield pa.RecordBatch.from_pydict({"id": pa.array(np.flatnonzero(used), pa.int32())})

    used = np.zeros(BUCKETS, bool)
    used[dealt.select("text", "lang", "label", "apart").mapInArrow(run, "id int").distinct().toArrow()["id"].to_numpy()] = True
    return shards, used


def _row_groups(path: str, order=range) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray, list[str]]]:
    """(word ids per text, labels, whether set apart, languages) of each row group of a shard."""
    system, inner = filesystem(path)
    if not system.get_file_info(inner).is_file:  # no row was dealt to it
        return
    with open_read(path) as f:
        file = pq.ParquetFile(f)
        for k in order(file.num_row_groups):
            table = file.read_row_group(int(k)).combine_chunks()
            column = table["ids"].chunk(0)
            ids = column.values.to_numpy().reshape(-1, 1 + len(PREFIXES))
            ends = column.offsets.to_numpy() // ids.shape[1]
            texts = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield texts, table["label"].to_numpy().astype(np.float32), table["apart"].to_numpy(), [x or "" for x in table["lang"].to_pylist()]


def _moments(model: TextCNN, state: dict) -> np.ndarray:
    """Parameters beside the table, their Adam moments and the number of steps, as one vector."""
    parts = [p.ravel() for p in model.dense()]
    for k in (0, 1):  # the second ones as roots, which are of the size of gradients
        parts += [(np.sqrt(state[i][1]) if k else state[i][0]).ravel() for i in range(len(model.dense()))]
    return np.concatenate([*parts, [state["t"]]]).astype(np.float64)


def _set_moments(model: TextCNN, state: dict, vector: np.ndarray) -> None:
    places = model.dense() + [state[i][k] for k in (0, 1) for i in range(len(model.dense()))]
    cut = np.cumsum([p.size for p in places])
    for i, (place, part) in enumerate(zip(places, np.split(vector[:-1], cut[:-1]))):
        place[...] = (part**2 if i >= len(places) * 2 // 3 else part).reshape(place.shape)
    state["t"] = float(vector[-1])


def _train_shard(model: TextCNN, state: dict, path: str, epoch: int, batch: int, seed: list[int]) -> None:
    """One pass over the rows of a shard that are not set apart."""
    rng = np.random.default_rng([*seed, epoch])
    for ids, y, apart, _ in _row_groups(path, rng.permutation):
        # texts without known words, as clean ones: what the network has never seen is no sign of label 1
        ids, y = [*ids, np.zeros((0, 1 + len(PREFIXES)), np.int32)], np.append(y, np.float32(0))
        train = np.flatnonzero(~apart)
        train = rng.permutation(np.append(train, np.full(1 + len(train) // 100, len(y) - 1)))
        for lo in range(0, len(train), batch):
            # each text shows a random share of its words, so that every telling word learns to stand alone
            texts = [ids[i][rng.random(len(ids[i])) < KEEP_WORDS] for i in train[lo : lo + batch]]
            model._step(np.concatenate(texts), np.array([len(t) for t in texts]), y[train[lo : lo + batch]], state, 0.01 / (1 + epoch))


def _round(spark: SparkSession, model: TextCNN, state: dict, folder: str, shards: int, epochs: range, batch: int, seed: int) -> None:
    """Train a copy of the network on each shard for some epochs and move the network by the mean of what the copies moved.

    A row of the table moves by the mean over the copies that used it, with its Adagrad sum."""
    shared = spark.sparkContext.broadcast((model, state))  # of fixed size
    width = DIM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers in batches:
            for k in numbers.column("id").to_pylist():
                old, old_state = shared.value
                new, new_state = copy.deepcopy(shared.value)
                for epoch in epochs:
                    _train_shard(new, new_state, f"{folder}/shard-{k}", epoch, batch, [seed, k])
                if new_state["t"] == old_state["t"]:
                    continue
                rows = np.flatnonzero(new_state["table"] != old_state["table"])
                moved = np.concatenate([new.table[rows], new_state["table"][rows, None]], 1, dtype=np.float64) - np.concatenate([old.table[rows], old_state["table"][rows, None]], 1, dtype=np.float64)
                rest = _moments(new, new_state) - _moments(old, old_state)
                rest = np.append(rest, np.zeros(-len(rest) % width)).reshape(-1, width)
                values = np.rint(np.concatenate([moved, rest]) * POINT).astype(np.int64)
                rows = np.append(rows, BUCKETS + np.arange(len(rest)))
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32())] + [pa.array(np.ascontiguousarray(values[:, j])) for j in range(width)], ["id", *(f"v{j}" for j in range(width))])

    names = [f"v{j}" for j in range(width)]
    moved = spark.range(0, shards, 1, shards).mapInArrow(run, "id int, " + ", ".join(f"{n} long" for n in names))
    moved = moved.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).toArrow()  # one row per table row
    shared.unpersist()
    rows, n = moved["id"].to_numpy(), moved["n"].to_numpy()
    mean = np.stack([moved[name].to_numpy() for name in names], 1) / (POINT * n[:, None])
    table = rows < BUCKETS
    model.table[rows[table]] += mean[table, :DIM].astype(np.float32)
    state["table"][rows[table]] += mean[table, DIM].astype(np.float32)
    vector = _moments(model, state)
    rest = np.zeros((-(-len(vector) // width), width))
    rest[rows[~table] - BUCKETS] = mean[~table]
    _set_moments(model, state, vector + rest.ravel()[: len(vector)])


def _calibrate(spark: SparkSession, model: TextCNN, folder: str, shards: int) -> None:
    """Thresholds from the rows set apart: counts per language and cell of the log-odds, cut where F1 is largest."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers in batches:
            for k in numbers.column("id").to_pylist():
                for ids, y, apart, langs in _row_groups(f"{folder}/shard-{k}"):
                    at = np.flatnonzero(apart)
                    if len(at):
                        score = shared.value.score(np.concatenate([ids[i] for i in at]), np.array([len(ids[i]) for i in at]))
                        yield pa.RecordBatch.from_pydict({"lang": [langs[i] for i in at], "cell": score_cells(score), "score": score, "label": y[at].astype(np.int64)})

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cell", ascending=False)
        value = best_cut(*(pdf[c].to_numpy() for c in ("n", "hits", "low", "high")))
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "n": [pdf["n"].sum()], "hits": [pdf["hits"].sum()], "value": [value]})

    rows = spark.range(0, shards, 1, shards).mapInArrow(run, "lang string, cell int, score double, label long")
    cells = rows.groupBy("lang", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits"), F.min("score").alias("low"), F.max("score").alias("high"))
    every = F.explode(F.array(F.col("lang"), F.lit(None).cast("string")))  # null: the common threshold
    cells = cells.withColumn("lang", every).groupBy("lang", "cell").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.min("low").alias("low"), F.max("high").alias("high"))
    for r in cells.groupBy("lang").applyInPandas(best, "lang string, n long, hits long, value double").collect():  # one row per language
        if r.lang is None:
            model.threshold = r.value
        elif r.n >= MIN_LANGUAGE_ROWS and 0 < r.hits < r.n:
            model.thresholds[r.lang] = r.value
    shared.unpersist()


def score_cells(score: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return ((np.clip(np.log(score) - np.log1p(-score), -20, 20) + 20) * CELLS).astype(np.int32)


def best_cut(n: np.ndarray, hits: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """``best_threshold`` over cells by descending score: their rows, rows of label 1, least and largest score."""
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + max(1, hits.sum()))
    k = int(np.argmax(f1))
    return float((low[k] + high[k + 1]) / 2) if k + 1 < len(n) else float(low[k])


def fit_all(docs: DataFrame, labels: DataFrame, epochs: int = EPOCHS, batch: int = 32, seed: int = 7) -> TextCNN:
    """Fit the network on every labelled row outside the held-out split."""
    spark = docs.sparkSession
    known, counts = labelled_rows(labels, docs, "toxic")
    if not all(counts.values()):
        return constant_cnn(None if not any(counts.values()) else float(counts[1] > 0), seed)
    folder = scratch_path(spark, "toxicity-shards")
    shards, used = _write_shards(docs, known, sum(counts.values()), folder)
    model = TextCNN(seed)
    state: dict = {"t": 1, "table": np.zeros(BUCKETS, np.float32)} | {i: [np.zeros_like(p), np.zeros_like(p)] for i, p in enumerate(model.dense())}
    done = 0
    while done < epochs:
        upto = min(epochs, max(1, 2 * done))
        _round(spark, model, state, folder, shards, range(done, upto), batch, seed)
        done = upto
    model.table[~used] = 0
    _calibrate(spark, model, folder, shards)
    return model


def train_toxicity(docs: DataFrame, labels: DataFrame, per_class: int | None = None) -> TextCNN:
    """Fit the network on every labelled row; with ``per_class`` on a sample of so many rows of each class, on the driver."""
    if per_class is None:
        return fit_all(docs, labels)
    chosen, counts = training_labels(labels, docs, "toxic", per_class)
    texts = documents_of(docs, _language(docs)).join(F.broadcast(chosen), "doc_id")  # all rows of at most 2 * per_class ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                ids, counts = word_ids(data, offs)
                cut = np.cumsum(counts)
                raw = [ids[a:b].tobytes() for a, b in zip((cut - counts).tolist(), cut.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo), "label": batch.column("label").slice(lo, hi - lo),
                    "lang": batch.column("lang").slice(lo, hi - lo), "ids": pa.array(raw, pa.binary()),
                })

    found = texts.select("doc_id", "label", "lang", "text").mapInArrow(run, "doc_id long, label int, lang string, ids binary")
    # of a repeated doc_id the row lowest in hash order, combined before the shuffle: at most 2 * per_class rows
    least = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("ids").alias("h"), "ids", "lang", "label")).alias("r"))
    rows = least.select("doc_id", "r.*").collect()
    rows.sort(key=lambda r: r.doc_id)
    ids = [np.frombuffer(r.ids, np.int32).reshape(-1, 1 + len(PREFIXES)) for r in rows]
    return fit_cnn(ids, np.array([r.label for r in rows], np.float32), [r.lang for r in rows], prior_shift(counts, per_class))


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int | None = None, row: str | None = None) -> DataFrame:
    """Per document: row, doc_id, held_out, score (likelihood of label 1) and flagged (score at or above the
    threshold of the document's language).  ``row`` names a column of stored row numbers."""
    trained = train_toxicity(docs, labels, per_class)
    model = docs.sparkSession.sparkContext.broadcast(trained)  # a table of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.value.score(*word_ids(data, offs)) for _, _, data, offs in text_blocks(batch.column("text"), SCORE_BYTES)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in ("row", "doc_id", "lang")] + [pa.array(np.concatenate([np.zeros(0), *scores]))], ["row", "doc_id", "lang", "score"])

    src = documents_of(docs, _language(docs), row_id(row)).select("row", "doc_id", "lang", "text")
    limit = F.lit(trained.threshold)
    for lang, value in trained.thresholds.items():  # one entry per calibrated language
        limit = F.when(F.col("lang") == lang, value).otherwise(limit)
    out = src.mapInArrow(run, "row long, doc_id long, lang string, score double")
    return out.select("row", "doc_id", crc_split(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= limit).alias("flagged"))


def _language(docs: DataFrame):
    return (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang")
