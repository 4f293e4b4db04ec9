"""Operator 11 against plain counting of every phrase."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import collocation


def low(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def brute(rows, min_count, top):
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    cands = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= min_count}
    gone = set()
    for (lang, p), c in cands.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * c >= 50 * f[lang, p[i : i + k]]:
                    gone.add((lang, p[i : i + k]))
    out = collections.defaultdict(list)
    for (lang, p), a in cands.items():
        if (lang, p) not in gone:
            score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for r, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1)}


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["a", "b", "The", "é", "日本", "x\x00y", "q", "\x1f", "zz"]
    rows = [(rng.choice(["en", "en", "de", None, "und", ""]), "".join(rng.choice(vocab) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " a b The "]) for _ in range(rng.randrange(60)))) for _ in range(120)]
    return rows + [("en", None), (None, None), ("xx", ""), ("xx", ". , !")] + rows[:3] * 3


def compare(df, rows, min_count=10, top=2000):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = collocation.top_phrases(collocation.phrases(df, min_count), top).select(*names).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute(rows, min_count, top)


def test_phrases(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "lang string, text string")
    compare(df.select("*", *[F.lit("x").alias(c) for c in ["a", "n", "phrase", "shard", "id", "f", "rank"]]).repartition(4), rows)
    assert collocation.phrases(df.limit(0)).count() == 0
    assert collocation.phrases(df.where("lang = 'xx'")).count() == 0


def test_small_shards_blocks_and_cap(spark, monkeypatch):
    """Many shards give the same counts; the cap keeps the first phrases."""
    rows = corpus(2) + [("en", "a b The, " * 500 + "é" * 300 + " a b" * 200)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    monkeypatch.setattr(collocation, "SHARD", 4)
    compare(df, rows, 3, 7)


def test_shared_buckets(spark):
    """Candidates that share a bucket are all kept while the bucket's sum reaches the minimum."""
    local = spark.createDataFrame([(1, 5, 6, 4), (1, 7, 8, 6), (1, 6, 1, 1), (2, 1, 1, 9), (3, 2, 2, 5), (3, 2, 2, 5)], "bucket long, a long, b long, n long")
    got = {tuple(r) for r in collocation._bounded(local, ["a", "b"], 10).collect()}
    assert got == {(5, 6), (7, 8), (6, 1), (2, 2)}


def test_long_text_in_blocks(monkeypatch):
    """A text beyond a block is cut behind separators only and loses nothing."""
    import pyarrow as pa

    monkeypatch.setattr(collocation, "BLOCK", 100)
    text = "a b The, " * 500 + "é" * 300 + " a b" * 200
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["en", None]), "text": pa.array([text, None])})
    parts = [data.tobytes() for _, data, offs in collocation._blocks(batch) if len(data)]
    assert len(parts) > 10 and b"".join(parts) == low(text).encode()
    assert all(p[-1:] in b".,;:!?" for p in parts[:-1])


@pytest.mark.parametrize("length", [2, 3])
def test_trie_equals_search(length):
    rng = np.random.default_rng(length)
    rows = np.unique(rng.zipf(1.3, (3000, length)) % 200, axis=0)
    trie = collocation.Trie.build(rows)
    ids = (rng.zipf(1.3, 4000) % 230 - 1).astype(np.int32)
    at, place = trie.walk(ids, length)
    known = {tuple(r): k for k, r in enumerate(rows.tolist())}
    want = [(i, known[t]) for i in range(len(ids) - length + 1) if (t := tuple(ids[i : i + length].tolist())) in known]
    assert list(zip(at.tolist(), place.tolist())) == want


@pytest.mark.parametrize("width", [2, 3])
def test_packed_candidates_equal_counting(spark, monkeypatch, width):
    """Few rows leave a step for many occurrences, and every candidate of a bucket that reaches the minimum comes back with its count."""
    rng = np.random.default_rng(width)
    rows = (rng.zipf(1.4, (20000, width)) % 300).astype(np.int32)
    rows[:500] = [2**31 - 1, 0, 7][:width]  # a very common one
    pieces = [collocation._packed(p, 5) for p in np.array_split(rows, 8)] + [collocation._packed(rows[:0], 5)]
    assert sum(p.num_rows for p in pieces) <= 40
    frame = spark.createDataFrame([r for p in pieces for r in zip(*(c.to_pylist() for c in p.columns))], collocation._PACKED).repartition(3)
    monkeypatch.setattr(collocation, "shuffle_tasks", lambda spark: 2)
    names = ["a", "b", "c"][:width]
    got = collocation._reaching(frame, names, 4).collect()
    count = collections.Counter(map(tuple, rows.tolist()))
    assert {tuple(r[c] for c in names): r.n for r in got} == {k: n for k, n in count.items() if n >= 4}
    assert len(got) == len({r.bucket for r in got})  # these rows share no bucket


def test_walk_by_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    trie = collocation.Trie.build(np.unique(rng.integers(0, 9, (200, 3)), axis=0))
    ids = rng.integers(-1, 9, 1001).astype(np.int32)
    want = [x.tolist() for x in trie.walk(ids, 3)]
    monkeypatch.setattr(collocation, "_PIECE", 100)
    assert [np.concatenate(x).tolist() for x in zip(*trie.walks(ids, 3))] == want


def test_positions_are_dealt_to_one_shard():
    """A position is walked in the one shard that may hold its phrase, however many shards there are, and a trie is no wider than its phrases ask."""
    rng = np.random.default_rng(3)
    ids = rng.integers(-1, 50, 5000).astype(np.int32)
    for length in (2, 3):
        windows = [i for i in range(len(ids) - length + 1) if (ids[i : i + length] >= 0).all()]
        rows = np.unique(np.stack([ids[windows[::7]] if i == 0 else ids[np.array(windows[::7]) + i] for i in range(length)], 1), axis=0)
        shard_of = collocation._shard_of(rows, 9)
        got, dealt = [], []
        for k, at in collocation._dealt(ids, length, 9):
            dealt += at.tolist()
            mine = rows[shard_of == k].astype(np.int64)
            if len(mine):
                found, place = collocation.Trie.build(mine).walk(ids, length, at)
                assert (np.stack([ids[found + i] for i in range(length)], 1) == mine[place]).all()
                got += found.tolist()
        known = set(map(tuple, rows.tolist()))
        assert sorted(dealt) == windows
        assert sorted(got) == [i for i in windows if tuple(ids[i : i + length].tolist()) in known]
    assert len(collocation.Trie.build(np.array([[10**6, 3 * 10**6], [10**6, 5 * 10**6]])).check) < 10
