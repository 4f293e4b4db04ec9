"""Each operator against a brute-force version on the awkward cases, and on an empty table."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagelake.llm import boosted_quality, common, cuckoo_dedup, graph, license_scan, simhash, sumsq_packing, text_cnn, token_cache, token_pack, tokens, warc, winnow

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def ids_of(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def key(rows):
    return sorted(rows, key=repr)


# ------------------------------------------------------------------ 1 token files


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    raw = token_pack.pack_ids(ids, bits)
    assert len(raw) == -(-1001 * bits // 8)
    assert (token_pack.unpack_ids(raw, 1001, bits) == ids).all()


def test_token_files(spark, docs, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    done = token_pack.write_token_files(docs, folder, PATH, 2, tasks=3, block_ids=64)
    got = token_pack.read_token_files(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in plain(docs)), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        start += r.n_tokens
    assert key((r.doc_id, tuple(r.ids)) for r in got) == key((i, (*ids_of(t), 2)) for i, t in plain(docs))
    entry = max(done["files"], key=lambda e: e["ids"])
    f = token_pack.TokenFile(f"{folder}/{entry['name']}")
    assert f.bits == 16 and len(f.offsets) > 2
    whole = f.ids(0, f.total)
    for k in range(len(f.doc_ids)):
        assert (f.document(k) == whole[f.firsts[k] : f.firsts[k + 1]]).all()


def test_token_files_empty(spark, empty, tmp_path):
    token_pack.write_token_files(empty, f"{tmp_path}/none", PATH, 2, tasks=2)
    assert token_pack.read_token_files(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    import random

    import pyarrow as pa

    rng = random.Random(5)
    alphabet = ["a", "B", "ion", " ", "  ", "\n", "\t", ".", ",", "'", "'s", " ", "　", "é", "ß", "×", "é", "7", "42", "日", "🙂", "<|endoftext|>", "\x1f", "-", "İ"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(400)]
    lib, enc = Tokenizer.from_file(public_tokenizers.path(name)), tokens.encoder(public_tokenizers.path(name))
    for _ in range(2):  # the second round meets a filled table
        flat, at = enc.encode(*common.arrow_text(pa.array(texts)))
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


# ------------------------------------------------------------------ 2 WARC


def test_warc(spark, tmp_path):
    big = "<p>" + "x" * 70_000
    pages = [(1, "http://a/1", "<p>one"), (2, None, "<p>one"), (3, "http://a/\n3", ""), (4, "u", None), (5, "http://b/é", big), (6, "v", big), (None, "w", "<p>one"), (None, "w", "lone"), (7, "z", "\r\n\r\ntwo"), (1, "dup", "<p>one")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("rid", F.lit(2)).repartition(3)
    folder = f"{tmp_path}/warc"
    done = warc.write_warc(df, folder, "page_id", "url", "html", roll_bytes=400)
    assert len(done["files"]) > 2
    got = warc.read_warc(spark, folder, verify=True, plan_bytes=500)
    rows = got.select(warc.record_key("record_id").alias("i"), warc.record_key("refers_to").alias("to"), "record_type", "payload_bytes", "payload", "payload_digest").collect()
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    import base64

    sha = lambda h: "sha1:" + base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    want = []
    for i, _, h in pages:
        h = h or ""
        revisit = h in first and i != first[h]
        want.append((i, first[h] if revisit else None, "revisit" if revisit else "response", len(h.encode()), None if revisit else h.encode(), sha(h)))
    assert key((r.i, r.to, r.record_type, r.payload_bytes, None if r.payload is None else bytes(r.payload), r.payload_digest) for r in rows) == key(want)
    assert got.where("record_type = 'revisit'").count() == sum(w[2] == "revisit" for w in want)
    assert got.where("target_uri LIKE 'http://a/%' AND record_type IN ('response')").select("payload_bytes").count() == 2
    assert warc.read_warc(spark, folder, payload=False).where("payload IS NULL").count() == len(pages)


def test_warc_foreign_and_small(spark, tmp_path):
    import gzip

    one = warc.record_bytes(1, "http://x", b"abc", hashlib.sha1(b"abc").hexdigest(), None, False, "2020-01-01T00:00:00Z")
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.warc").write_bytes(info + one * 2)
    (tmp_path / "f" / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(one))
    got = warc.read_warc(spark, str(tmp_path / "f"), verify=True)
    assert sorted((r.record_type, bytes(r.payload)) for r in got.collect()) == [("response", b"abc")] * 3 + [("warcinfo", b"hello")] * 2
    df = spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "i long, u string, h string")
    warc.write_warc(df, f"{tmp_path}/s", "i", "u", "h", min_revisit_bytes=2)
    assert warc.read_warc(spark, f"{tmp_path}/s").where("record_type = 'response'").count() == 2
    warc.write_warc(df.limit(0), f"{tmp_path}/e", "i", "u", "h")
    assert warc.read_warc(spark, f"{tmp_path}/e").count() == 0
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.warc").write_bytes(one[:-30])
    with pytest.raises(Exception, match="truncated"):
        warc.read_warc(spark, str(tmp_path / "t")).collect()


# ------------------------------------------------------------------ 3 decontamination


def brute_hits(docs, items, window=13):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall(low(t))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(i)
    out = []
    for d, t in docs:
        w, hit, found = WORD.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def test_winnow(spark, docs):
    passage = " ".join(f"benchword{i}" for i in range(40))
    items = [(1, passage), (2, "and " + passage[:300]), (2, "short item"), (3, None), (4, "--"), (5, "mat"), (None, "short item"), (6, "benchword3 benchword4 x " + " ".join(f"benchword{i}" for i in range(20, 33)))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("fp", F.lit(0)).withColumn("row", F.lit(0))
    got = winnow.decontaminate(docs, bench).collect()
    assert key((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got) == key(brute_hits(plain(docs), items))
    assert all(sum(s.e - s.s for s in r.spans) == r.n_hit for r in got)


def test_winnow_random(spark):
    import random

    rng = random.Random(3)
    words = [f"w{i}" for i in range(4)]  # few words: many ties of equal fingerprints
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(6)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60))) + " " + items[i % 6][1] + " " + " ".join(rng.choices(words, k=9))) for i in range(40)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = winnow.decontaminate(d, b).collect()
    assert key((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got) == key(brute_hits(docs, items))


def test_winnow_empty(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {(r.n_hit, tuple(r["items"])) for r in winnow.decontaminate(docs, none).collect()} == {(0, ())}
    assert winnow.decontaminate(empty, none).count() == 0


# ------------------------------------------------------------------ 4 SimHash


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint():
    for t in ["", " \t", "one", "one Two", "a b c", "A b\x0bc d", "é x y z", "w " * 50]:
        assert simhash.fingerprint(t.encode()) == brute_fingerprint(t), t


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_link_cell(radius):
    rng = np.random.default_rng(radius)
    seeds = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = np.unique(np.array([s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for s in seeds for k in rng.integers(0, 8, 60)], np.uint64))
    group = np.sort(rng.integers(0, 3, len(fps)))
    moved, root = simhash.link_cell(fps, group, radius, task_step=7)
    got = np.arange(len(fps))
    got[moved] = root
    want = np.arange(len(fps))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            near = (np.bitwise_count(fps ^ fps[i]) <= radius) & (group == group[i])
            least = want[near].min()
            if (want[near] != least).any():
                want[near], changed = least, True
    assert (got == want).all()


def test_near_duplicates(spark, docs, empty):
    for cell in (8192, 2):  # 2: every band is dealt out as pairs of groups
        got = simhash.near_duplicates(docs, cell=cell).collect()
        rows = [(i, brute_fingerprint(t)) for i, t in plain(docs)]
        assert key((r.doc_id, r.fp % (1 << 64)) for r in got) == key(rows)
        for r in got:
            reach, size = {r.fp % (1 << 64)}, 0
            while size != len(reach):
                size = len(reach)
                reach |= {f for _, f in rows if any(bin(f ^ g).count("1") <= 3 for g in reach)}
            members = [i for i, f in rows if f in reach and i is not None]
            assert r.component_id == (min(members) if members else None)
    assert simhash.near_duplicates(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (5, 5)] + [(200, x) for x in range(201, 230)]
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, **{i: 200 for i in range(200, 230)}}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# ------------------------------------------------------------------ 5 and 7 classifiers


def labelled(spark, n=400):
    good = "Calm words stand here in order, one after another number{i}. "
    bad = "### BUY!!! $$$ now now now now {i} "
    rows = [(i, (good if i % 3 else bad).format(i=i) * (1 + i % 7) + ("You grumblekin fool" if i % 5 == 0 else "") + (" grumblekon x" if i % 5 == 0 else ""), "en" if i % 2 else "de") for i in range(n)]
    docs = spark.createDataFrame(rows + [(1000, None, None), (None, "", "en"), (None, "", "en")], "doc_id long, text string, lang string").withColumn("label", F.lit(1)).withColumn("row", F.lit(0)).withColumn("score", F.lit("s"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(n)] + [(None, 1, 1), (3, None, None), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality(spark, empty):
    docs, labels = labelled(spark)
    got = boosted_quality.score_quality(docs, labels).collect()
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.held_out and r.doc_id < 1000]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert all((r.score >= 0.7) == (r.doc_id % 3 > 0) for r in held)
    assert len({r.score for r in got if r.doc_id is None}) == 1
    assert {r.score for r in boosted_quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert boosted_quality.score_quality(empty, labels).count() == 0


def test_training_samples_are_bounded_in_rows(spark, monkeypatch):
    """A labelled doc_id that is repeated often gives one training row, the same in any order of the rows."""
    docs, labels = labelled(spark, 200)
    again = docs.where("doc_id = 6").select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(100))).alias("k"), "lang", "label", "row", "score")
    copies = again.withColumn("text", F.concat(F.lit("copy "), F.repeat(F.lit("word "), F.col("k"))))
    docs = docs.unionByName(copies.select(docs.columns))
    seen = {}

    def trees(x, y, shift=0.0, fit=boosted_quality.fit_trees):
        seen.setdefault("quality", []).append((x, y))
        return fit(x, y, shift=shift)

    def cnn(ids, y, langs, shift=0.0, fit=text_cnn.fit_cnn):
        seen.setdefault("toxic", []).append((ids, y))
        return fit(ids, y, langs, shift, epochs=1)

    monkeypatch.setattr(boosted_quality, "fit_trees", trees)
    monkeypatch.setattr(text_cnn, "fit_cnn", cnn)
    known = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(200))
    assert zlib.crc32(b"6") % 4 != 2
    for frame in (docs, docs.orderBy(F.desc("text"))):
        boosted_quality.score_quality(frame, labels, per_class=1000)
        text_cnn.train_toxicity(frame, labels, per_class=1000)
    (x, y), (x2, y2) = seen["quality"]
    assert len(x) == len(y) == known and (x == x2).all() and (y == y2).all()
    (ids, y), (ids2, y2) = seen["toxic"]
    assert len(ids) == len(y) == known and (y == y2).all() and all((a == b).all() for a, b in zip(ids, ids2))


def test_statistics_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = ["", "a", "A b\nc c", "x" * 999, "\n", "é é", " "]
    together = boosted_quality.statistics(*common.arrow_text(pa.array(texts)))
    alone = np.concatenate([boosted_quality.statistics(*common.arrow_text(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone)


def test_flattened_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosted_quality.fit_trees(x, y, trees=20, depth=3)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95

    def walk(row):
        total = model.base
        for f, t, v in zip(model.feature, model.threshold, model.value):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            total += v[at - len(f)]
        return total

    assert np.allclose([walk(r) for r in x[:50]], model.log_odds(x[:50]))


def test_toxicity(spark, empty):
    docs, labels = labelled(spark)
    got = text_cnn.score_toxicity(docs, labels).collect()
    held = [r for r in got if r.doc_id is not None and r.held_out and r.doc_id < 1000]
    assert len(got) == 403 and np.mean([(r.score >= 0.3) == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert np.mean([r.flagged == (r.doc_id % 5 == 0) for r in held]) > 0.95
    assert {r.score for r in text_cnn.score_toxicity(docs, labels.limit(0)).collect()} == {0.5, 0.0}
    assert text_cnn.score_toxicity(empty, labels).count() == 0


def test_network_scores_do_not_depend_on_neighbours():
    import pyarrow as pa

    model = text_cnn.TextCNN()
    texts = ["", "one", "one two three four", "", "five six", "x y z"]
    together = model.score(*text_cnn.word_ids(*common.arrow_text(pa.array(texts))))
    alone = [model.score(*text_cnn.word_ids(*common.arrow_text(pa.array([t]))))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6)


def test_network_gradient():
    """One step against numeric derivatives of the loss."""
    rng = np.random.default_rng(1)
    ids, counts, y = rng.integers(0, 50, (12, 4)).astype(np.int32), np.array([5, 0, 7]), np.array([1, 0, 1], np.float32)

    def loss(m):
        z = m.log_odds(ids, counts)
        return float(np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))))

    model = text_cnn.TextCNN(3)
    before = loss(model)
    state = {"t": 1, "table": np.zeros(text_cnn.BUCKETS, np.float32)}
    for _ in range(30):
        model._step(ids, counts, y, state, 0.01)
    assert loss(model) < before * 0.7


# ------------------------------------------------------------------ 6 token counts


def test_token_cache(spark, docs, empty, tmp_path, monkeypatch):
    cache = f"{tmp_path}/cache"
    token_cache.count_tokens(empty, PATH, cache).count()
    want = key((i, len((t or "").encode()), len(ids_of(t))) for i, t in plain(docs))
    assert key((r.doc_id, r.n_bytes, r.n_tokens) for r in token_cache.count_tokens(docs, PATH, cache).collect()) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in plain(docs)})
    # a second run encodes only what is new: known digests keep a count planted in the cache
    version = token_cache.tokenizer_digest(PATH)
    planted = spark.createDataFrame([(hashlib.sha256(b"planted").digest(), 77, version)], "digest binary, n_tokens long, version string")
    planted.write.mode("append").partitionBy("version").parquet(cache)
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(50, "planted"), (51, "fresh text")], "doc_id long, text string"))
    again = {r.doc_id: r.n_tokens for r in token_cache.count_tokens(more, PATH, cache).collect()}
    assert again[50] == 77 and again[51] == len(ids_of("fresh text"))
    assert spark.read.parquet(cache).count() == stored.count() + 2
    other = public_tokenizers.path("piece_bpe_32k.model")  # another version shares no counts
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=other)
    got = token_cache.count_tokens(docs, other, cache).collect()
    assert key((r.doc_id, r.n_tokens) for r in got) == key((i, len(sp.encode(t or ""))) for i, t in plain(docs))


# ------------------------------------------------------------------ 8 licences


def test_licence_scan(spark, docs, empty):
    got = license_scan.scan_licenses(docs).collect()
    phrases = {tuple(p.split()): x for p, x in license_scan.BASE.items()}
    want = []
    for i, t in plain(docs):
        w = WORD.findall(low(t))
        want.append((i, len(w), sorted((k, x) for p, x in phrases.items() for k in range(len(w)) if tuple(w[k : k + len(p)]) == p)))
    assert key((r.doc_id, r.n_words, [(p.word, p.label) for p in r.places]) for r in got) == key(want)
    mit = next(r for r in got if r.doc_id == 9 and r.places)
    assert [d.rule for d in mit.detections] == ["mit:statement", "mit:address"] and 0.9 < mit.score < 1
    assert license_scan.scan_licenses(empty).count() == 0


def test_rules_and_suppression():
    scan = license_scan.scanner()
    assert len(scan.table) > 200
    assert len({r.name for r in scan.table}) == len(scan.table)

    def labels(text):
        return [(r.label, r.name.split(":")[1]) for r, _, _ in scan.detections(low(text))]

    assert labels("Licensed under the Apache License, Version 2.0.") == [("apache-2.0", "statement")]
    assert labels("// SPDX-License-Identifier: GPL-2.0-or-later") == [("gpl-2.0", "spdx")]
    assert labels("This work is licensed under the GNU General Public License, version 3.") == [("gpl-3.0", "statement")]
    assert labels("Licensed under CC BY-NC 4.0.") == [("cc-by-nc", "statement")]
    assert labels("The BSD 3-Clause License, or the\nMozilla Public License 2.0") == [("bsd-3-clause", "name"), ("mpl-2.0", "name")]
    assert labels("calm prose about permits and mittens") == []
    for rule in scan.table:  # the prefilter never hides a rule from a text that its pattern matches
        assert rule.keywords and all(k == k.lower() for k in rule.keywords)


def examples(pattern, rng, gap):
    """A random text for a rule's pattern, every run of white space written as ``gap``."""
    from re import _constants as C
    from re import _parser

    def one(items):
        out = []
        for op, arg in items:
            if op is C.LITERAL:
                out.append(chr(arg))
            elif op is C.ANY:
                out.append("z")
            elif op is C.IN:
                kind, value = rng.choice([x for x in arg if x[0] is not C.NEGATE])
                out.append(chr(value) if kind is C.LITERAL else chr(rng.randint(*value)) if kind is C.RANGE else {C.CATEGORY_SPACE: gap, C.CATEGORY_WORD: "w", C.CATEGORY_DIGIT: "4"}[value])
            elif op is C.BRANCH:
                out.append(one(rng.choice(arg[1])))
            elif op is C.SUBPATTERN:
                out.append(one(arg[3]))
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
                low, high, what = arg
                space = what[0] == (C.IN, [(C.CATEGORY, C.CATEGORY_SPACE)])
                out.append(one(what) if space else "".join(one(what) for _ in range(rng.randint(low, min(high, low + 1)))))
            else:
                assert op in (C.AT, C.ASSERT, C.ASSERT_NOT), op
        return "".join(out)

    return one(_parser.parse(pattern))


def test_prefilter_hides_no_rule_from_wrapped_texts():
    import random

    rng = random.Random(8)
    scan = license_scan.scanner()
    for i, rule in enumerate(scan.table):
        hit = 0
        for gap in ("\n", "  ", " \n\t", "\u00a0") * 3:
            text = "x " + examples(rule.pattern, rng, gap) + " "
            if scan.patterns[i].search(text):  # not so where a look-around forbids it
                hit += 1
                found = [(r, m.start(), m.end()) for r, p in zip(scan.table, scan.patterns) for m in p.finditer(text)] if hit == 1 else None
                if found:
                    found.sort(key=lambda d: (-d[0].priority, d[1] - d[2], d[1], d[0].name))
                    assert scan.detections(text) == license_scan.suppressed(found), (rule.name, text)
                assert scan.detections(text), (rule.name, text)
        assert hit, rule.name
    names = lambda t: [r.label for r, _, _ in scan.detections(t)]
    assert names("the gnu general\npublic license") == ["gpl"] and names("all rights  reserved") == ["proprietary"]
    assert names("dual  licensed") == ["dual-license"] and names("bsd \n3-clause") == ["bsd-3-clause"]


def test_suppression_brute_force():
    import random

    rng = random.Random(2)
    rules = [license_scan.Rule(f"r{i}", "x", p, 0.5, ("k",), "k") for i, p in enumerate([90, 70, 50])]
    for _ in range(200):
        found = [(rng.choice(rules), a, a + rng.randrange(1, 9)) for a in [rng.randrange(20) for _ in range(8)]]
        found.sort(key=lambda d: (-d[0].priority, d[1] - d[2], d[1], d[0].name))
        kept = []
        for d in found:
            if not any(a <= d[1] and d[2] <= b for _, a, b in kept):
                kept.append(d)
        assert license_scan.suppressed(found) == sorted(kept, key=lambda d: (d[1], d[2], d[0].name))


# ------------------------------------------------------------------ 9 exact dedup


def test_cuckoo_index():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 63, (20_000, 4), dtype=np.uint64)
    index = cuckoo_dedup.CuckooIndex(4)  # overflows again and again
    for lo in range(0, 20_000, 700):
        assert (index.find(keys[lo : lo + 700]) < 0).all()
        index.add(keys[lo : lo + 700])
    rows = index.find(keys)
    assert (rows == np.arange(20_000)).all()
    near = keys.copy()
    near[:, 2] ^= np.uint64(1)  # same buckets and tags, other digests
    assert (index.find(near) < 0).all()
    index.remove(rows[::2])
    again = index.find(keys)
    assert (again[::2] < 0).all() and (again[1::2] == rows[1::2]).all()
    assert (index.tags > 0).sum() == 10_000
    index.add(keys[::2])
    assert (index.find(keys) >= 0).all()


def test_deduplicate(spark, docs, empty):
    got = cuckoo_dedup.deduplicate(docs, tasks=3).collect()
    groups = collections.defaultdict(list)
    for i, t in plain(docs):
        groups[low(t)].append(i)
    best = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    want = [(i, best[low(t)], len(groups[low(t)]), hashlib.sha256(low(t).encode()).hexdigest()) for i, t in plain(docs)]
    assert key((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got) == key(want)
    kept = collections.Counter(bytes(r.digest) for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert cuckoo_dedup.deduplicate(empty).count() == 0


def test_index_changes(spark):
    def rows(*ids):
        return spark.createDataFrame([(k, k, hashlib.sha256(str(t).encode()).digest()) for k, t in ids], "row long, doc_id long, digest binary")

    index = cuckoo_dedup.update_index(None, cuckoo_dedup.changes(rows((1, "a"), (2, "a"), (3, "b"))), tasks=2)
    index = cuckoo_dedup.update_index(index, cuckoo_dedup.changes(rows((4, "c"), (5, "a"))), cuckoo_dedup.changes(rows((3, "b"), (1, "a")), -1), tasks=2)
    got = {bytes(r.digest): (r.keep_id, r.n) for r in index.collect()}
    assert got == {hashlib.sha256(b"a").digest(): (5, 2), hashlib.sha256(b"c").digest(): (4, 1)}


# ------------------------------------------------------------------ 10 packing


def test_sum_of_squares_is_the_named_rule():
    rng = np.random.default_rng(6)
    for capacity in (7, 20):
        lengths = rng.integers(1, capacity, 300)
        bins, offsets = sumsq_packing.sum_of_squares(lengths, capacity)
        fill = []
        for s, b, o in zip(lengths, bins, offsets):
            gaps = collections.Counter(capacity - f for f in fill if f < capacity)

            def total(change):
                after = gaps.copy()
                after.update(change[0])
                after.subtract(change[1])
                return sum(n * n for g, n in after.items() if g)

            options = {g: total(([g - s], [g])) for g in gaps if g >= s} | {capacity: total(([capacity - s], []))}
            if b == len(fill):
                fill.append(0)
            assert options[capacity - fill[b]] == min(options.values()) and o == fill[b]
            fill[b] += s
            assert fill[b] <= capacity


def test_pack_documents(spark, docs, empty):
    got = sumsq_packing.pack_documents(docs, PATH, 2, capacity=64, group_size=40, with_ids=True).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert r.ids_crc32 == crc(r.ids) and len(r.ids) == r.length
        by_doc[r.row].append(r)
        by_seq[r.sequence_id].append(r)
    texts = []
    for rows in by_doc.values():
        rows.sort(key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows))) and all(r.length == 64 for r in rows[1:])
        assert [r.start for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))]
        texts.append((rows[0].doc_id, tuple(i for r in rows for i in r.ids)))
    assert key(texts) == key((i, (*ids_of(t), 2)) for i, t in plain(docs))
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert sumsq_packing.pack_documents(empty, PATH).count() == 0
