"""Operator 12 against the library's ids, the limits and a plain dot-product rule."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagelake.llm import tokens, vector_packing
from pagelake.llm.vector_packing import Limits

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def plain_dot_product(length, loss, limits):
    """The rule item by item: largest dot product first, ties by length, loss and place."""
    mean = [np.mean(length) / limits.tokens, 1 / limits.segments, np.mean(loss) / limits.loss]
    left, out, sequence = sorted(range(len(length)), key=lambda i: (length[i], loss[i], i)), [], 0
    while left:
        room, offset = list(limits), 0
        while True:
            fits = [i for i in left if length[i] <= room[0] and room[1] >= 1 and loss[i] <= room[2] and room[0] > 0]
            if not fits:
                break
            score = lambda i: mean[0] * length[i] / limits.tokens * (room[0] / limits.tokens) + mean[2] * loss[i] / limits.loss * (room[2] / limits.loss)
            best = max(fits, key=lambda i: (round(score(i), 12), -length[i], -loss[i], -i))
            left.remove(best)
            out.append((best, 0, length[best], sequence, offset))
            room, offset = [room[0] - length[best], room[1] - 1, room[2] - loss[best]], offset + length[best]
        sequence += 1
    return out


@pytest.mark.parametrize("seed", range(5))
def test_dot_product_equals_plain_rule(seed):
    rng = np.random.default_rng(seed)
    length = rng.integers(1, 60, 120)
    loss = rng.integers(0, length + 1)
    limits = Limits(100, 4, 50)
    keep = loss <= 50
    length, loss = length[keep], loss[keep]
    got = vector_packing.dot_product(length, loss, limits)
    assert [tuple(r) for r in got.tolist()] == plain_dot_product(length.tolist(), loss.tolist(), limits)


def check(rows, docs, limits):
    want = sorted(((i, LIB.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in docs), key=repr)
    by_row, by_seq = {}, {}
    for r in rows:
        by_row.setdefault(r.row, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    ids = {}
    for row, parts in by_row.items():
        parts.sort(key=lambda r: r.start)
        assert [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert sum(r.length for r in parts) == parts[0].doc_tokens
        same = [w for w in want if w[0] == parts[0].doc_id and len(w[1]) == parts[0].doc_tokens and all(crc(w[1][p.start : p.start + p.length]) == p.ids_crc32 for p in parts)]
        assert same
        ids[row] = same[0]
    assert sorted(ids.values(), key=repr) == want
    for parts in by_seq.values():
        parts.sort(key=lambda r: r.offset)
        total = sum(r.length for r in parts)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert total <= limits.tokens and len(parts) <= limits.segments
        assert total == limits.tokens or total & (total - 1) == 0  # no padding at all


def test_pack_documents(spark, docs, empty):
    plain = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for limits in (Limits(), Limits(64, 3, 64)):
        check(vector_packing.pack_documents(docs, PATH, 2, limits, group_size=5).collect(), plain, limits)
    assert vector_packing.pack_documents(empty, PATH).count() == 0


def test_pack_examples(spark):
    rows = [(1, 5, 2), (2, None, 1), (3, 200, 1), (4, 3, 3), (4, 3, 3), (None, 6, 0), (7, 0, 0)]
    df = spark.createDataFrame(rows, "row long, n_tokens long, n_loss long")
    got = vector_packing.pack_examples(df, limits=Limits(10, 2, 6)).collect()
    assert sorted(((r.example.row, r.example.n_tokens) for r in got), key=repr) == sorted(((a, b) for a, b, _ in rows), key=repr)
    assert {r.example.row for r in got if r.sequence_id is None} == {2, 3, 7}
    turns = spark.createDataFrame([(1, "user", "a b"), (1, "assistant", "c d e"), (2, None, None)], "conv_id long, role string, text string")
    assert sorted((r.conv_id, r.n_tokens, r.n_loss) for r in vector_packing.conversation_examples(turns, PATH).collect()) == [(1, 5, 3), (2, 0, 0)]


def thue_morse(n, flip=0):
    return "".join("ab"[(bin(i).count("1") + flip) & 1] for i in range(n))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("size", [1024, 2048])
def test_equal_polynomial_keys(name, size):
    """Two words whose polynomial hashes agree modulo 2^64 keep their own ids, in one block and across blocks."""
    import pyarrow as pa

    from pagelake.llm import common

    path = public_tokenizers.path(name)
    lib, enc = Tokenizer.from_file(path), tokens.TextEncoder(path)
    one, two = thue_morse(size), thue_morse(size, 1)
    for texts in ([one, two], [two], [one], [f"x {one} {two}"]):
        flat, at = enc.encode(*common.arrow_text(pa.array(texts)))
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_short_pieces_on_one_slot(monkeypatch):
    """Short pieces forced onto one hash are told apart by their bytes."""
    import pyarrow as pa

    from pagelake.llm import common

    monkeypatch.setattr(tokens, "mix64", lambda x: np.zeros_like(x))
    enc = tokens.TextEncoder(PATH)
    for texts in (["alpha beta gamma alpha"], ["beta", "alpha", "delta beta"], ["gamma delta"]):
        flat, at = enc.encode(*common.arrow_text(pa.array(texts)))
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [LIB.encode(t, add_special_tokens=False).ids for t in texts]
