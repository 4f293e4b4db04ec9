"""Exact token ids of whole texts with the tokenizers library, encoding each distinct piece once per worker.

A byte-level BPE vocabulary without normaliser never merges across certain
places: before a space that precedes a visible character, and between letters,
digits and ASCII punctuation (the apostrophe apart, which opens contractions).
A vocabulary with word ends that drops white space never merges across ASCII
white space.  Texts are cut there, window by window, equal pieces share one call
of the library, and a direct-mapped table of fixed size keeps recent short
pieces between windows.  A piece is found again by its bytes alone: the table
holds them and compares them, hashes only choose the slot.  For a tokenizer of
another kind every whole text goes to the library as it is.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np

from .common import mix64

_SLOT_BITS = 20
_SLOTS = 1 << _SLOT_BITS
_WIDTH = 10  # ids a slot holds
_KEY_WORDS = 3  # 8-byte words of a piece that a slot holds
_WINDOW = 1 << 20
_TOKENIZERS: dict[str, "TextEncoder"] = {}

#: bytes after a space that prove a visible character: printable ASCII and UTF-8 lead bytes whose
#: characters are never white space (the lead bytes C2, E1, E2 and E3 may open white space)
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:0xE1] = True
_VISIBLE[0xE4:0xF5] = True

#: 1 letter, 2 digit, 3 ASCII punctuation without the apostrophe, 0 anything else (two-byte letters are added per text)
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = 1
_KIND[0x61:0x7B] = 1
_KIND[0x27] = 0

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True

_WORD_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

#: pattern of the vocabulary with word ends (fixed value): none of its alternatives matches white space
_WORD_END_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others take the code points from 256 on, in byte order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_CHARS = _byte_chars()


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _cut_kind(path: str) -> str | None:
    """Where texts may be cut for this tokenizer: ``"byte"`` level rules, at ``"white"`` space, or nowhere."""
    spec = json.load(open(path, encoding="utf-8"))
    pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
    if spec["model"].get("type") != "BPE" or spec["model"].get("dropout"):
        return None
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or _WHITE[list(t["content"].encode())].any() for t in added):
        return None
    norm = spec.get("normalizer")
    if norm is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True):
        return "byte"
    parts, split = (norm or {}).get("normalizers", [norm or {}]), (pre.get("pretokenizers") or [pre])[0]
    plain = all(p.get("type") in ("NFC", "Lowercase") or p.get("type") == "Replace" and p.get("pattern") == {"Regex": r"\s+"} and p.get("content") == " " for p in parts)
    dropped = split.get("type") == "Split" and split.get("pattern") == {"Regex": _WORD_END_PATTERN} and split.get("behavior") == "Removed" and split.get("invert")
    later = all(p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex") for p in (pre.get("pretokenizers") or [pre])[1:])
    return "white" if plain and dropped and later else None


class TextEncoder:
    """Token ids of many texts at once; ids equal those of the library on each whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.sentencepiece = path.endswith(".model")
        self.cuts = None
        if self.sentencepiece:
            import sentencepiece

            self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
            self.vocab = self.lib.get_piece_size()
        else:
            from tokenizers import Tokenizer

            self.lib = Tokenizer.from_file(path)
            self.lib.no_truncation()
            self.lib.no_padding()
            self.vocab = max(self.lib.get_vocab().values()) + 1
            self.cuts = _cut_kind(path)
        if self.cuts:
            self.specials = [t.content.encode() for t in self.lib.get_added_tokens_decoder().values()]
            self.keys = np.zeros((_SLOTS, _KEY_WORDS), np.uint64)
            self.lens = np.zeros(_SLOTS, np.int8)  # bytes of the piece, 0 where the slot is free
            self.counts = np.zeros(_SLOTS, np.int8)
            self.ids = np.zeros((_SLOTS, _WIDTH), np.uint16 if self.vocab <= 1 << 16 else np.uint32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        if self.sentencepiece:
            return self.lib.encode(texts, num_threads=1)
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[bytes], is_word: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of pieces.  A piece that is one pre-token (letters after an optional space, or after
        white space that is dropped) goes straight to the library's merge model, any other through its whole encoder."""
        tokenize, table = self.lib.model.tokenize, _BYTE_CHARS
        bare = (lambda p: p.decode().lower().encode().lstrip()) if self.cuts == "white" else lambda p: p
        got = [[t.id for t in tokenize(bare(p).decode("latin-1").translate(table))] if w else None for p, w in zip(pieces, is_word)]
        rest = [i for i, g in enumerate(got) if g is None]
        for i, ids in zip(rest, self._library([pieces[i].decode("utf-8") for i in rest])):
            got[i] = ids
        counts = np.fromiter((len(g) for g in got), np.int64, len(got))
        return np.fromiter((t for g in got for t in g), np.uint32, int(counts.sum())), counts

    def _cuts(self, data: np.ndarray, special: bool) -> tuple[np.ndarray, np.ndarray]:
        """(places where every pre-token sequence is cut, letter bytes); the last place is never marked."""
        n = len(data)
        cut = np.zeros(n + 1, bool)
        if self.cuts == "white":
            white = _WHITE[data]
            cut[1:n] = white[1:] & ~white[:-1]
        else:
            cut[: n - 1] |= (data[:-1] == 32) & _VISIBLE[data[1:]]
        kind = _KIND[data]
        pair = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        kind[:-1][pair] = 1
        kind[1:][pair] = 1
        if not special:  # special strings may hold any character
            cut[1:n] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        if not special and self.cuts == "byte":
            line = (data[1:-1] == 10) & (kind[:-2] > 0) & _VISIBLE[data[2:]]
            cut[1 : n - 1] |= line
            cut[2:n] |= line
        return cut, kind == 1

    def _windows(self, data: np.ndarray, offsets: np.ndarray, special: bool):
        """(start, piece ends within the window, letter bytes) of consecutive windows of about ``_WINDOW``
        bytes; a window ends where a piece ends, so it grows with a longer piece."""
        n, lo, size = len(data), 0, _WINDOW
        while lo < n:
            hi = min(n, lo + size)
            cut, letter = self._cuts(data[lo:hi], special)
            cut[0] = True
            inside = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, "right")] - lo
            cut[inside] = True
            at = np.flatnonzero(cut)
            if hi == n:
                at = at if at[-1] == hi - lo else np.append(at, hi - lo)
            elif len(at) < 2:
                size *= 2
                continue
            yield lo, at, letter
            lo, size = lo + int(at[-1]), _WINDOW

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(uint32 ids of all texts, int64 offsets per text) of the texts in a byte block."""
        if not self.cuts:
            raw = data.tobytes()
            got = self._library([raw[a:b].decode("utf-8") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            lens = np.fromiter((len(g) for g in got), np.int64, len(got))
            flat = np.fromiter((i for g in got for i in g), np.uint32, int(lens.sum()))
            return flat, np.concatenate([[0], np.cumsum(lens)])
        raw = data.tobytes()
        special = any(m in raw for m in self.specials)
        del raw
        parts, ends, done = [np.zeros(0, np.uint32)], np.zeros(len(offsets), np.int64), 0
        for lo, at, letter in self._windows(data, offsets, special):
            ids, count = self._encode_pieces(data[lo : lo + int(at[-1])], at, letter)
            # ids in front of each text offset of this window
            a, b = np.searchsorted(offsets, lo), np.searchsorted(offsets, lo + int(at[-1]), "right")
            ends[a:b] = done + np.concatenate([[0], np.cumsum(count)])[np.searchsorted(at, offsets[a:b] - lo)]
            parts.append(ids)
            done += len(ids)
        return np.concatenate(parts), ends

    def _encode_pieces(self, data: np.ndarray, at: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per piece) of the pieces between the places ``at``."""
        starts, lens = at[:-1], np.diff(at)
        raw = data.tobytes()
        words = np.ndarray(len(data) + 1, "<u8", raw + bytes(8), strides=(1,))
        short = lens <= 8 * _KEY_WORDS
        key = np.zeros((len(starts), _KEY_WORDS), np.uint64)
        mixed = lens.astype(np.uint64)
        for j in range(_KEY_WORDS):
            held = np.clip(lens - 8 * j, 0, 8)
            key[:, j] = words[np.where(held > 0, starts + 8 * j, 0)] & _WORD_MASK[held]
            mixed = mix64(mixed ^ key[:, j])
        slot = (mixed >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        hit = short & (self.lens[slot] == lens) & (self.keys[slot] == key).all(1)
        miss = np.flatnonzero(short & ~hit)
        _, where, back = np.unique(mixed[miss], return_index=True, return_inverse=True)
        pick = miss[where]
        twin = (key[miss] == key[pick][back]).all(1) & (lens[miss] == lens[pick][back])
        # long pieces, and short ones whose hash hides other bytes, are told apart as bytes objects
        rest = np.concatenate([np.flatnonzero(~short), miss[~twin]])
        known: dict[bytes, int] = {}
        which = np.fromiter((known.setdefault(raw[a : a + m], len(known)) for a, m in zip(starts[rest].tolist(), lens[rest].tolist())), np.int64, len(rest))
        pick = np.concatenate([pick, rest[np.unique(which, return_index=True)[1]]])
        p0, p1 = starts[pick], starts[pick] + lens[pick]
        letters = np.concatenate([[0], np.cumsum(letter[: len(data)], dtype=np.int32)])
        if self.cuts == "byte":
            space = data[p0] == 32 if len(p0) else np.zeros(0, bool)
        else:  # white space stands only in front of a piece
            white = np.concatenate([[0], np.cumsum(_WHITE[data], dtype=np.int32)])
            space = white[p1] - white[p0]
        plain = (p1 > p0 + space) & (letters[p1] - letters[p0] == p1 - p0 - space)
        pool, size = self._pieces([raw[a:b] for a, b in zip(p0.tolist(), p1.tolist())], plain.tolist())
        begin = np.cumsum(size) - size
        count, first = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        count[hit], first[hit] = self.counts[slot[hit]], slot[hit] * _WIDTH
        count[miss[twin]], first[miss[twin]] = size[back[twin]], begin[back[twin]]
        count[rest], first[rest] = size[len(where) + which], begin[len(where) + which]
        index = np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)
        cached = np.repeat(hit, count)
        out = np.empty(len(index), np.uint32)
        out[cached] = self.ids.reshape(-1)[index[cached]]
        out[~cached] = pool[index[~cached]]
        fits = np.flatnonzero(size[: len(where)] <= _WIDTH)
        s, one = np.unique(slot[pick[fits]], return_index=True)  # one piece per slot
        fits = fits[one]
        self.keys[s], self.lens[s], self.counts[s] = key[pick[fits]], lens[pick[fits]], size[fits]
        if len(pool):
            grid = np.arange(_WIDTH)
            take = np.minimum(begin[fits][:, None] + grid, len(pool) - 1)
            self.ids[s] = np.where(grid < size[fits][:, None], pool[take], 0)
        return out, count


def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and tokenizer file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = TextEncoder(path)
    return _TOKENIZERS[path]
