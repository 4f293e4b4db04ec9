"""Operator 8: licence scan by ordered signature rules behind a keyword prefilter.

A text, its white space folded to single blanks, first meets an automaton of all
rules' keywords; only rules of which a keyword stands there run their pattern, on
the text as it is.  Detections are ordered by
priority, then length, then place; one that lies inside a stronger or equal
detection already kept is suppressed, the others stay.

Besides, phrases of consecutive words (``BASE``) are counted wherever they stand
and give base labels of their own.

Defined cases: null and empty texts have no words, places, detections or labels
and score 0; repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LOWER, WORD_BYTE, documents_of, runs, text_blocks, with_row
from .license_rules import Rule, rules

#: phrase of words -> base label
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


class Scanner:
    """Compiled rules and their keyword automaton; one per worker process."""

    def __init__(self, table: list[Rule]):
        self.table = sorted(table, key=lambda r: -r.priority)
        self.patterns = [re.compile(r.pattern, re.DOTALL) for r in self.table]
        by_key: dict[str, list[int]] = {}
        for i, r in enumerate(self.table):
            for k in r.keywords:
                by_key.setdefault(k, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for k, which in by_key.items():
            self.automaton.add_word(k, which)
        self.automaton.make_automaton()

    def detections(self, text: str) -> list[tuple[Rule, int, int]]:
        """Kept detections (rule, start, end) of a lower-cased text, in place order."""
        possible = {i for _, which in self.automaton.iter(" ".join(text.split())) for i in which}
        found = [(self.table[i], m.start(), m.end()) for i in possible for m in self.patterns[i].finditer(text)]
        found.sort(key=lambda d: (-d[0].priority, d[1] - d[2], d[1], d[0].name))
        return suppressed(found)


def suppressed(found: list[tuple[Rule, int, int]]) -> list[tuple[Rule, int, int]]:
    """Of detections in order of strength, those that lie in no kept one; sorted by place."""
    kept: list[tuple[Rule, int, int]] = []
    starts: list[int] = []  # kept intervals none of which lies in another: both borders ascend
    ends: list[int] = []
    for rule, a, b in found:
        k = bisect.bisect_right(starts, a)
        if k and ends[k - 1] >= b:
            continue
        kept.append((rule, a, b))
        # a kept interval swallows weaker ones only in the cover used for later tests
        lo = bisect.bisect_left(starts, a)
        hi = lo
        while hi < len(starts) and ends[hi] <= b:
            hi += 1
        starts[lo:hi], ends[lo:hi] = [a], [b]
    return sorted(kept, key=lambda d: (d[1], d[2], d[0].name))


_SCANNER: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner(rules()))
    return _SCANNER[0]


def base_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(index of the first word, label) wherever a phrase's words stand consecutively."""
    out = []
    for phrase, label in phrases.items():
        parts = phrase.encode().split(b" ")
        at = -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                out.append((at, label))
    return sorted(out)


_PLACE = pa.struct([("word", pa.int64()), ("label", pa.string())])
_FOUND = pa.struct([("rule", pa.string()), ("label", pa.string()), ("priority", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
SCHEMA = (
    "row long, doc_id long, n_words long, places array<struct<word:long,label:string>>, "
    "detections array<struct<rule:string,label:string,priority:int,start:long,end:long>>, score double"
)


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per document: row, doc_id, n_words, places (base phrases by word), detections (by character) and
    score, 1 - the product of (1 - weight) over the kept detections' distinct rules."""
    phrases = BASE if phrases is None else phrases
    need = [[w.encode() for w in p.split(" ")] for p in phrases]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            for lo, hi, data, offs in text_blocks(batch.column("text")):
                data = LOWER[data]
                starts, ends = runs(WORD_BYTE[data], offs)
                first = np.searchsorted(starts, offs)
                raw, places, found, score = data.tobytes(), [], [], []
                for t in range(hi - lo):
                    text = raw[offs[t] : offs[t + 1]]
                    if any(all(w in text for w in p) for p in need):
                        span = slice(first[t], first[t + 1])
                        words = [raw[a:b] for a, b in zip(starts[span].tolist(), ends[span].tolist())]
                        places.append([{"word": w, "label": x} for w, x in base_places(words, phrases)])
                    else:
                        places.append([])
                    kept = scan.detections(text.decode("utf-8"))
                    found.append([{"rule": r.name, "label": r.label, "priority": r.priority, "start": a, "end": b} for r, a, b in kept])
                    score.append(1.0 - float(np.prod([1 - w for w in {r.name: r.weight for r, _, _ in kept}.values()])))
                yield pa.RecordBatch.from_pydict({
                    "row": batch.column("row").slice(lo, hi - lo),
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "n_words": pa.array(np.diff(first).astype(np.int64)),
                    "places": pa.array(places, pa.list_(_PLACE)),
                    "detections": pa.array(found, pa.list_(_FOUND)),
                    "score": pa.array(score, pa.float64()),
                })

    return with_row(documents_of(docs)).select("row", "doc_id", "text").mapInArrow(run, SCHEMA)
