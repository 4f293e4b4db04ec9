"""Operator 13: repair of conversation structure by a dynamic program over a Re-Pair grammar.

Every row of a conversation is one symbol: its role's initial and whether it must
go (blank, duplicate) or is truncated.  Keep costs 0, Rerole to user or assistant
2, Delete 3, Insert 2, an undeleted truncated row 1 more; the roles that remain
have the initials ``(s?(ua)+)?``.  A task writes the symbol sequences of its
conversations as one Re-Pair grammar whose rules all of them share, and gives
each rule one min-plus transfer matrix over the four states of the role grammar,
bottom-up.

Audits are ropes: an entry of a rule's matrix holds only the state between its two
halves.  Ties go to the ASCII-least audit without building it: edits that lead from
one state to two others never spell the same audit, and no audit that ends in a
row's edit is a prefix of another, so the order of two audits of a rule is that of
their first halves or, where these are the same, of their second halves.  One rank
per entry decides it.  The letters are spelled for the chosen paths only.

Rows are sorted over range partitions of (conversation, turn, ...), so that one
long conversation spreads over many tasks: each gives its part's matrix, and the
few parts are multiplied.  ``repaired_sha256`` is one sequential digest by its
definition: the texts of a conversation pass one task as a stream, never held.

Defined cases: null role, text, or part of the damage key reads as one space; rows
of a null conv_id are one conversation; rows of equal turn are ordered by role,
then by the SHA-256 of the text; a role whose initial is not s, u or a can only be
reroled or deleted; a conversation without rows has zeros, an empty audit and the
digest of the empty string; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BLOCK_ROWS = 1 << 17
FAR = 1 << 40  # cost of an edit sequence that does not exist
_START, _S, _U, _A = range(4)
_STATES = 4
_WHITE = " \t\n\x0b\f\r"
#: letters and cost that close a conversation in each state
_CLOSING = [(0, ""), (4, "II"), (2, "I"), (0, "")]


# ---------------------------------------------------------------- matrices


def _next_state(state: int, initial: int) -> int | None:
    """The state after a role with this initial (0 s, 1 u, 2 a, 3 other), or None where the grammar forbids it."""
    if initial == 0:
        return _S if state == _START else None
    if initial == 1:
        return _U if state != _U else None
    return _A if initial == 2 and state == _U else None


def _row_paths(must_go: bool, initial: int, truncated: bool) -> list[list[tuple[int, str] | None]]:
    """The cheapest (cost, letters), ties ASCII-least, from each state to each over one row and the inserts before it."""
    best: list[list[tuple[int, str] | None]] = [[None] * _STATES for _ in range(_STATES)]
    for first in range(_STATES):
        state, cost, letters = first, 0, ""
        for _ in range(3):  # a third insert only repeats a state
            ways = [(state, 3, "D")]
            if not must_go:
                ways.append((_next_state(state, initial), int(truncated), "K"))
                ways += [(_next_state(state, to), 2 + truncated, "R") for to in (1, 2)]
            for to, more, letter in ways:
                got = (cost + more, letters + letter)
                if to is not None and (best[first][to] is None or got < best[first][to]):
                    best[first][to] = got
            state, cost, letters = (_A if state == _U else _U), cost + 2, letters + "I"
    return best


#: symbol 0: a row that must go; 1 + 2 * initial + truncated: any other row
_PATHS = [_row_paths(True, 3, False), *(_row_paths(False, i, t) for i in range(4) for t in (False, True))]
_N_ROWS = len(_PATHS)
_LETTERS = np.zeros((_N_ROWS, _STATES, _STATES, 3), np.uint8)
_ROW_COST = np.full((_N_ROWS, _STATES, _STATES), FAR, np.int64)
_ROW_RANK = np.zeros((_N_ROWS, _STATES, _STATES), np.int64)
for _s, _table in enumerate(_PATHS):
    for _i, _line in enumerate(_table):
        _order = sorted((p[1], j) for j, p in enumerate(_line) if p)
        _ROW_RANK[_s, _i] = _STATES
        for _r, (_text, _j) in enumerate(_order):
            _ROW_COST[_s, _i, _j], _ROW_RANK[_s, _i, _j] = _line[_j][0], _r
            _LETTERS[_s, _i, _j, : len(_text)] = np.frombuffer(_text.encode(), np.uint8)


def multiply(cost_a, rank_a, cost_b, rank_b):
    """(cost, rank, state between) of many pairs of transfer matrices [n, 4, 4], one after the other."""
    key = (np.minimum(cost_a[:, :, :, None] + cost_b[:, None, :, :], FAR) << 3) | np.minimum(rank_a, 7)[:, :, :, None]
    between = key.argmin(2)
    cost = np.minimum(key.min(2) >> 3, FAR)
    n, i, j = np.ogrid[: len(cost_a), :_STATES, :_STATES]
    order = rank_a[n, i, between] * 8 + rank_b[n, between, j]
    order[cost >= FAR] = 64
    rank = (order[:, :, None, :] < order[:, :, :, None]).sum(3)
    return cost, rank, between


class Grammar:
    """A Re-Pair grammar over symbol sequences, with the transfer matrix of every symbol and rule."""

    def __init__(self):
        self.left, self.right = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.cost, self.rank = _ROW_COST.copy(), _ROW_RANK.copy()
        self.between = np.zeros((_N_ROWS, _STATES, _STATES), np.int64)

    def _add(self, left: np.ndarray, right: np.ndarray) -> int:
        first = _N_ROWS + len(self.left)
        cost, rank, between = multiply(self.cost[left], self.rank[left], self.cost[right], self.rank[right])
        self.left, self.right = np.append(self.left, left), np.append(self.right, right)
        self.cost, self.rank, self.between = np.concatenate([self.cost, cost]), np.concatenate([self.rank, rank]), np.concatenate([self.between, between])
        return first

    def _replace(self, seq: np.ndarray, owner: np.ndarray, at: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``seq`` with the pairs at ``at`` (no two overlap) replaced by one rule per distinct ``code``."""
        _, where, which = np.unique(code, return_index=True, return_inverse=True)
        seq = seq.copy()
        first = self._add(seq[at[where]], seq[at[where] + 1])
        seq[at] = first + which
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        return seq[keep], owner[keep]

    def compress(self, seq: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One symbol per owner that has symbols: (symbols, owners).  ``owner`` is ascending.

        Each round replaces the most frequent pairs whose places cannot overlap; once no pair repeats, what
        is left of every sequence is folded in pairs.
        """
        while len(seq) > 1:
            base = _N_ROWS + len(self.left) + 1
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            if not len(inside):
                break
            code = seq[inside] * base + seq[inside + 1]
            pairs, count = np.unique(code, return_counts=True)
            pairs = pairs[np.lexsort((pairs, -count))][: int((count > 1).sum())]
            if not len(pairs):
                place = np.arange(len(seq)) - np.searchsorted(owner, owner)
                even = place[inside] % 2 == 0
                seq, owner = self._replace(seq, owner, inside[even], code[even])
                continue
            if pairs[0] // base == pairs[0] % base:  # a run of one symbol: every second place of the run
                hit = inside[code == pairs[0]]
                start = np.concatenate([[True], np.diff(hit) > 1])
                run = np.flatnonzero(start)[np.cumsum(start) - 1]
                at = hit[(np.arange(len(hit)) - run) % 2 == 0]
                seq, owner = self._replace(seq, owner, at, np.zeros(len(at), np.int64))
                continue
            lefts, rights, chosen = set(), set(), []
            for p in pairs.tolist():
                a, b = divmod(p, base)
                if a != b and a not in rights and b not in lefts:
                    lefts.add(a)
                    rights.add(b)
                    chosen.append(p)
            taken = np.isin(code, np.array(chosen))
            seq, owner = self._replace(seq, owner, inside[taken], code[taken])
        return seq, owner

    def spell(self, symbol: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[str]:
        """The audits of paths from state ``first`` to ``last`` over ``symbol``, read off the ropes."""
        distinct, back = np.unique(np.stack([symbol, first, last], 1), axis=0, return_inverse=True)
        s, i, j = distinct.T.copy() if len(distinct) else np.zeros((3, 0), np.int64)
        owner = np.arange(len(s))
        while (rule := s >= _N_ROWS).any():
            times = 1 + rule
            lead = np.cumsum(times) - times  # place of each path's first half
            r = np.flatnonzero(rule)
            k = self.between[s[r], i[r], j[r]]
            s, i, j, owner, old = np.repeat(s, times), np.repeat(i, times), np.repeat(j, times), np.repeat(owner, times), s
            half = lead[r]
            s[half], s[half + 1] = self.left[old[r] - _N_ROWS], self.right[old[r] - _N_ROWS]
            j[half], i[half + 1] = k, k
        letters = _LETTERS[s, i, j]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, (letters > 0).sum(1), len(distinct)).astype(np.int64))])
        text = letters[letters > 0].tobytes().decode()
        audits = [text[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return [audits[k] for k in back.reshape(-1).tolist()]


def close(cost: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(total cost, last state) of the cheapest way from the start to a legal end, per matrix."""
    key = ((cost[:, _START, :] + np.array([c for c, _ in _CLOSING])) << 3) | np.minimum(rank[:, _START, :], 7)
    return key.min(1) >> 3, key.argmin(1)


# ---------------------------------------------------------------- Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies`` of every row after the contract's damage; 0 copies: the row is dropped."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(some("text"), ".!?", "")).otherwise(some("text"))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(code == 4, "user").otherwise(some("role")).alias("role"),
        text.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _symbols(rows: DataFrame) -> DataFrame:
    """Per row (dropped ones too, once): its order columns, fault (-1 dropped, 0 none, 1 blank, 2 duplicate,
    3 truncated) and initial, written out, so that ``salt`` tells equal rows apart for good."""
    bare = F.rtrim(F.col("text"), F.lit(_WHITE))
    flat = rows.select(
        "conv_id",
        "turn",
        "role",
        _digest(F.col("text")).alias("digest"),
        (F.col("copies") == 0).alias("dropped"),
        F.when(bare == "", 1).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3).alias("own"),
        F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))).alias("copy"),
    )
    earlier = F.row_number().over(Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    initial = F.substring("role", 1, 1)
    return materialize(
        flat.select(
            "conv_id",
            "turn",
            "role",
            "digest",
            F.when(F.col("dropped"), -1).when(F.col("own") == 1, 1).when(earlier, 2).otherwise(F.col("own")).cast("tinyint").alias("fault"),
            F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).cast("tinyint").alias("initial"),
            F.monotonically_increasing_id().alias("salt"),
        ),
        "symbols",
    )


_PART = (
    "conv_id long, place long, whole boolean, n long, lo long, hi long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "head long, tail long, cost array<long>, rank array<long>, audits array<string>"
)


def _legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return (before < 3) & (after > 0) & (after < 3) & np.where(before == 1, after == 2, after == 1)


def _solve(conv: np.ndarray, known: np.ndarray, turn: np.ndarray, timed: np.ndarray, fault: np.ndarray, initial: np.ndarray, edge_first: bool, edge_last: bool) -> pd.DataFrame:
    """One row per conversation of a sorted block; the conversation at an edge keeps its whole matrix."""
    new = np.concatenate([[True], (conv[1:] != conv[:-1]) | (known[1:] != known[:-1])])
    owner, n = np.cumsum(new) - 1, int(new.sum())
    out = {"conv_id": pd.array(np.where(known[new], conv[new], 0), "Int64")}
    out["conv_id"][~known[new]] = pd.NA
    live = fault >= 0
    o, f, i = owner[live], fault[live], initial[live].astype(np.int64)
    count = lambda mask: np.bincount(o[mask], minlength=n)
    out["n"], out["blank"], out["duplicate"], out["truncated"] = np.bincount(o, minlength=n), count(f == 1), count(f == 2), count(f == 3)
    bad = np.zeros(len(o), bool)
    bad[1:] = (o[1:] == o[:-1]) & ~_legal(i[:-1], i[1:])
    out["illegal"] = count(bad)
    out["head"], out["tail"] = np.full(n, -1), np.full(n, -1)
    out["head"][o[::-1]], out["tail"][o] = i[::-1], i
    t, to = turn[live & timed], owner[live & timed]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (to[1:] != to[:-1])
    out["turns"] = np.bincount(to[fresh], minlength=n)
    lo, hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    lo[to[::-1]], hi[to] = t[::-1], t
    out["lo"], out["hi"] = pd.array(lo, "Int64"), pd.array(hi, "Int64")
    out["lo"][out["turns"] == 0] = pd.NA
    out["hi"][out["turns"] == 0] = pd.NA
    g = Grammar()
    symbol, held = g.compress(np.where((f == 1) | (f == 2), 0, 1 + 2 * i + (f == 3)), o)
    cost, last = close(g.cost[symbol], g.rank[symbol])
    edge = np.zeros(n, bool)
    edge[0], edge[-1] = edge_first, edge_last or (edge_first and n == 1)
    costs, ranks, audits = [[0]] * n, [[0]] * n, [[""]] * n
    for k, c, j, text in zip(held.tolist(), cost.tolist(), last.tolist(), g.spell(symbol, np.full(len(symbol), _START), last)):
        costs[k], audits[k] = [c], [text + _CLOSING[j][1]]
    for k in np.flatnonzero(edge).tolist():
        at = np.flatnonzero(held == k)
        if len(at):
            s = int(symbol[at[0]])
            costs[k], ranks[k] = g.cost[s].reshape(-1).tolist(), g.rank[s].reshape(-1).tolist()
            there = np.flatnonzero(g.cost[s].reshape(-1) < FAR)
            texts = dict(zip(there.tolist(), g.spell(np.full(len(there), s), there // _STATES, there % _STATES)))
            audits[k] = [texts.get(p) for p in range(_STATES * _STATES)]
    out["whole"], out["cost"], out["rank"], out["audits"] = ~edge, costs, ranks, audits
    return pd.DataFrame(out)


def _parts(symbols: DataFrame) -> DataFrame:
    """Per conversation and task: counts and the transfer matrix, or the result where a task holds all of it."""
    names = [f.split()[0] for f in _PART.split(", ")]
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest", F.col("fault") == 2, "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([(n, pa.list_(pa.int64()) if n in ("cost", "rank") else pa.list_(pa.string()) if n == "audits" else pa.bool_() if n == "whole" else pa.int64()) for n in names])
        held: list[list[np.ndarray]] = []
        part, first = TaskContext.get().partitionId(), True

        def solved(cols: list[np.ndarray], last: bool) -> pa.RecordBatch:
            got = _solve(*cols, first, last)
            got["place"] = part
            return pa.RecordBatch.from_pandas(got[names], schema=schema, preserve_index=False)

        size = 0
        for batch in batches:
            get = lambda n: batch.column(n).fill_null(0).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            valid = lambda n: batch.column(n).is_valid().to_numpy(zero_copy_only=False)  # noqa: E731, B023
            held.append([get("conv_id"), valid("conv_id"), get("turn"), valid("turn"), get("fault"), get("initial")])
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                cols = [np.concatenate(c) for c in zip(*held)]
                border = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
                if len(border):
                    cut = int(border[-1]) + 1
                    yield solved([c[:cut] for c in cols], False)
                    first = False
                    cols = [c[cut:] for c in cols]
                held, size = [cols], 0
        cols = [np.concatenate(c) for c in zip(*held)]
        if cols and len(cols[0]):
            yield solved(cols, True)

    return symbols.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "turn", "fault", "initial").mapInArrow(run, _PART)


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _join_parts(pdf: pd.DataFrame) -> pd.DataFrame:
    """The parts of one conversation, at most one per task, multiplied in order."""
    pdf = pdf.sort_values("place")
    live = pdf[pdf["n"] > 0]
    head, tail = live["head"].to_numpy(np.int64), live["tail"].to_numpy(np.int64)
    timed = live[live["turns"] > 0]
    lo, hi = [int(x) for x in timed["lo"]], [int(x) for x in timed["hi"]]
    turns = int(timed["turns"].sum()) - sum(a == b for a, b in zip(hi[:-1], lo[1:]))
    square = lambda name: [np.array(m, np.int64).reshape(1, _STATES, _STATES) for m in live[name]]
    cost, audit = 0, ""
    if len(live):
        costs, ranks, between = square("cost"), square("rank"), []
        c, r = costs[0], ranks[0]
        for c2, r2 in zip(costs[1:], ranks[1:]):
            c, r, k = multiply(c, r, c2, r2)
            between.append(k[0])
        total, last = close(c, r)
        cost, j = int(total[0]), int(last[0])
        texts, audits = [_CLOSING[j][1]], list(live["audits"])
        for p in range(len(live) - 1, -1, -1):
            i = int(between[p - 1][_START, j]) if p else _START
            texts.append(audits[p][i * _STATES + j])
            j = i
        audit = "".join(reversed(texts))
    sums = {k: [int(pdf[k].sum())] for k in ("blank", "duplicate", "truncated")}
    illegal = int(pdf["illegal"].sum()) + int((~_legal(tail[:-1], head[1:])).sum())
    gaps = hi[-1] - lo[0] + 1 - turns if lo else 0
    return pd.DataFrame({"conv_id": pd.array(pdf["conv_id"].iloc[:1], "Int64"), "gaps": [gaps], **sums, "illegal": [illegal], "cost": [cost], "audit": [audit]})


def edit_audits(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    parts = materialize(_parts(_symbols(rows)), "repair-parts")
    counts = ["blank", "duplicate", "truncated", "illegal"]
    whole = parts.where("whole").select("conv_id", F.coalesce(F.expr("hi - lo + 1 - turns"), F.lit(0)).cast("bigint").alias("gaps"), *counts, F.expr("cost[0]").alias("cost"), F.expr("audits[0]").alias("audit"))
    return whole.union(parts.where("NOT whole").groupBy("conv_id").applyInPandas(_join_parts, _RESULT))


class _Repaired:
    """Digest of the repaired ``role:text`` lines of one conversation, fed row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.sha, self.user_next = audit, 0, hashlib.sha256(), True
        self.empty = True

    def _line(self, role: str, text: str) -> None:
        self.sha.update((("" if self.empty else "\n") + role + ":").encode())
        self.sha.update(text.encode())
        self.empty, self.user_next = False, not role.startswith("u")

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._line("user" if self.user_next else "assistant", "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text)
        elif edit == "R":
            self._line("user" if self.user_next else "assistant", text)

    def hexdigest(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, copies; 0 copies: known, but without the row):
    the columns of ``edit_audits`` and repaired_sha256."""
    result = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    head = edit_audits(rows).select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), F.struct(*result).alias("result"))
    lines = rows.where("copies > 0").select("conv_id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("kind"), "turn", "role", _digest(F.col("text")).alias("digest"), "text").withColumn("kind", F.lit(1))
    lines = lines.withColumn("result", F.lit(None).cast(head.schema["result"].dataType))
    order = [F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), *[(n, pa.string() if n == "audit" else pa.int64()) for n in result], ("repaired_sha256", pa.string())])
        now, done = None, []
        for batch in batches:
            kinds, roles, texts = batch.column("kind").to_pylist(), batch.column("role").to_pylist(), batch.column("text")
            for k, kind in enumerate(kinds):
                if kind == 0:
                    if now:
                        done.append((*now[:2], now[2].hexdigest()))
                    got = batch.column("result")[k].as_py()
                    now = (batch.column("conv_id")[k].as_py(), got, _Repaired(got["audit"]))
                else:
                    now[2].row(roles[k], texts[k].as_py())
            if done:
                yield pa.RecordBatch.from_pylist([{"conv_id": c, **r, "repaired_sha256": h} for c, r, h in done], schema=schema)
                done = []
        if now:
            yield pa.RecordBatch.from_pylist([{"conv_id": now[0], **now[1], "repaired_sha256": now[2].hexdigest()}], schema=schema)

    merged = head.union(lines).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text", "result")
    return merged.mapInArrow(run, f"{_RESULT}, repaired_sha256 string")
