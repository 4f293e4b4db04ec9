"""ST1: rate admission — per key, admit a request unless ``max_calls`` *admitted*
requests lie within the last ``window`` (a request whose age is >= window has
left it); blocked requests do not count.  ``retry_after`` = max(1, ceil(seconds
until the oldest admitted request leaves)).

The rule refers to its own earlier decisions, so a range-frame count is wrong.
Batch form: one shuffle by key, a sort inside each partition, then a single
ordered pass per partition (``mapInPandas``) whose state per key is at most
``max_calls`` timestamps — memory stays bounded however many rows a hot key has;
nothing is collected per group.  Requests with a null key count as one key.
"""

from __future__ import annotations

import math
from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _admit(batches, key: str, ts: str, max_calls: int, window_ms: int):
    cur_key: object = object()
    admitted: deque = deque()
    for pdf in batches:
        keys = pdf[key].tolist()
        times = pdf[ts].tolist()
        ok, retry = [], []
        for k, t in zip(keys, times):
            k = None if pd.isna(k) else k  # null requests share one budget
            if k != cur_key:
                cur_key, admitted = k, deque()
            while admitted and t - admitted[0] >= window_ms:
                admitted.popleft()
            if len(admitted) >= max_calls:
                ok.append(False)
                retry.append(max(1, math.ceil((window_ms - (t - admitted[0])) / 1000)))
            else:
                admitted.append(t)
                ok.append(True)
                retry.append(None)
        out = pdf.copy()
        out["admitted"] = ok
        out["retry_after_s"] = pd.array(retry, dtype="Int64")
        yield out


def rate_admission(df: DataFrame, *, key: str, ts_ms: str, order: str, max_calls: int = 15,
                   window_ms: int = 30_000) -> DataFrame:
    """Add ``admitted`` and ``retry_after_s`` to every request row.

    ``ts_ms`` is an integral millisecond timestamp; ``order`` breaks ties between
    equal timestamps (arrival order)."""
    schema = T.StructType(df.schema.fields + [
        T.StructField("admitted", T.BooleanType()), T.StructField("retry_after_s", T.LongType())])
    sorted_df = df.repartition(key).sortWithinPartitions(key, ts_ms, order)
    return sorted_df.mapInPandas(lambda it: _admit(it, key, ts_ms, max_calls, window_ms), schema)


def rate_admission_reference(rows: list[tuple], max_calls: int, window_ms: int) -> list[tuple[bool, int | None]]:
    """Brute-force statement of the rule for tests: ``rows`` = [(key, ts_ms)] in order."""
    out = []
    for i, (k, t) in enumerate(rows):
        prior = [(rows[j][1], out[j][0]) for j in range(i) if rows[j][0] == k]
        live = [pt for pt, ok in prior if ok and t - pt < window_ms]
        if len(live) >= max_calls:
            out.append((False, max(1, math.ceil((window_ms - (t - min(live))) / 1000))))
        else:
            out.append((True, None))
    return out


def with_epoch_ms(df: DataFrame, ts: str, out: str = "ts_ms") -> DataFrame:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ column (UTC wall time)."""
    return df.withColumn(out, F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts)))
