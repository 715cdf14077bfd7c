"""Where a copy is checkpointed, response by response.

The rule resets its counters at each checkpoint, so it looks like a walk along the
whole shard. It is not: after a checkpoint nothing earlier matters. So each chunk
of responses is summed up on its own by what would follow from its first possible
checkpoints; the short summaries are walked once per shard; and each chunk, told
how many rows and what time it starts with, then gives its checkpoints.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.cursor import CHECKPOINT_MINUTES, CHECKPOINT_ROWS, PLACE
from rowtide.operators.running import CHUNK, SPAN, span_chunk

SUMMARY_DDL = (
    f"keyspace string, shard string, {CHUNK} bigint, start_at double, total bigint, "
    "head_rows array<bigint>, head_at array<double>, exit_rows array<bigint>, exit_at array<double>"
)
ENTRY_DDL = f"keyspace string, shard string, {CHUNK} bigint, __rows bigint, __since double"
OUT_DDL = "keyspace string, shard string, resp_id bigint, records bigint"


def _candidates(pdf: pd.DataFrame):
    """Rows so far and time at each response that has a last key, where one can fire."""
    pdf = pdf.sort_values("resp_id")
    so_far = pdf["records"].to_numpy(np.int64).cumsum()
    can = pdf["__can"].to_numpy(bool)
    total = int(so_far[-1])
    return pdf["resp_id"].to_numpy()[can], so_far[can], pdf["__at"].to_numpy(float)[can], total, float(
        pdf["__at"].iloc[0]
    )


def _first(so_far, at, rows_in: int, since: float, rows: int, wait: float) -> int:
    """The first candidate to fire, coming in with ``rows_in`` rows since ``since``."""
    by_rows = np.searchsorted(so_far, rows - rows_in, "left")
    by_time = max(np.searchsorted(at, since + wait, "left"), np.searchsorted(so_far, -rows_in, "right"))
    return int(min(by_rows, by_time))


def _after_each(so_far, at, rows: int, wait: float):
    """For each candidate, the next to fire if it fired (their number if none)."""
    by_rows = np.searchsorted(so_far, so_far + rows, "left")
    by_time = np.maximum(np.searchsorted(at, at + wait, "left"), np.searchsorted(so_far, so_far, "right"))
    return np.minimum(by_rows, by_time)


def response_checkpoints(
    timeline: DataFrame,
    span: int = SPAN,
    rows: int = CHECKPOINT_ROWS,
    at: Column | None = None,
    minutes: float = CHECKPOINT_MINUTES,
) -> DataFrame:
    """The responses of ``timeline`` after which a running copy is checkpointed.

    Only while a last key exists and there are rows since the last checkpoint: at
    ``rows`` of them, or ``minutes`` after it. ``at`` is the time of a response in
    seconds and must not fall along a shard; without it only rows count.
    """
    wait = minutes * 60.0 if at is not None else float("inf")
    seen = timeline.select(
        *PLACE,
        "resp_id",
        "records",
        F.col("last_pk").isNotNull().alias("__can"),
        (F.lit(0.0) if at is None else at.cast("double")).alias("__at"),
        span_chunk("resp_id", span).alias(CHUNK),
    )

    def summarize(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, so_far, times, total, start = _candidates(pdf)
        n = len(so_far)
        after = _after_each(so_far, times, rows, wait)
        last = np.arange(n)
        for i in range(n - 1, -1, -1):
            if after[i] < n:
                last[i] = last[after[i]]
        # With this many rows a candidate fires whatever came in, so none later is first.
        heads = slice(0, int(np.searchsorted(so_far, rows, "left")) + 1)
        return pd.DataFrame(
            [[*key, start, total, so_far[heads], times[heads], total - so_far[last[heads]], times[last[heads]]]],
            columns=[*PLACE, CHUNK, "start_at", "total", "head_rows", "head_at", "exit_rows", "exit_at"],
        )

    def walk(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(CHUNK)
        rows_in, since = 0, float(pdf["start_at"].iloc[0])
        entries = []
        for chunk in pdf.itertuples(index=False):
            entries.append((*key, chunk[2], rows_in, since))
            i = _first(chunk.head_rows, chunk.head_at, rows_in, since, rows, wait)
            if i < len(chunk.head_rows):
                rows_in, since = int(chunk.exit_rows[i]), float(chunk.exit_at[i])
            else:
                rows_in += int(chunk.total)
        return pd.DataFrame(entries, columns=[*PLACE, CHUNK, "__rows", "__since"])

    def emit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        resp, so_far, times, _, _ = _candidates(pdf)
        after = _after_each(so_far, times, rows, wait)
        rows_in, since = int(pdf["__rows"].iloc[0]), float(pdf["__since"].iloc[0])
        out, before = [], -rows_in
        i = _first(so_far, times, rows_in, since, rows, wait)
        while i < len(so_far):
            out.append((*key[:2], int(resp[i]), int(so_far[i]) - before))
            before, i = int(so_far[i]), int(after[i])
        return pd.DataFrame(out, columns=[*PLACE, "resp_id", "records"])

    chunks = seen.groupBy(*PLACE, CHUNK)
    entries = (
        chunks.applyInPandas(summarize, SUMMARY_DDL).groupBy(*PLACE).applyInPandas(walk, ENTRY_DDL)
    )
    fired = (
        seen.join(entries, [*PLACE, CHUNK]).groupBy(*PLACE, CHUNK).applyInPandas(emit, OUT_DDL)
    )
    return fired.join(
        timeline.select(*PLACE, "resp_id", "position", "last_pk"), [*PLACE, "resp_id"]
    )
