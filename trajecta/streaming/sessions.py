"""Sessions of a message stream: runs, frame buffers, replayed action chunks; as windows over a table and as a stream.

A run starts when a channel's session id changes to another that isn't null, or at a reset message; A, B, A are three runs. The
buffer of a message holds the last frames of its run: one at the run's first message, later BUFFER, with the run's first frame
repeated in front where there are fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUFFER = 4
RESET = "reset"


def session_runs(messages: DataFrame, channel: str, order: list[str], session: str, endpoint: str | None = None) -> DataFrame:
    """Adds run (from 1) and turn (from 0 within the run). A null session id goes on with the run."""
    w = Window.partitionBy(channel).orderBy(*order)
    known = F.last(session, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    changed = F.col(session).isNotNull() & ~F.col(session).eqNullSafe(known)
    if endpoint:
        changed = changed | (F.col(endpoint) == RESET)
    first = F.row_number().over(w) == 1
    x = messages.withColumn("_new", (first | changed).cast("long")).withColumn("run", F.sum("_new").over(w)).drop("_new")
    return x.withColumn("turn", (F.row_number().over(Window.partitionBy(channel, "run").orderBy(*order)) - 1).cast("long"))


def frame_buffer(runs: DataFrame, channel: str, order: list[str], frame: str, size: int = BUFFER) -> DataFrame:
    """Adds buffer to messages with runs and turns."""
    w = Window.partitionBy(channel, "run").orderBy(*order)
    held = F.collect_list(frame).over(w.rowsBetween(1 - size, 0))
    front = F.array_repeat(F.first(frame).over(w), F.lit(size) - F.size(held))
    return runs.withColumn("buffer", F.when(F.col("turn") == 0, F.array(F.col(frame))).otherwise(F.concat(front, held)))


def replayed(step: Column, chunk: Column, horizon: int = 8) -> tuple[Column, Column]:
    """Whether a step asks for a new chunk, and the chunk's action for it."""
    k = F.pmod(step, F.lit(horizon))
    return k == 0, F.get(chunk, k.cast("int"))


STATE = "session string, run bigint, turn bigint, frames array<double>"
OUT = "channel string, seq bigint, session_id string, run bigint, turn bigint, buffer array<double>"


def _advanced(m: pd.DataFrame, session: str | None, run: int, turn: int, frames: list[float], size: int) -> tuple[pd.DataFrame, tuple]:
    """Runs, turns and buffers of a channel's messages in order of seq, and the state after them."""
    m = m.sort_values("seq", kind="stable")
    n = len(m)
    sid = m["session_id"].where(m["session_id"].notna(), None).astype(object)
    known = pd.concat([pd.Series([session], dtype=object), sid], ignore_index=True).ffill()
    before = known.to_numpy()[:n]
    new = np.array([s is not None and s != b for s, b in zip(sid, before)], bool) | (m["endpoint"] == RESET).to_numpy(dtype=bool)
    if run == 0:
        new[0] = True
    values = np.concatenate([np.array(frames, "f8"), m["frame"].to_numpy(dtype="f8")])
    at = len(frames) + np.arange(n)
    start = np.maximum.accumulate(np.where(new, at, 0))  # 0: the run began before this batch, its first frames are in the state
    runs = run + np.cumsum(new)
    opened = np.maximum.accumulate(np.where(new, np.arange(n), -1))
    turns = np.where(opened >= 0, np.arange(n) - opened, turn + 1 + np.arange(n))
    held = values[np.maximum(at[:, None] + np.arange(1 - size, 1), start[:, None])]
    buffers = [row[-1:] if t == 0 else row for row, t in zip(held, turns)]
    out = pd.DataFrame({"seq": m["seq"].to_numpy(), "session_id": sid.to_numpy(), "run": runs, "turn": turns, "buffer": buffers})
    last = known.iloc[n]
    return out, (last if isinstance(last, str) else None, int(runs[-1]), int(turns[-1]), values[max(start[-1], len(values) - size) :].tolist())


def stream_sessions(messages: DataFrame, size: int = BUFFER, forget_ms: int | None = None) -> DataFrame:
    """The same on a stream with columns channel, seq, session_id, endpoint, frame: state holds size frames a channel.

    Messages of a channel are dealt with in order of seq within a micro-batch; one that comes with a later micro-batch is taken as it
    comes. The state of a channel that is silent for forget_ms is dropped, and what it sends later starts run 1 anew; this is for streams
    that go on, since a stream with a time-out has no last batch (availableNow would never end), so without forget_ms state is kept.
    """

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        session, run, turn, frames = state.get if state.exists else (None, 0, -1, [])
        out, after = _advanced(pd.concat(list(batches)), session, run, turn, list(frames), size)
        state.update(after)
        if forget_ms:
            state.setTimeoutDuration(forget_ms)
        yield out.assign(channel=key[0])[["channel", "seq", "session_id", "run", "turn", "buffer"]]

    return messages.groupBy("channel").applyInPandasWithState(step, OUT, STATE, "append", "ProcessingTimeTimeout" if forget_ms else "NoTimeout")
