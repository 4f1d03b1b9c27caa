"""Runs of near-identical successive frames, each collapsed into one event.

Every frame is brought to a canonical event, the cell of a grid that its pose lies in, and every event to a symbol: a Unicode code
point, the same wherever the episode comes back to that cell. The symbols of an episode (of each block of frames of a long one) make a
string, and a regular expression with a backreference finds the repetitions: frames of one cell are near-identical, since a cell is
narrower than the tolerance. Poses that creep over a cell's border end a repetition though they stay near-identical; so where two
spans (or single frames) meet, and only there, the two frames are compared and the spans joined. The spans are mapped back to frames
and seconds. Runs that touch the border of two blocks of an episode are joined in a second, small step that streams over the block ends.

Defined cases: each (episode_index, frame_index) counts once, the first ingested; rows without either are left out; a null,
NaN or infinite component differs from everything; a null ts_sec at either end gives a null duration; a single frame is no
run; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajecta.functions.packing import CHUNK, Block, bucket_count, is_null, mix, packed, per_bucket

FIELDS = (("joint_position", 7), ("cartesian_position", 6), ("gripper_position", 1))
TOLERANCE = 0.002
#: Width of a cell: less than the tolerance by more than any rounding.
CELL, HUGE = 0.0019, 1e9
#: Code points of the symbols, those above the planes with surrogates; a unit of more different events is cut.
FIRST_SYMBOL, SYMBOLS = 0x10000, 0x100000
REPETITION = r"(.)\1+"

RUNS = "episode_index bigint, first_frame bigint, last_frame bigint, n_frames bigint, duration double"
PARTS = "kind int, episode_index bigint, chunk bigint, first_frame bigint, last_frame bigint, n_frames bigint, first_ts double, last_ts double, first_row binary, last_row binary"
RUN, WHOLE, HEAD, TAIL = range(4)


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return (np.abs(a - b) <= TOLERANCE).all(axis=-1)


def events(x: np.ndarray) -> np.ndarray:
    """Number of the canonical event of each row: rows of the same cell have the same; a row with a null, non-finite or huge component
    (no cell is narrower than the tolerance out there) has its own."""
    with np.errstate(invalid="ignore"):
        fine = (np.abs(x) < HUGE).all(axis=1)
    cells = np.floor(np.where(fine[:, None], x, 0) / CELL).astype("i8")
    h = np.zeros(len(x), "u8")
    for c in cells.T:
        h = mix(h, c)
    _, first, out = np.unique(h, return_index=True, return_inverse=True)
    out = out.reshape(-1).astype("i8")
    if not (cells == cells[first[out]]).all():  # two cells of one hash
        out = np.unique(cells, axis=0, return_inverse=True)[1].reshape(-1).astype("i8")
    out[~fine] = len(x) + np.arange(len(x))[~fine]
    return out


def symbols(numbers: np.ndarray) -> str:
    """The string of an entity's events, one code point for each different one."""
    codes = np.unique(numbers, return_inverse=True)[1].reshape(-1)
    return (FIRST_SYMBOL + codes).astype("<u4").tobytes().decode("utf-32-le")


def repetitions(numbers: np.ndarray) -> list[tuple[int, int]]:
    """Spans of two or more equal successive events, as the regular expression finds them."""
    return [(lo + a, lo + b) for lo in range(0, len(numbers), SYMBOLS) for a, b in (m.span() for m in re.finditer(REPETITION, symbols(numbers[lo : lo + SYMBOLS]), re.DOTALL))]


def spans(x: np.ndarray, numbers: np.ndarray) -> list[tuple[int, int]]:
    """Longest runs of near-identical successive rows: the repetitions, joined where the rows at which two meet are near-identical."""
    cuts = np.ones(len(x) + 1, bool)  # where a repetition or a single row begins
    for a, b in repetitions(numbers):
        cuts[a + 1 : b] = False
    meet = np.flatnonzero(cuts[1:-1]) + 1
    cuts[meet[_near(x[meet], x[meet - 1])]] = False
    at = np.flatnonzero(cuts)
    long = np.diff(at) > 1
    return list(zip(at[:-1][long].tolist(), at[1:][long].tolist()))


def _find(chunk: int, several: bool):
    width = sum(w for _, w in FIELDS)

    def run(b: Block) -> Iterator:
        import pyarrow as pa

        x, ts = b.m[:, :width], np.where(is_null(b.m[:, width]), np.nan, b.m[:, width])
        part = np.floor_divide(b.fr, chunk)
        n = len(b.ep)
        new = np.ones(n, bool)
        new[1:] = (b.ep[1:] != b.ep[:-1]) | (part[1:] != part[:-1])
        numbers = events(x)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        rows: list[tuple] = []

        def add(kind: int, i: int, j: int, lo: int, hi: int) -> None:
            """Run of rows i to j - 1 of the unit lo to hi - 1."""
            ends_of = kind != RUN
            rows.append((kind, int(b.ep[lo]), int(part[lo]), int(b.fr[i]), int(b.fr[j - 1]), j - i, ts[i], ts[j - 1], x[lo].tobytes() if ends_of and i == lo else None, x[hi - 1].tobytes() if ends_of and j == hi else None))

        for lo, hi in zip(starts, ends):
            runs = [(lo + i, lo + j) for i, j in spans(x[lo:hi], numbers[lo:hi])]
            if not several:
                for i, j in runs:
                    add(RUN, i, j, lo, hi)
                continue
            head = runs[0] if runs and runs[0][0] == lo else (lo, lo + 1)
            tail = runs[-1] if runs and runs[-1][1] == hi else (hi - 1, hi)
            for i, j in runs:
                if i > lo and j < hi:
                    add(RUN, i, j, lo, hi)
            if head[1] == hi:
                add(WHOLE, lo, hi, lo, hi)
            else:
                add(HEAD, *head, lo, hi)
                add(TAIL, *tail, lo, hi)
        if rows:
            cols = list(zip(*rows))
            types = [pa.int32(), *[pa.int64()] * 5, pa.float64(), pa.float64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[z.split()[0] for z in PARTS.split(", ")])

    return run


def _join_parts(batches: Iterator) -> Iterator:
    """Over block ends in (episode, block, place) order: the open run grows while the next block goes on with it."""
    import pyarrow as pa

    names = [z.split()[0] for z in RUNS.split(", ")]
    open_run, last_row = None, None

    def duration(r) -> float:
        return r[5] - r[4]

    def close(out: list) -> None:
        if open_run and open_run[3] > 1:
            out.append((*open_run[:4], duration(open_run)))

    def batch_of(out: list):
        cols = list(zip(*out)) if out else [[]] * 5
        d = np.array(cols[4], dtype="f8")
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(d, mask=np.isnan(d))], names=names)

    for batch in batches:
        out: list = []
        for r in batch.to_pylist():
            first = np.frombuffer(r["first_row"]) if r["first_row"] else None
            goes_on = open_run and open_run[0] == r["episode_index"] and first is not None and last_row is not None and bool(_near(first, last_row))
            if goes_on:
                open_run = (open_run[0], open_run[1], r["last_frame"], open_run[3] + r["n_frames"], open_run[4], r["last_ts"])
            else:
                close(out)
                open_run = (r["episode_index"], r["first_frame"], r["last_frame"], r["n_frames"], r["first_ts"], r["last_ts"])
            last_row = np.frombuffer(r["last_row"]) if r["last_row"] else None
        yield batch_of(out)
    out = []
    close(out)
    yield batch_of(out)


def near_identical_runs(frames: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per longest run of two or more successive near-identical frames, with frame count and duration."""
    size = frames.agg(F.count("*"), F.max("frame_index"), F.min("frame_index")).head()
    buckets = bucket_count(frames, size[0])
    several = bool(size[0]) and ((size[1] or 0) >= chunk or (size[2] or 0) < 0)
    order = F.unix_micros(F.col("ingested_at").cast("timestamp"))
    blocks = packed(frames, [*FIELDS, ("ts_sec", 1)], [], [], order, buckets, chunk)
    parts = per_bucket(blocks, buckets, _find(chunk, several), PARTS)
    seconds = F.col("last_ts") - F.col("first_ts")
    runs = parts.where(F.col("kind") == RUN) if several else parts
    runs = runs.select("episode_index", "first_frame", "last_frame", "n_frames", F.when(~F.isnan(seconds), seconds).alias("duration"))
    if several:
        ends = parts.where(F.col("kind") != RUN).repartition("episode_index").sortWithinPartitions("episode_index", "chunk", "first_frame")
        runs = runs.unionByName(ends.mapInArrow(_join_parts, RUNS))
    return runs
