"""Windows over the frames of an episode: gathers, chunks of one label, schedules.

All of them share one partitioning and order (episode, frame), so that Spark sorts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajecta.operators.prefix import running

#: Fixed values of the chunk layout: frames per chunk, step of the frames kept of it.
CHUNK, STRIDE = 24, 3


def indexed(df: DataFrame, episode: str, order: list[str]) -> DataFrame:
    """Adds frame_index from 0 and the episode's length."""
    w = Window.partitionBy(episode)
    return df.withColumn("frame_index", (F.row_number().over(w.orderBy(*order)) - 1).cast("long")).withColumn("length", F.count("*").over(w))


def gathered(steps: DataFrame, value: str, deltas: list[int], padding: str = "first_last", zero: object = 0.0, episode: str = "episode_index", frame: str = "frame_index") -> DataFrame:
    """Adds window: the values at frame + d for each d, in frame order of dense frames; out of range the edge's value or zero."""
    w = Window.partitionBy(episode).orderBy(frame)
    edges = Window.partitionBy(episode).orderBy(frame).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.count("*").over(Window.partitionBy(episode)) - 1
    at = lambda d: F.lead(value, d).over(w) if d >= 0 else F.lag(value, -d).over(w)

    def one(d: int) -> Column:
        inside = (F.col(frame) + d >= 0) & (F.col(frame) + d <= last)
        edge = F.lit(zero) if padding == "zero" else (F.first(value).over(edges) if d < 0 else F.last(value).over(edges))
        return F.when(inside, at(d)).otherwise(edge)

    return steps.withColumn("window", F.array(*[one(d) for d in deltas]))


def needed_frames(starts: DataFrame, deltas: list[int], episode: str = "episode_index", frame: str = "frame_index", length: str = "length") -> DataFrame:
    """Distinct frames that windows at the starts touch, within the episode, and their place among those."""
    x = starts.select(episode, length, F.explode(F.transform(F.array(*[F.lit(d) for d in deltas]), lambda d: F.col(frame) + d)).alias("needed"))
    x = x.where((F.col("needed") >= 0) & (F.col("needed") < F.col(length))).select(episode, "needed").distinct()
    return x.withColumn("place", (F.row_number().over(Window.partitionBy(episode).orderBy("needed")) - 1).cast("long"))


def chunk_anchors(steps: DataFrame, label: str, most: int, episode: str = "episode_index", frame: str = "frame_index", length: str = "length") -> DataFrame:
    """Anchors of each start: starts of 24-frame chunks of the start's label, going out from it in turns, back first.

    Frames with the same remainder by 24 form islands of one label; an anchor needs its whole chunk in the episode, and the
    most anchors nearest the start stay. Columns: episode, first, anchor, number (ascending), anchors.
    """
    lane = Window.partitionBy(episode, "_lane").orderBy(frame)
    x = steps.select(episode, frame, length, F.col(label).alias("_label")).withColumn("_lane", F.col(frame) % CHUNK)
    change = ~F.lag("_label").over(lane).eqNullSafe(F.col("_label")) | (F.row_number().over(lane) == 1)
    x = x.withColumn("_island", F.sum(change.cast("int")).over(lane))
    place = (F.col(frame) / CHUNK).cast("long")
    same = [episode, "_lane", "_island"]
    anchors = x.where(F.col(frame) + CHUNK - 1 < F.col(length)).select(*same, F.col(frame).alias("anchor"))
    # a start takes at most `most` anchors on either side, so it meets those of its own and the neighbouring cells of most places
    anchors = anchors.withColumn("_cell", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor(F.col("anchor") / (CHUNK * most)) + k)))
    starts = x.select(*same, F.col(frame).alias("first"), F.floor(place / most).alias("_cell"))
    k = ((F.col("anchor") - F.col("first")) / CHUNK).cast("long")
    y = starts.join(anchors, [*same, "_cell"]).withColumn("_turn", F.when(k < 0, 2 * F.abs(k) - 1).otherwise(2 * k))
    y = y.withColumn("_rank", F.row_number().over(Window.partitionBy(episode, "first").orderBy("_turn"))).where(F.col("_rank") <= most)
    z = Window.partitionBy(episode, "first")
    return y.select(episode, "first", "anchor", (F.row_number().over(z.orderBy("anchor")) - 1).cast("long").alias("number"), F.count("*").over(z).alias("anchors"))


def video_frames(anchors: DataFrame, steps_length: DataFrame, episode: str = "episode_index", length: str = "length") -> DataFrame:
    """Frames of each start's chunks (every third), and one more 24 after the last anchor; where that isn't in the episode the last
    chunk but its first frame is dropped, and a start with one chunk only has none."""
    x = anchors.join(steps_length.select(episode, length).distinct(), episode)
    ends = F.max("anchor").over(Window.partitionBy(episode, "first"))
    x = x.withColumn("_more", ends + CHUNK < F.col(length)).withColumn("_last", F.col("number") == F.col("anchors") - 1)
    offsets = F.sequence(F.lit(0), F.lit(CHUNK - STRIDE), F.lit(STRIDE))
    kept = F.when(~F.col("_last"), offsets).when(F.col("_more"), F.concat(offsets, F.array(F.lit(CHUNK)))).otherwise(F.array(F.lit(0)))
    x = x.where(F.col("_more") | (F.col("anchors") > 1))
    x = x.select(episode, "first", "anchor", F.explode(kept).alias("_offset"))
    return x.select(episode, "first", (F.col("anchor") + F.col("_offset")).alias("frame_index"))


def action_anchors(anchors: DataFrame, steps_length: DataFrame, episode: str = "episode_index", length: str = "length") -> DataFrame:
    """The anchors of states and 24-row action chunks: those of the video, less the last where the video was cut."""
    x = anchors.join(steps_length.select(episode, length).distinct(), episode)
    ends = F.max("anchor").over(Window.partitionBy(episode, "first"))
    x = x.withColumn("_end", ends)
    return x.where((F.col("_end") + CHUNK < F.col(length)) | (F.col("number") < F.col("anchors") - 1)).select(episode, "first", "anchor", "number")


def relative_to_first(chunks: DataFrame, value: str, state: str, by: list[str], position: str) -> DataFrame:
    """value less the state at the chunk's first row."""
    w = Window.partitionBy(*by).orderBy(position)
    return chunks.withColumn("relative", F.col(value) - F.first(state).over(w))


def relative_keys(actions: list[str], states: list[str], chosen: list[str] | None = None) -> list[str]:
    """Action keys made relative: those chosen (or all) that have a state of their name; the others stay as they are."""
    return [k for k in actions if (chosen is None or k in chosen) and k in states]


def relative_chunks(rows: Column, states: Column, anchors: Column, chunk: int = CHUNK) -> Column:
    """Rows of an action less, in each whole chunk of them, the state at the chunk's anchor (a position in states). A last chunk that
    isn't whole, and one whose anchor lies beyond the states, stay as they are."""
    whole = F.floor(F.size(rows) / chunk) * chunk

    def one(row: Column, i: Column) -> Column:
        at = F.get(anchors, F.floor(i / chunk).cast("int") * chunk)
        state = F.when(i < whole, F.get(states, at.cast("int")))
        return F.when(state.isNull(), row).otherwise(F.zip_with(row, state, lambda a, b: a - b))

    return F.transform(rows, one)


def absolute(relative: Column, state: Column) -> Column:
    """Undoes relative_to_first: each component of each row plus the last observed state."""
    return F.transform(relative, lambda row: F.zip_with(row, state, lambda a, b: a + b))


def trailing_mean(by: list[str], order: str, value: str, rows: int = 10) -> Column:
    """Mean of the last rows values, the row's own included; fewer at the start."""
    return F.avg(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(1 - rows, 0))


def schedule(total: Column, first: int = 23, step: int = 24, offsets: tuple[int, ...] = (-23, -16, -8, 0)) -> Column:
    """Windows at fixed anchors below total, clamped at 0: an array of arrays."""
    anchors = F.when(total > first, F.sequence(F.lit(first).cast("long"), total.cast("long") - 1, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(anchors, lambda a: F.array(*[F.greatest(a + o, F.lit(0).cast("long")) for o in offsets]))


def strided_starts(total: Column, horizon: int, most: int = 5) -> Column:
    """Up to most starts a horizon apart, from 0."""
    n = F.least(F.lit(most).cast("long"), F.ceil(total / horizon))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda k: k * horizon)).otherwise(F.array().cast("array<bigint>"))


def sequential_split(df: DataFrame, order: str, proportions: list[tuple[str, float]], rows: int) -> DataFrame:
    """Name of the split by position in the order; the last takes what is left."""
    if abs(sum(p for _, p in proportions) - 1) > 1e-6:
        raise ValueError("proportions must add up to 1")
    x = running(df.withColumn("_one", F.lit(1).cast("long")), F.floor(F.col(order) / 4096), [order], {"_n": ("_one", "sum")}).drop("_one")
    split, at = F.lit(proportions[-1][0]), 0
    bounds = []
    for name, p in proportions[:-1]:
        at += int(p * rows)
        bounds.append((name, at))
    for name, b in reversed(bounds):
        split = F.when(F.col("_n") <= b, name).otherwise(split)
    return x.withColumn("split", split).drop("_n")


def crossings(df: DataFrame, by: list[str], order: str, value: str, every: float) -> Column:
    """True where value has passed another multiple of every since the row before (0 before the first)."""
    w = Window.partitionBy(*by).orderBy(order)
    return F.floor(F.col(value) / every) != F.floor(F.lag(value, 1, 0.0).over(w) / every)


def synthesized_times(episode: str, time: str, frame: str, fps: float) -> Column:
    """Times, or frame / fps in an episode whose times are all zero."""
    return F.when(F.max(F.abs(F.col(time))).over(Window.partitionBy(episode)) == 0, F.col(frame) / fps).otherwise(F.col(time))


def every(count: Column, n: int, on_first: bool = False) -> Column:
    """True at each n-th call, counted from 0; the first is one only if on_first."""
    if n < 1:
        raise ValueError("n must be positive")
    return F.pmod(count + (0 if on_first else 1), F.lit(n)) == 0


def first_times(by: list[str], order: list[str], n: int = 1) -> Column:
    """True for the first n rows of each name."""
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order)) <= n
