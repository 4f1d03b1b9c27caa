"""Filters of episodes and frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajecta.operators.joins import cells_of


def successful(steps: DataFrame, episode: str, reward: str) -> DataFrame:
    """Steps of the episodes with any reward other than 0."""
    good = steps.groupBy(episode).agg(F.bool_or(F.coalesce(F.col(reward) != 0, F.lit(False))).alias("_g")).where("_g").select(episode)
    return steps.join(good, episode, "left_semi")


def with_language(episodes: DataFrame, episode: str, slots: list[str], mode: str = "documented") -> DataFrame:
    """Episodes with an instruction longer than one character; in strict mode only those that bring a text no earlier episode has."""
    if mode == "documented":
        return episodes.where(F.exists(F.array(*slots), lambda x: F.coalesce(F.length(x) > 1, F.lit(False))))
    texts = episodes.select(episode, F.posexplode(F.array(*slots)).alias("_slot", "_text")).where(F.length("_text") > 1)
    first = texts.groupBy("_text").agg(F.min(episode).alias(episode)).select(episode).distinct()
    return episodes.join(first, episode, "left_semi")


def within_ranges(steps: DataFrame, ranges: DataFrame, episode: str, frame: str, grid: int = 64) -> DataFrame:
    """Rows inside any range [start, end) of their episode, numbered anew in the order of (ordinal, frame); overlaps repeat rows.

    ranges: episode, ordinal, start, end, cut into cells of grid frames, so that a frame meets only the ranges of its cell.
    """
    x = steps.withColumn("_cell", F.floor(F.col(frame) / grid)).join(cells_of(ranges, steps, episode, frame, grid), [episode, "_cell"])
    x = x.where((F.col(frame) >= F.col("start")) & (F.col(frame) < F.col("end"))).drop("_cell")
    return x.withColumn("new_frame", (F.row_number().over(Window.partitionBy(episode).orderBy("ordinal", frame)) - 1).cast("long"))


def without_idle(episodes: DataFrame, ranges_column: str) -> DataFrame:
    """Episodes with at least one range; one without a list at all is an error."""
    n = F.when(F.col(ranges_column).isNull(), F.raise_error(F.lit("episode without range list"))).otherwise(F.size(ranges_column))
    return episodes.where(n > 0)


def discarded(steps: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose keys aren't listed."""
    return steps.join(listed.select(*on).distinct(), on, "left_anti")


def allowed_starts(steps: DataFrame, episode: str, frame: str, reach: int) -> DataFrame:
    """Frames up to length - reach: the last overruns by one row, which padding covers."""
    return steps.withColumn("_n", F.count("*").over(Window.partitionBy(episode))).where(F.col(frame) <= F.col("_n") - reach).drop("_n")


def long_enough(steps: DataFrame, episode: str, reach: int) -> DataFrame:
    """Steps of episodes of more than reach rows; an error where none is left of any."""
    x = steps.withColumn("_n", F.count("*").over(Window.partitionBy(episode)))
    if not steps.isEmpty() and x.where(F.col("_n") >= reach + 1).isEmpty():
        raise ValueError(f"no episode has more than {reach} rows")
    return x.where(F.col("_n") >= reach + 1).drop("_n")


def with_modality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of the modality's columns is null or an empty array."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull()
        if df.schema[c].dataType.typeName() in ("array", "map"):
            keep = keep & (F.size(c) > 0)
    return df.where(keep)


def valid_results(results: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose results are all finite numbers; null, NaN and infinite ones are invalid."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False))
    return results.where(keep)


def first_by(df: DataFrame, number: Column, n: int) -> DataFrame:
    """The rows numbered below n, for trials on a part."""
    return df.where(number < n)
