"""Checks of a dataset, as tables of findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def episode_integrity(steps: DataFrame, declared: DataFrame, episode: str = "episode_index", frame: str = "frame_index", length: str = "length") -> DataFrame:
    """Per episode: rows found and declared, whether frames are consecutive from 0, unique, and as many as declared."""
    s = steps.groupBy(episode).agg(F.count("*").alias("found"), F.count_distinct(frame).alias("_d"), F.min(frame).alias("_a"), F.max(frame).alias("_b"))
    d = declared.groupBy(episode).agg(F.max(length).alias("declared"), F.count("*").alias("_rows"))
    x = s.join(d, episode, "full_outer")
    same = lambda c: F.coalesce(c, F.lit(False))
    return x.select(
        episode, F.coalesce("found", F.lit(0)).alias("found"), "declared", same(F.col("_b") - F.col("_a") + 1 == F.col("_d")).alias("consecutive"), same(F.col("_d") == F.col("found")).alias("unique_frames"), same(F.col("_rows") == 1).alias("unique_episode"), same(F.col("found") == F.col("declared")).alias("length_ok")
    )


def with_index(steps: DataFrame, episode: str, frame: str, index: str = "index") -> DataFrame:
    """A missing index column as position in the episode."""
    if index in steps.columns:
        return steps
    return steps.withColumn(index, (F.row_number().over(Window.partitionBy(episode).orderBy(frame)) - 1).cast("long"))


def out_of_sync(steps: DataFrame, episode: str, frame: str, time: str, fps: str, tolerance: float) -> DataFrame:
    """Per episode: steps between successive frames whose time differs from 1 / fps by more than tolerance."""
    w = Window.partitionBy(episode).orderBy(frame)
    gap = F.abs((F.col(time) - F.lag(time).over(w)) - 1.0 / F.col(fps))
    next_one = F.col(frame) == F.lag(frame).over(w) + 1
    return steps.withColumn("_bad", next_one & (gap > tolerance)).groupBy(episode).agg(F.sum(F.coalesce(F.col("_bad").cast("int"), F.lit(0))).alias("out_of_sync"))


def file_counts(files: DataFrame, episodes: int, cameras: int, name: str = "name") -> DataFrame:
    """Files of each kind beside what is expected: a table an episode, a video an episode and camera."""
    kinds = (("parquet", episodes), ("mp4", episodes * cameras))
    return files.agg(*[F.count(F.when(F.col(name).endswith(f".{k}"), 1)).alias(k) for k, _ in kinds]).select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("found"), F.lit(n).cast("long").alias("expected")) for k, n in kinds])).alias("_c")
    ).select("_c.*", (F.col("_c.found") == F.col("_c.expected")).alias("complete"))


def unresolved_keys(configured: DataFrame, modality: DataFrame, on: list[str], exempt: list[str] = ()) -> DataFrame:
    """Configured keys that the modality map lacks."""
    x = configured.where(~F.col("modality").isin(list(exempt))) if exempt else configured
    return x.join(modality.select(*on).distinct(), on, "left_anti")


def same_configuration(df: DataFrame, tag: str, config: list[str]) -> DataFrame:
    """Per tag: distinct configurations, and whether there is just one."""
    return df.groupBy(tag).agg(F.count_distinct(F.to_json(F.struct(*config))).alias("configurations")).withColumn("identical", F.col("configurations") == 1)


def missing_parts(info: dict, roles: dict[str, list[str]], episodes: int) -> list[tuple[str, str, str]]:
    """(rule, severity, message) of what a dataset lacks."""
    rules = [("state", not roles.get("state"), "no state column"), ("action", not roles.get("action"), "no action column"), ("video", not roles.get("video"), "no video"), ("episodes", episodes == 0, "no episodes"), ("fps", not info.get("fps"), "no frame rate")]
    return [(rule, "warning", message) for rule, bad, message in rules if bad]


def schema_difference(df: DataFrame, expected: dict[str, str]) -> list[tuple[str, str | None, str | None]]:
    """(column, type expected, type found) where they differ."""
    got = dict(df.dtypes)
    return [(c, expected.get(c), got.get(c)) for c in sorted({*expected, *got}) if expected.get(c) != got.get(c)]


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether both have the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def is_part_of(a: DataFrame, b: DataFrame) -> bool:
    """Whether b has all rows of a as often."""
    return a.exceptAll(b).isEmpty()
