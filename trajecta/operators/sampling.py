"""Weights of datasets and trajectories, deterministic draws and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajecta.functions.text import uniform


def dataset_weights(datasets: DataFrame, weight: str, length: str, balance: bool) -> DataFrame:
    """Share of each dataset: its weight, times its length if balance, normalized. primary: raw weight exactly 1."""
    w = F.col(weight) * F.col(length) if balance else F.col(weight)
    return datasets.withColumn("share", w / F.sum(w).over(Window.partitionBy())).withColumn("primary", F.col(weight) == 1.0)


def distributed_weights(datasets: DataFrame, spec: str, weight: str, length: str) -> DataFrame:
    """A spec's weight divided among its datasets by length."""
    return datasets.withColumn("weight_part", F.col(weight) * F.col(length) / F.sum(length).over(Window.partitionBy(spec)))


def trajectory_weights(episodes: DataFrame, dataset: str, steps: str, discarded: Column, balance: bool = True) -> DataFrame:
    """Share of each trajectory in its dataset: its kept steps (or 1), 0 if discarded; an error where all are 0."""
    raw = F.when(discarded, 0.0).otherwise(F.col(steps).cast("double") if balance else F.lit(1.0))
    total = F.sum(raw).over(Window.partitionBy(dataset))
    return episodes.withColumn("share", F.when(total > 0, raw / total).otherwise(F.raise_error(F.lit("dataset without valid trajectories"))))


def epoch_length(datasets: DataFrame, share: str, length: str, training: bool) -> DataFrame:
    n = F.sum(F.col(length) * F.col(share)) if training else F.sum(length)
    return datasets.agg(F.floor(n).cast("long").alias("epoch_length"))


def cumulative(items: DataFrame, order: str, share: str) -> DataFrame:
    """Adds low and high: the stretch of [0, 1) that an item is drawn by. For tables of datasets or shards, not of rows."""
    w = Window.partitionBy().orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return items.withColumn("high", F.sum(share).over(w)).withColumn("low", F.col("high") - F.col(share))


def drawn(n: int, items: DataFrame, seed: int, epoch: int = 0, cells: int = 1024) -> DataFrame:
    """n draws with replacement: (draw, item columns), by inverse distribution of a uniform hash of (epoch, draw, seed).

    Items come from cumulative; the unit interval is cut into cells to join draws and items by equality.
    """
    u = uniform(F.concat_ws(",", F.lit(epoch), F.col("draw"), F.lit(seed)))
    d = items.sparkSession.range(n).withColumnRenamed("id", "draw").withColumn("u", u).withColumn("_cell", F.floor(F.col("u") * cells))
    last = F.least(F.ceil(F.col("high") * cells) - 1, F.lit(cells - 1))
    i = items.where(F.col("high") > F.col("low")).withColumn("_cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.greatest(last, F.floor(F.col("low") * cells)))))
    return d.join(i, "_cell").where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))).drop("_cell", "low", "high", "u")


def hash_order(ident: Column, seed: int, epoch: int = 0) -> Column:
    """Sort key of a seeded permutation that changes with the epoch."""
    return F.sha2(F.concat_ws(",", ident.cast("string"), F.lit(seed + epoch)), 256)


def part_of_each(df: DataFrame, group: str, ident: str, seed: int, rate: float, nominal: int) -> DataFrame:
    """The first int(nominal * rate) rows of each group in hash order."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie in [0, 1]")
    w = Window.partitionBy(group).orderBy(hash_order(F.col(ident), seed))
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= int(nominal * rate)).drop("_r")


def derangement(df: DataFrame, by: list[str], ident: str, seed: int) -> DataFrame:
    """Pairs each row of a group with another: the next in hash order, the first for the last. A group of one has none."""
    w = Window.partitionBy(*by).orderBy(hash_order(F.col(ident), seed))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = df.withColumn("partner", F.coalesce(F.lead(ident).over(w), F.first(ident).over(whole)))
    return x.where(F.col("partner") != F.col(ident))
