"""Draws by weight that any engine can repeat: dataset, then trajectory, then step; schedules of shards; shuffles by epoch.

A draw's numbers come from SHA-256 of (epoch, draw, seed, level). Weights are integers, so running sums are exact and the item drawn
doesn't depend on the order of additions. Items are found by cells of the running sum, as many as the group's size asks for, so draws
and items meet by equality and a heavy item is many cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajecta.functions.text import uniform
from trajecta.operators.joins import spread
from trajecta.operators.prefix import running
from trajecta.operators.sampling import hash_order

SPAN = 4096
LEAST_CELLS = 1024


def number(total: Column, draw: Column, seed: int, epoch: int, level: str) -> Column:
    """A number in 0 .. total - 1 of a draw at a level."""
    return F.floor(uniform(F.concat_ws(",", F.lit(epoch), draw, F.lit(seed), F.lit(level))) * total)


def cumulated(items: DataFrame, by: list[str], order: str, weight: str) -> DataFrame:
    """Adds _lo, _hi (the item's stretch of its group's running sum in the order of a number) and the group's _total and _cells.

    Items of weight 0 or less are left out.
    """
    x = items.where(F.col(weight) > 0)
    x = running(x, F.struct(*by, F.floor(F.col(order) / SPAN)), [*by, order], {"_to": (weight, "sum")})
    groups = x.groupBy(*by).agg(F.sum(weight).alias("_total"), F.min(F.col("_to") - F.col(weight)).alias("_base"), F.count("*").alias("_k"))
    groups = groups.withColumn("_cells", F.greatest(F.lit(LEAST_CELLS), F.floor(F.col("_k") / 8)))
    x = spread(x, groups, by, "_k", items.count()) if by else x.crossJoin(F.broadcast(groups.drop("_k")))  # without groups it is one row
    return x.withColumn("_hi", F.col("_to") - F.col("_base")).withColumn("_lo", F.col("_hi") - F.col(weight)).drop("_to", "_base")


def picked(draws: DataFrame, items: DataFrame, by: list[str], seed: int, epoch: int, level: str) -> DataFrame:
    """draws (with column draw) with the item of their group that each takes; a draw of a group without items is lost."""
    sizes = items.select(*by, "_total", "_cells").distinct()
    d = draws.join(sizes, by) if by else draws.crossJoin(F.broadcast(sizes))  # one row
    cell = lambda r: F.floor(r / F.col("_total") * F.col("_cells"))
    d = d.withColumn("_r", number(F.col("_total"), F.col("draw"), seed, epoch, level))
    d = d.withColumn("_cell", cell(F.col("_r"))).drop("_total", "_cells")
    i = items.withColumn("_cell", F.explode(F.sequence(cell(F.col("_lo")), cell(F.col("_hi") - 1)))).drop("_total", "_cells")
    return d.join(i, [*by, "_cell"]).where((F.col("_r") >= F.col("_lo")) & (F.col("_r") < F.col("_hi"))).drop("_r", "_cell", "_lo", "_hi")


def numbered(items: DataFrame, name: str, out: str) -> DataFrame:
    """The few groups (datasets) numbered in the order of their names, to sum over."""
    return items.withColumn(out, F.row_number().over(Window.orderBy(name)).cast("long"))


def step_draws(spark, n: int, datasets: DataFrame, trajectories: DataFrame, starts: DataFrame, seed: int, epoch: int = 0) -> DataFrame:
    """n draws (draw, dataset, episode, frame): a dataset by weight, one of its trajectories by weight, one of that one's allowed starts.

    datasets: dataset, weight; trajectories: dataset, episode, weight; starts: episode, frame, those that neither the step filter
    drops nor lie too near the end. A trajectory without starts is never drawn, which is what drawing again until one is long enough
    comes to; nor is a dataset without such trajectories.
    """
    at = starts.select("episode", "frame", (F.row_number().over(Window.partitionBy("episode").orderBy("frame")) - 1).alias("_i"))
    usable = trajectories.where("weight > 0").join(starts.groupBy("episode").agg(F.count("*").alias("_n")), "episode")
    held = datasets.join(usable.select("dataset").distinct(), "dataset", "left_semi")
    d = spark.range(n).withColumnRenamed("id", "draw")
    d = picked(d, cumulated(numbered(held, "dataset", "_o"), [], "_o", "weight").select("dataset", "_lo", "_hi", "_total", "_cells"), [], seed, epoch, "dataset")
    d = picked(d, cumulated(usable, ["dataset"], "episode", "weight").drop("weight"), ["dataset"], seed, epoch, "trajectory")
    d = d.withColumn("_i", number(F.col("_n"), F.col("draw"), seed, epoch, "step"))
    return d.join(at, ["episode", "_i"]).select("draw", "dataset", "episode", "frame")


def shard_schedule(spark, n: int, shards: DataFrame, order: str, weight: str, seed: int) -> DataFrame:
    """n draws of shards by weight, with replacement, put into a shuffled order: position and the shard's columns."""
    d = picked(spark.range(n).withColumnRenamed("id", "draw"), cumulated(shards, [], order, weight), [], seed, 0, "shard")
    key = F.sha2(F.concat_ws(",", F.col("draw"), F.lit(seed), F.lit("shuffle")), 256)
    d = running(d.withColumn("_key", key).withColumn("_one", F.lit(1).cast("long")), F.substring("_key", 1, 2), ["_key"], {"position": ("_one", "sum")})
    return d.withColumn("position", F.col("position") - 1).drop("_key", "_one")


def shuffled(steps: DataFrame, shard: str, ident: str, seed: int, epoch: int, training: bool = True, order: list[str] | None = None) -> DataFrame:
    """Adds position: a row's place in its shard, in training by a hash that changes with the epoch, else in the given order."""
    by = [hash_order(F.col(ident), seed, epoch)] if training else list(order or [ident])
    return steps.withColumn("position", (F.row_number().over(Window.partitionBy(shard).orderBy(*by)) - 1).cast("long"))


def ascending(df: DataFrame, bucket: Column, order: list[str]) -> DataFrame:
    """Adds place: the row's number in ascending order, without a one-task sort. bucket must not fall along the order."""
    x = running(df.withColumn("_one", F.lit(1).cast("long")), bucket, order, {"place": ("_one", "sum")})
    return x.withColumn("place", F.col("place") - 1).drop("_one")
