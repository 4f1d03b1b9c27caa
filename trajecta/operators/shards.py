"""Balanced shards of whole episodes, schedules and their division among workers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajecta.operators.prefix import running

SPAN = 4096


def balanced_shards(lengths: DataFrame, steps_a_shard: int, episode: str = "episode_index", length: str = "length") -> DataFrame:
    """Shard of each episode: shards are filled in episode order up to equal cutoffs of the total, rising by at most one an episode.

    Closed form of the recurrence: a running sum, then a running minimum, both without sorting the table in one task. An episode
    that spans several cutoffs leaves fewer shards than planned (column planned).
    """
    total = int(lengths.agg(F.sum(length)).head()[0] or 0)
    shards = max(1, -(-total // steps_a_shard))
    bucket = F.floor(F.col(episode) / SPAN)
    x = running(lengths.select(episode, F.col(length).cast("long").alias("length")).withColumn("_one", F.lit(1).cast("long")), bucket, [episode], {"_c": ("length", "sum"), "_j": ("_one", "sum")})
    x = x.withColumn("_j", F.col("_j") - 1)
    x = x.withColumn("_g", F.greatest(F.expr(f"(_c * {shards} + {max(total, 1)} - 1) div {max(total, 1)} - 1"), F.lit(0).cast("long")) - F.col("_j"))
    x = running(x, bucket, [episode], {"_m": ("_g", "min")})
    # the shard of an episode is what its predecessor leaves behind; the running minimum up to the predecessor
    x = x.withColumn("_next", F.least(F.col("_j") + 1, F.col("_j") + F.col("_m")))
    follows = x.select((F.col("_j") + 1).alias("_j"), F.col("_next").alias("_shard"))
    x = x.join(follows, "_j", "left")
    return x.select(episode, "length", F.coalesce("_shard", F.lit(0).cast("long")).alias("shard"), F.lit(shards).cast("long").alias("planned"))


def shard_report(shards: DataFrame) -> DataFrame:
    s = shards.groupBy("shard").agg(F.sum("length").alias("steps"), F.count("*").alias("episodes"))
    return s.agg(F.count("*").alias("shards"), F.max("steps").alias("most_steps"), F.min("steps").alias("least_steps"), F.max("episodes").alias("most_episodes"))


def chunk_check(episodes: DataFrame, episode: str = "episode_index", per_chunk: int = 1000) -> DataFrame:
    """Episodes of each chunk directory, and whether it is full (only the last need not be)."""
    c = episodes.groupBy(F.floor(F.col(episode) / per_chunk).alias("chunk")).agg(F.count("*").alias("episodes"))
    return c.withColumn("as_expected", (F.col("episodes") == per_chunk) | (F.col("chunk") == F.max("chunk").over(Window.partitionBy())))


def worker_share(schedule: DataFrame, position: str, world: int, workers: int, rank: int | None = None, worker: int | None = None) -> DataFrame:
    """The schedule's rows with the rank and worker that they go to, or those of one."""
    slot = F.pmod(F.col(position), F.lit(world * workers))
    x = schedule.withColumn("rank", F.floor(slot / workers)).withColumn("worker", F.pmod(slot, F.lit(workers)))
    return x if rank is None else x.where((F.col("rank") == rank) & (F.col("worker") == worker))
