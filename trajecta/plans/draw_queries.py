"""Queries of draws, schedules and shuffles; their SQL repeats the hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajecta.operators import draws, joins
from trajecta.operators.prefix import running
from trajecta.plans.common import ONCE, STEPS, once, query, steps, table

_SEED, _DRAWS, _REACH = 17, 10_000, 24


def _u(draw: str, level: str, epoch: int = 0) -> str:
    return f"CAST(('0x' || substr(sha256('{epoch},' || CAST({draw} AS VARCHAR) || ',{_SEED},{level}'), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496.0"


_STARTS = f"""fr AS (SELECT DISTINCT episode_index AS episode, frame_index AS frame, coalesce(is_terminal, false) AS ends FROM frames),
st AS (SELECT episode, frame, row_number() OVER (PARTITION BY episode ORDER BY frame) - 1 AS i, count(*) OVER (PARTITION BY episode) AS k
       FROM (SELECT *, count(*) OVER (PARTITION BY episode) AS n FROM fr) WHERE frame <= n - {_REACH} AND NOT ends),
tr AS (SELECT dataset_path AS dataset, episode_index AS episode, 1 + coalesce(length, 0) AS weight, k FROM once JOIN (SELECT DISTINCT episode, k FROM st) ON episode = episode_index),
tc AS (SELECT *, sum(weight) OVER (PARTITION BY dataset ORDER BY episode) AS hi, sum(weight) OVER (PARTITION BY dataset) AS total FROM tr),
ds AS (SELECT dataset_path AS dataset, sum(1 + coalesce(length, 0)) * CASE WHEN embodiment_tag = 'arm7_lab' THEN 2 ELSE 1 END AS weight FROM once JOIN datasets USING (dataset_path)
       WHERE dataset_path IN (SELECT dataset FROM tr) GROUP BY dataset_path, embodiment_tag),
dc AS (SELECT *, sum(weight) OVER (ORDER BY dataset) AS hi, sum(weight) OVER () AS total FROM ds)"""


@query(
    "step_draws",
    f"""WITH {ONCE}, {_STARTS},
d AS (SELECT unnest(range({_DRAWS})) AS draw),
a AS (SELECT draw, dataset FROM d JOIN dc ON floor({_u("draw", "dataset")} * total) >= hi - weight AND floor({_u("draw", "dataset")} * total) < hi),
b AS (SELECT draw, a.dataset, episode, k FROM a JOIN tc ON tc.dataset = a.dataset AND floor({_u("draw", "trajectory")} * total) >= hi - weight AND floor({_u("draw", "trajectory")} * total) < hi)
SELECT draw, dataset, b.episode, frame FROM b JOIN st ON st.episode = b.episode AND st.i = floor({_u("draw", "step")} * b.k)""",
)
def step_draws(spark, d):
    """Draws of dataset, trajectory and step, the steps neither final ones nor too near the end."""
    e = once(spark, d).withColumn("weight", 1 + F.coalesce("length", F.lit(0)))
    f = table(spark, d, "frames").select(F.col("episode_index").alias("episode"), F.col("frame_index").alias("frame"), F.coalesce("is_terminal", F.lit(False)).alias("ends")).distinct()
    starts = f.join(f.groupBy("episode").agg(F.count("*").alias("n")), "episode").where(f"frame <= n - {_REACH} AND NOT ends").select("episode", "frame")
    tags = table(spark, d, "datasets").select("dataset_path", "embodiment_tag")
    w = e.join(tags, "dataset_path").groupBy(F.col("dataset_path").alias("dataset"), "embodiment_tag").agg(F.sum("weight").alias("weight"))
    w = w.select("dataset", (F.col("weight") * F.expr("CASE WHEN embodiment_tag = 'arm7_lab' THEN 2 ELSE 1 END")).alias("weight"))
    return draws.step_draws(spark, _DRAWS, w, e.select(F.col("dataset_path").alias("dataset"), F.col("episode_index").alias("episode"), "weight"), starts, _SEED)


_SHARDS = f"{ONCE}, s AS (SELECT CAST(floor(episode_index / 10) AS BIGINT) AS shard, CAST(sum(coalesce(length, 0)) AS BIGINT) AS weight FROM once WHERE episode_index IS NOT NULL GROUP BY 1), c AS (SELECT *, sum(weight) OVER (ORDER BY shard) AS hi, sum(weight) OVER () AS total FROM s)"


@query(
    "shard_schedule_training",
    f"""WITH {_SHARDS}, d AS (SELECT unnest(range({_DRAWS})) AS draw),
p AS (SELECT draw, shard FROM d JOIN c ON floor({_u("draw", "shard")} * total) >= hi - weight AND floor({_u("draw", "shard")} * total) < hi)
SELECT draw, shard, CAST(row_number() OVER (ORDER BY sha256(CAST(draw AS VARCHAR) || ',{_SEED},shuffle')) - 1 AS BIGINT) AS position FROM p""",
)
def shard_schedule_training(spark, d):
    """Shards of ten episodes drawn by their steps, then shuffled."""
    s = once(spark, d).where("episode_index IS NOT NULL").groupBy(F.floor(F.col("episode_index") / 10).alias("shard")).agg(F.sum(F.coalesce("length", F.lit(0))).alias("weight"))
    return draws.shard_schedule(spark, _DRAWS, s, "shard", "weight", _SEED).select("draw", "shard", "position")


@query(
    "epoch_shuffle",
    " UNION ALL ".join(f"SELECT {e} AS epoch, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY sha256(CAST(event_id AS VARCHAR) || ',{_SEED + e}')) - 1 AS BIGINT) AS position FROM events" for e in (0, 1))
    + f" UNION ALL SELECT -1, event_id, frame_index FROM (WITH {STEPS} SELECT event_id, frame_index FROM steps)",
)
def epoch_shuffle(spark, d):
    """Place of every row in its shard in two epochs of training, and (epoch -1) in evaluation."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    parts = [draws.shuffled(e, "user_id", "event_id", _SEED, k, k >= 0, ["ts", "event_id"]).select(F.lit(k).alias("epoch"), "event_id", "position") for k in (0, 1, -1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ascending_sort", "SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS place FROM events")
def ascending_sort(spark, d):
    e = table(spark, d, "events").select("event_id", "ts")
    return draws.ascending(e, F.date_trunc("hour", "ts"), ["ts", "event_id"]).select("event_id", "place")


@query("row_of_dataset", f"WITH {ONCE}, l AS (SELECT dataset_path, CAST(sum(coalesce(length, 0)) AS BIGINT) AS n FROM once WHERE dataset_path IS NOT NULL GROUP BY 1), c AS (SELECT *, sum(n) OVER (ORDER BY dataset_path) - n AS lo FROM l), r AS (SELECT frame_index AS i FROM (WITH {STEPS} SELECT DISTINCT frame_index FROM steps)) SELECT i AS row_number, dataset_path, CAST(i - lo AS BIGINT) AS local_row FROM r JOIN c ON i >= lo AND i < lo + n")
def row_of_dataset(spark, d):
    """The dataset and its row that a global row number stands for."""
    n = once(spark, d).where("dataset_path IS NOT NULL").groupBy("dataset_path").agg(F.sum(F.coalesce("length", F.lit(0))).alias("length"))
    starts = running(draws.numbered(n, "dataset_path", "_o"), F.lit(0), ["_o"], {"_to": ("length", "sum")}).withColumn("start", F.col("_to") - F.col("length"))
    rows = steps(spark, d).select(F.col("frame_index").alias("row_number")).distinct()
    return joins.located(rows, starts.select("dataset_path", "start", "length"), "row_number").select("row_number", "dataset_path", "local_row")
