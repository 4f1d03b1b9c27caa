"""Queries of the general data-quality operators, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajecta.operators import spikes
from trajecta.session import scratch
from trajecta.streaming import compactor


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_P4_PLAIN = "dataset_path, robot_id, episode_index, frame_index, task_index, ts_sec, is_first, is_terminal, recorded_at, ingested_at"
_P4_VECTORS = ("joint_position", "joint_velocity", "cartesian_position")
#: Readings in ten-thousandths, null where not finite, so that both engines write them alike.
P4_SQL = f"""
SELECT {_P4_PLAIN}, {", ".join(f"list_transform({c}, lambda x: CASE WHEN isfinite(x) AND abs(x) < 1e12 THEN CAST(round(x * 10000) AS BIGINT) END) AS {c}" for c in _P4_VECTORS)},
       {", ".join(f"CASE WHEN isfinite({c}) AND abs({c}) < 1e12 THEN CAST(round({c} * 10000) AS BIGINT) END AS {c}" for c in ("gripper_position", "next_reward"))}
FROM frames QUALIFY row_number() OVER (PARTITION BY episode_index, frame_index ORDER BY ingested_at NULLS FIRST) = 1
"""


def p1_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.implausible_readings(*(table(spark, sf_dir, t) for t in ("frames", "datasets", "modality")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.found(p1_flags(spark, sf_dir))


_MOVED = " OR ".join(f"coalesce(NOT isnan(cartesian_position[{k}] - c0[{k}]) AND abs(cartesian_position[{k}] - c0[{k}]) > 0.002, false)" for k in range(1, 7))

_P1_CASES = f"""
WITH f AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY episode_index, frame_index ORDER BY ingested_at) AS rn
                 FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL) WHERE rn = 1),
g AS (SELECT *, lag(cartesian_position) OVER (PARTITION BY episode_index ORDER BY frame_index) AS c0 FROM f),
m AS (SELECT *, ({_MOVED}) AS moved FROM g),
d AS (
  SELECT *, 'joint_position' AS field_name, unnest(range(7)) AS dim FROM m
  UNION ALL SELECT *, 'joint_velocity' AS field_name, unnest(range(7)) AS dim FROM m
  UNION ALL SELECT *, 'gripper_position' AS field_name, unnest(range(1)) AS dim FROM m),
lim AS (SELECT dataset_path, feature_key, max(range_min) AS lo, min(range_max) AS hi FROM datasets JOIN modality USING (embodiment_tag) GROUP BY ALL),
t AS (
  SELECT d.episode_index, frame_index, coalesce(robot_id, '') AS robot_id, field_name, CAST(dim AS bigint) AS dim, moved, lo, hi,
         CASE field_name WHEN 'joint_position' THEN joint_position[dim + 1] WHEN 'joint_velocity' THEN joint_velocity[dim + 1] ELSE gripper_position END AS x
  FROM d LEFT JOIN lim ON lim.dataset_path = d.dataset_path AND feature_key = field_name),
j AS (SELECT *, x IS NOT NULL AND (NOT isfinite(x) OR coalesce(NOT isnan(lo) AND x < lo, false) OR coalesce(NOT isnan(hi) AND x > hi, false)) AS bad FROM t),
v AS (
  SELECT *, {", ".join(f"x - lag(x, {k}) OVER w AS p{k}, x - lead(x, {k}) OVER w AS q{k}" for k in (1, 2, 3))}
  FROM j WHERE x IS NOT NULL AND NOT bad WINDOW w AS (PARTITION BY episode_index, field_name, dim ORDER BY frame_index)),
r AS (SELECT robot_id, field_name, dim, 6 * quantile_cont(abs(p1), 0.95) AS cut, max(abs(p1)) > 0 AS moves FROM v WHERE p1 IS NOT NULL GROUP BY ALL),
s AS (
  SELECT v.*, CASE WHEN field_name = 'gripper_position' THEN CASE WHEN isnan(hi) THEN NULL ELSE 0.1 * hi END ELSE cut END AS c
  FROM v LEFT JOIN r USING (robot_id, field_name, dim)),
spike AS (
  SELECT episode_index, frame_index, field_name, dim FROM s WHERE
  {" OR ".join(f"least(p{i}, q{k}) > c AND p{i} IS NOT NULL AND q{k} IS NOT NULL OR least(-p{i}, -q{k}) > c AND p{i} IS NOT NULL AND q{k} IS NOT NULL" for i in (1, 2, 3) for k in (1, 2, 3) if i + k <= 4)}),
e AS (
  SELECT *, coalesce(moved AND x = lag(x) OVER (PARTITION BY episode_index, field_name, dim ORDER BY frame_index) AND NOT isnan(x), false) AS linked FROM j),
i AS (SELECT *, sum(CASE WHEN linked THEN 0 ELSE 1 END) OVER (PARTITION BY episode_index, field_name, dim ORDER BY frame_index) AS run FROM e),
n AS (SELECT *, count(*) OVER (PARTITION BY episode_index, field_name, dim, run) AS rows_in FROM i),
stuck AS (SELECT n.episode_index, frame_index, field_name, dim FROM n JOIN r USING (robot_id, field_name, dim) WHERE rows_in >= 15 AND moves)"""
P1_SQL = f"""{_P1_CASES}
SELECT episode_index, frame_index, field_name, dim FROM j WHERE bad
UNION SELECT * FROM spike UNION SELECT * FROM stuck
"""
P1_KINDS_SQL = f"""{_P1_CASES},
a AS (SELECT episode_index, frame_index, field_name, dim, 1 AS kind FROM j WHERE bad UNION SELECT *, 2 FROM spike UNION SELECT *, 3 FROM stuck)
SELECT episode_index, frame_index, field_name, dim, bool_or(kind = 1) AS impossible, bool_or(kind = 2) AS spike, bool_or(kind = 3) AS stuck FROM a GROUP BY ALL
"""


def p1_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What kind of case each found reading is."""
    return p1_flags(spark, sf_dir).where("impossible OR spike OR stuck").select("episode_index", "frame_index", "field_name", "dim", "impossible", "spike", "stuck")


def p1_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted tails and the rule's cutoffs by source, field and dim."""
    return spikes.cutoffs(*(table(spark, sf_dir, t) for t in ("frames", "datasets", "modality")))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = scratch(spark, "p4")
    return compactor.compact(spark, f"{sf_dir}/frames.parquet", f"{at}/files", f"{at}/checkpoint", order=("ingested_at",))


def p4_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the compacted files with all its columns, readings in ten-thousandths."""
    units = lambda x: F.when((F.abs(x) < 1e12), F.round(x * 10000).cast("long"))  # noqa: E731  (NaN is above)
    vectors = [F.transform(c, units).alias(c) for c in _P4_VECTORS]
    return _compacted(spark, sf_dir).select(*_P4_PLAIN.split(", "), *vectors, *[units(F.col(c)).alias(c) for c in ("gripper_position", "next_reward")])


def p4_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compacted files with rows and bytes, beside the count of small files and their bytes that `episodes` lists."""
    small = table(spark, sf_dir, "episodes").dropDuplicates(["data_path"]).agg(F.count("*"), F.sum("file_bytes")).head()
    return compactor.file_report(_compacted(spark, sf_dir)).withColumns({"small_files": F.lit(small[0]), "small_bytes": F.lit(small[1]).cast("long")})


def queries() -> dict:
    return {"p1_found": p1_found, "p1_flags": p1_flags, "p1_kinds": p1_kinds, "p1_cutoffs": p1_cutoffs, "p4_compacted": p4_compacted, "p4_files": p4_files}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p1_kinds": P1_KINDS_SQL, "p4_compacted": P4_SQL}
