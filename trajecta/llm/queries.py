"""Queries of the operators for training data, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajecta.llm import bpe, containers, duplicates, mixing, percentiles, runs, spam, splits
from trajecta.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ONCE = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY episode_index, frame_index ORDER BY ingested_at) AS rn
                 FROM frames WHERE episode_index IS NOT NULL AND frame_index IS NOT NULL) WHERE rn = 1"""


# 2: duplicates hidden by formatting

RECORDS = (("tasks", "task_index", ["task"]), ("annotations", "annotation_id", ["language_instruction", "language_instruction_2", "language_instruction_3"]))


def _both(f, spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (f(table(spark, sf_dir, t), i, slots).select(F.lit(t).alias("table_name"), "*") for t, i, slots in RECORDS)
    return a.unionByName(b)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(duplicates.copies, spark, sf_dir)


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per set of same records, with its number of copies."""
    return _both(duplicates.collapsed, spark, sf_dir).drop("canonical")


_CANONICAL = "lower(upper(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')))"
_P2_KEYS = f"""
k AS (SELECT DISTINCT 'tasks' AS table_name, task_index AS id, {_CANONICAL.format("task")} AS c FROM tasks
      UNION SELECT DISTINCT 'annotations', annotation_id, array_to_string(list_sort(list_filter([{", ".join(_CANONICAL.format(f"coalesce(language_instruction{x}, '')") for x in ("", "_2", "_3"))}], lambda x: x <> '')), chr(1)) FROM annotations),
g AS (SELECT *, min(id) OVER (PARTITION BY table_name, c) AS keep_id FROM k WHERE c <> '' AND id IS NOT NULL)"""
P2_RECORDS_SQL = f"""
WITH d AS (SELECT 'tasks' AS table_name, task_index AS id, {_CANONICAL.format("task")} AS c, [coalesce(task, '')] AS raw FROM tasks
      UNION ALL SELECT 'annotations', annotation_id, array_to_string(list_sort(list_filter([{", ".join(_CANONICAL.format(f"coalesce(language_instruction{x}, '')") for x in ("", "_2", "_3"))}], lambda x: x <> '')), chr(1)),
             [{", ".join(f"coalesce(language_instruction{x}, '')" for x in ("", "_2", "_3"))}] FROM annotations)
SELECT table_name, min(id) AS keep_id, CAST(count(DISTINCT (id, raw)) AS BIGINT) AS n_records, CAST(count(*) AS BIGINT) AS n_rows FROM d WHERE c <> '' AND id IS NOT NULL GROUP BY table_name, c
"""
P2_SQL = f"WITH {_P2_KEYS} SELECT DISTINCT table_name, keep_id, id AS copy_id FROM g WHERE id <> keep_id"


# 3: repeated events


def p3_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.near_identical_runs(table(spark, sf_dir, "frames"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_runs(spark, sf_dir).select("episode_index", "first_frame", "last_frame")


_COMPONENTS = [*[f"joint_position[{k}]" for k in range(1, 8)], *[f"cartesian_position[{k}]" for k in range(1, 7)], "gripper_position"]
_NEAR = " AND ".join(f"coalesce(isfinite({c}) AND isfinite(lag({c}) OVER w) AND abs({c} - lag({c}) OVER w) <= 0.002, false)" for c in _COMPONENTS)
P3_SQL = f"""
WITH f AS ({_ONCE}),
n AS (SELECT episode_index, frame_index, ts_sec, {_NEAR} AS near FROM f WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
r AS (SELECT *, sum(CASE WHEN near THEN 0 ELSE 1 END) OVER (PARTITION BY episode_index ORDER BY frame_index) AS run FROM n)
SELECT episode_index, min(frame_index) AS first_frame, max(frame_index) AS last_frame, count(*) AS n_frames,
       round(max_by(ts_sec, frame_index) - min_by(ts_sec, frame_index), 4) AS duration
FROM r GROUP BY episode_index, run HAVING count(*) > 1
"""


# 5: percentiles


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("dataset_path", "feature_key", "dim", "n", *[F.round(q, 6).alias(q) for q in percentiles.QUANTILES], "relative_error")


def p5_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, q01 and q99 of each dataset, feature and dim."""
    return _rounded(percentiles.percentiles(percentiles.merge(percentiles.sketch(table(spark, sf_dir, "frames")))))


def p5_percentiles_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from sketches that each day of recorded_at made apart and stored."""
    days = materialize(percentiles.sketch(table(spark, sf_dir, "frames"), by_day=True), "p5-days")
    return _rounded(percentiles.percentiles(percentiles.merge(days)))


def _p5_sql() -> str:
    a = percentiles.RELATIVE_ERROR
    base, g = percentiles.log_base(a), (1 + a) / (1 - a)
    fields = " UNION ALL ".join(
        f"SELECT dataset_path, '{name}' AS feature_key, unnest(range({w})) AS dim, " + (f"unnest({name}[1:{w}])" if w > 1 else f"unnest([{name}])") + " AS x FROM f" for name, w in percentiles.FIELDS
    )
    value = f"CASE WHEN code = 0 THEN 0.0 ELSE sign(code) * exp((abs(code) - {percentiles.OFFSET}) * {base!r}) * 2 / {g!r} END".replace(f"/ {g!r}", f"/ ({g!r} + 1)")
    at = lambda r: f"max(CASE WHEN {r} >= upto - cnt AND {r} < upto THEN v END)"
    q = lambda p: f"round({at(f'floor({p} * (n - 1))')} * (1 - max({p}::double * (n - 1) - floor({p}::double * (n - 1)))) + {at(f'ceil({p} * (n - 1))')} * max({p}::double * (n - 1) - floor({p}::double * (n - 1))), 6)".replace(f"floor({p} *", f"floor({p}::double *").replace(f"ceil({p} *", f"ceil({p}::double *")
    return f"""
WITH f AS ({_ONCE}), t AS ({fields}),
c AS (SELECT dataset_path, feature_key, CAST(dim AS bigint) AS dim,
        CASE WHEN x = 0 THEN 0 ELSE CAST(sign(x) AS bigint) * (CAST(ceil(ln(abs(x)) / {base!r}) AS bigint) + {percentiles.OFFSET}) END AS code, count(*) AS cnt
      FROM t WHERE x IS NOT NULL AND isfinite(x) GROUP BY ALL),
s AS (SELECT *, {value} AS v, sum(cnt) OVER (PARTITION BY dataset_path, feature_key, dim ORDER BY code) AS upto,
        sum(cnt) OVER (PARTITION BY dataset_path, feature_key, dim) AS n FROM c)
SELECT dataset_path, feature_key, dim, CAST(max(n) AS bigint) AS n, {q(0.5)} AS median, {q(0.01)} AS q01, {q(0.99)} AS q99, {a}::double AS relative_error
FROM s GROUP BY dataset_path, feature_key, dim
"""


# 8: tokens


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_ids(table(spark, sf_dir, "documents"))


# 6: splits


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.groups(table(spark, sf_dir, "episodes"), table(spark, sf_dir, "tasks"))


P6_SQL = f"""
WITH RECURSIVE k AS (SELECT {_CANONICAL.format("task")} AS c, min(task_index) AS id FROM tasks GROUP BY 1),
l AS (SELECT DISTINCT episode_index, {_CANONICAL.format("t")} AS c FROM (SELECT episode_index, unnest(tasks) AS t FROM episodes WHERE episode_index IS NOT NULL)
      WHERE {_CANONICAL.format("t")} NOT IN ('', 'notprovided')),
e AS (SELECT DISTINCT a.c AS x, b.c AS y FROM l a JOIN l b USING (episode_index)),
reach AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
g AS (SELECT x, min(id) AS group_task_index FROM reach LEFT JOIN k ON k.c = reach.y GROUP BY 1)
SELECT DISTINCT episode_index, group_task_index FROM l JOIN g ON g.x = l.c
"""


def p6_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.splits(table(spark, sf_dir, "episodes"), table(spark, sf_dir, "tasks"))


def p6_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of all episodes and of each label that the splits reach, beside the targets."""
    return splits.shares(table(spark, sf_dir, "episodes"), table(spark, sf_dir, "tasks"))


# 7: mixtures


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "episodes"), table(spark, sf_dir, "mixture_spec"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "episodes"), table(spark, sf_dir, "mixture_spec"))


def p7_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, target share and cap of each mixture and dataset."""
    got = mixing.targets(table(spark, sf_dir, "episodes"), table(spark, sf_dir, "mixture_spec"))
    return got.withColumns({c: F.round(c, 9) + F.lit(0.0) for c in ("weight", "target_share")})


P7_TARGETS_SQL = """
WITH e AS (SELECT rtrim(dataset_path, '/') AS path, length FROM episodes WHERE episode_index IS NOT NULL AND dataset_path IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY episode_index ORDER BY exported_at DESC, length) = 1),
l AS (SELECT path, sum(length) AS n FROM e WHERE length > 0 GROUP BY 1),
s AS (SELECT row_number() OVER () AS spec, mixture_name, rtrim(coalesce(dataset_path, ''), '/') AS p, distribute_weights, greatest(coalesce(max_repeats, 1), 0) AS cap,
             CASE WHEN isfinite(dataset_weight) AND dataset_weight > 0 THEN dataset_weight ELSE 0 END AS w
      FROM mixture_spec WHERE mixture_name IS NOT NULL),
h AS (SELECT s.*, path, n FROM s JOIN l ON path GLOB p WHERE contains(p, '*')
      UNION ALL SELECT s.*, p, coalesce(n, 0) FROM s LEFT JOIN l ON path = p WHERE NOT contains(p, '*')),
t AS (SELECT *, sum(n) OVER (PARTITION BY spec) AS total FROM h),
g AS (SELECT mixture_name, path AS dataset_path, sum(w * CASE WHEN coalesce(distribute_weights, false) THEN CASE WHEN total > 0 THEN n / total ELSE 0 END ELSE 1 END) AS weight,
             CAST(min(cap) AS BIGINT) AS max_repeats, max(n) AS n FROM t GROUP BY 1, 2),
d AS (SELECT *, CASE WHEN n > 0 AND max_repeats > 0 THEN weight ELSE 0 END AS drawn FROM g),
q AS (SELECT *, sum(drawn) OVER (PARTITION BY mixture_name) AS total FROM d)
SELECT mixture_name, dataset_path, round(weight, 9) AS weight, round(CASE WHEN total > 0 THEN drawn / total ELSE 0 END, 9) AS target_share, max_repeats FROM q
"""


# 9: containers


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers.containers(table(spark, sf_dir, "documents"))


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers.fill_report(p9_containers(spark, sf_dir))


# 10: spam pages


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.flagged(table(spark, sf_dir, "documents"))


def p10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.pages(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {"p6_found": p6_found, "p6_splits": p6_splits, "p6_shares": p6_shares, "p7_mixture": p7_mixture, "p7_shares": p7_shares, "p7_targets": p7_targets, "p9_containers": p9_containers, "p9_fill": p9_fill, "p10_found": p10_found, "p10_pages": p10_pages, "p2_found": p2_found, "p2_records": p2_records, "p8_ids": p8_ids, "p3_found": p3_found, "p3_runs": lambda s, d: p3_runs(s, d).withColumn("duration", F.round("duration", 4)), "p5_percentiles": p5_percentiles, "p5_percentiles_by_day": p5_percentiles_by_day}


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_SQL, "p2_records": P2_RECORDS_SQL, "p7_targets": P7_TARGETS_SQL, "p6_found": P6_SQL, "p3_found": f"SELECT episode_index, first_frame, last_frame FROM ({P3_SQL})", "p3_runs": P3_SQL, "p5_percentiles": _p5_sql(), "p5_percentiles_by_day": _p5_sql()}
