"""Queries of statistics, dictionaries, summaries and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajecta.operators import filters, joins, sampling, stats, validate, windows
from trajecta.plans.common import ONCE, STEPS, once, packed, query, r, steps, table

_SIX = "round(avg(value), 4) + 0.0 AS mean, round(stddev_pop(value), 4) + 0.0 AS std, round(min(value), 4) + 0.0 AS min, round(max(value), 4) + 0.0 AS max, round(quantile_cont(value, 0.01), 4) + 0.0 AS q01, round(quantile_cont(value, 0.99), 4) + 0.0 AS q99"


def _six(df, by, digits=4):
    return df.select(*by, "n", *[r(c, digits).alias(c) for c in stats.STATS])


#: Float features of frames, with their dims.
_FEATURES = {"ts_sec": 0, "joint_position": 7, "joint_velocity": 7, "cartesian_position": 6, "gripper_position": 0, "next_reward": 0}
_TALL = " UNION ALL ".join(f"SELECT dataset_path, '{f}' AS feature, " + (f"unnest(range({n})) AS dim, unnest({f}[1:{n}]) AS value" if n else f"0 AS dim, {f} AS value") + " FROM frames" for f, n in _FEATURES.items())


@query(
    "feature_stats",
    f"WITH u AS ({_TALL})"
    f" SELECT dataset_path, feature, CAST(dim AS BIGINT) AS dim, count(value) AS n, {_SIX.replace(', 4)', ', 6)')} FROM u WHERE value IS NOT NULL AND NOT isnan(value) AND isfinite(value) GROUP BY ALL",
)
def feature_stats(spark, d):
    """Per dataset, float feature and dim over the finite readings."""
    frames = table(spark, d, "frames")
    v = stats.tall(frames, ["dataset_path"], stats.float_features(frames)).where("abs(value) < double('Infinity')")
    by = ["dataset_path", "feature", "dim"]
    return _six(stats.feature_stats(v.withColumn("dim", F.col("dim").cast("long")), by), by, 6)


@query("packed_feature_stats", f"WITH u AS (SELECT unnest(range(4)) AS dim, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value FROM lineitem) SELECT CAST(dim AS BIGINT) AS dim, count(value) AS n, {_SIX} FROM u GROUP BY dim")
def packed_feature_stats(spark, d):
    v = packed(spark, d).select(F.posexplode("state").alias("dim", "value")).withColumn("dim", F.col("dim").cast("long"))
    return _six(stats.feature_stats(v, ["dim"]), ["dim"])


@query("float_features", "SELECT * FROM (VALUES ('ts_sec'), ('joint_position'), ('joint_velocity'), ('cartesian_position'), ('gripper_position'), ('next_reward')) t(name)")
def float_features(spark, d):
    return spark.createDataFrame([(n,) for n in stats.float_features(table(spark, d, "frames"))], "name string")


#: Rows of an action chunk: the reference's delta_indices of actions, 0 to 23.
_HORIZON = 24


def _relative_sql(last: str, by: str) -> str:
    out = f"{by}, " if by else ""
    return f"WITH {STEPS}, u AS (SELECT b.frame_index - a.frame_index AS h, b.value - a.value AS value FROM steps a JOIN steps b ON a.episode_index = b.episode_index AND b.frame_index BETWEEN a.frame_index AND a.frame_index + {_HORIZON - 1} WHERE a.frame_index <= {last}) SELECT {out}count(value) AS n, {_SIX} FROM u" + (f" GROUP BY {by}" if by else "")


@query("relative_stats_pooled_loader", _relative_sql(f"a.length - {_HORIZON}", ""))
def relative_stats_pooled_loader(spark, d):
    return _six(stats.feature_stats(stats.relative_values(steps(spark, d), "value", "value", _HORIZON), []), [])


@query("relative_stats_pooled_converter", _relative_sql(f"a.length - {_HORIZON + 1}", ""))
def relative_stats_pooled_converter(spark, d):
    return _six(stats.feature_stats(stats.relative_values(steps(spark, d), "value", "value", _HORIZON, "converter"), []), [])


@query("relative_stats_per_horizon", _relative_sql(f"a.length - {_HORIZON}", "h"))
def relative_stats_per_horizon(spark, d):
    v = stats.relative_values(steps(spark, d), "value", "value", _HORIZON).withColumn("h", F.col("h").cast("long"))
    return _six(stats.feature_stats(v, ["h"]), ["h"])


_LABELLED = "v AS (SELECT label, CAST(d - 1 AS BIGINT) AS dim, CAST(embedding[d] AS DOUBLE) AS value FROM (SELECT *, unnest(range(1, 65)) AS d FROM embeddings)), s AS (SELECT label, dim, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99 FROM v GROUP BY ALL), w AS (SELECT *, n / sum(n) OVER (PARTITION BY dim) AS w FROM s)"


def _merge_sql(low: str, high: str) -> str:
    return f"WITH {_LABELLED} SELECT dim, round(sum(w * mean), 4) + 0.0 AS mean, round(sqrt(greatest(sum(w * (std * std + mean * mean)) - sum(w * mean) * sum(w * mean), 0)), 4) + 0.0 AS std, round(min(lo), 4) + 0.0 AS min, round(max(hi), 4) + 0.0 AS max, round({low}, 4) + 0.0 AS q01, round({high}, 4) + 0.0 AS q99 FROM w GROUP BY dim"


def _merging(spark, d, mode):
    v = stats.tall(table(spark, d, "embeddings"), ["label"], ["embedding"]).withColumn("dim", F.col("dim").cast("long"))
    m = stats.merged_stats(stats.feature_stats(v, ["label", "dim"]), ["dim"], "n", mode)
    return m.select("dim", *[r(c).alias(c) for c in stats.STATS])


@query("stats_merge_min_max", _merge_sql("min(q01)", "max(q99)"))
def stats_merge_min_max(spark, d):
    return _merging(spark, d, "min_max")


@query("stats_merge_weighted_average", _merge_sql("sum(w * q01)", "sum(w * q99)"))
def stats_merge_weighted_average(spark, d):
    return _merging(spark, d, "weighted_average")


_DISTINCT_STATS = "s AS (SELECT DISTINCT dataset_path, modality, feature_key, dim, n_frames, v_max, v_min, v_mean, v_std, q01, q99 FROM dataset_stats WHERE v_mean IS NOT NULL AND v_std IS NOT NULL AND NOT isnan(v_mean) AND NOT isnan(v_std) AND n_frames > 0)"


@query(
    "stats_merge_by_tag",
    f"WITH {_DISTINCT_STATS}, t AS (SELECT embodiment_tag, s.*, n_frames / sum(n_frames) OVER (PARTITION BY embodiment_tag, feature_key, dim) AS w FROM s JOIN datasets USING (dataset_path))"
    " SELECT embodiment_tag, feature_key, dim, round(sum(w * v_mean), 4) + 0.0 AS mean, round(sqrt(greatest(sum(w * (v_std * v_std + v_mean * v_mean)) - sum(w * v_mean) * sum(w * v_mean), 0)), 4) + 0.0 AS std, count(*) AS parts FROM t GROUP BY ALL",
)
def stats_merge_by_tag(spark, d):
    """The stored statistics of an earlier release, per embodiment tag; weights go by dataset."""
    s = table(spark, d, "dataset_stats").distinct().where("v_mean IS NOT NULL AND v_std IS NOT NULL AND NOT isnan(v_mean) AND NOT isnan(v_std) AND n_frames > 0")
    s = s.join(table(spark, d, "datasets").select("dataset_path", "embodiment_tag"), "dataset_path")
    s = s.select("embodiment_tag", "feature_key", "dim", "n_frames", F.col("v_mean").alias("mean"), F.col("v_std").alias("std"), F.col("v_min").alias("min"), F.col("v_max").alias("max"), "q01", "q99")
    by = ["embodiment_tag", "feature_key", "dim"]
    return stats.merged_stats(s, by, "n_frames").select(*by, r("mean").alias("mean"), r("std").alias("std")).join(s.groupBy(*by).agg(F.count("*").alias("parts")), by)


@query("moments_merge", "SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 8) + 0.0 AS mean, round(stddev_pop(c_acctbal), 4) + 0.0 AS std FROM customer GROUP BY 1")
def moments_merge(spark, d):
    parts = stats.moments(table(spark, d, "customer"), ["c_mktsegment", "c_nationkey"], "c_acctbal")
    return stats.merged_moments(parts, ["c_mktsegment"]).select("c_mktsegment", "n", r("mean", 8).alias("mean"), r(F.sqrt(F.col("m2") / F.col("n"))).alias("std"))


@query("weighted_meter", "SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) + 0.0 AS mean FROM lineitem GROUP BY 1")
def weighted_meter(spark, d):
    return stats.weighted_mean(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity").select("l_returnflag", r("mean").alias("mean"))


@query("value_summary", "SELECT event_type, round(avg(value), 4) + 0.0 AS mean, round(stddev_samp(value), 4) + 0.0 AS std, quantile_disc(value, 0.5) AS median, max(value) AS max, min(value) AS min, round(avg(abs(value)), 4) + 0.0 AS abs_mean, round(sum(abs(value)), 2) + 0.0 AS abs_sum FROM events GROUP BY 1")
def value_summary(spark, d):
    s = stats.summary(table(spark, d, "events"), ["event_type"], "value")
    return s.select("event_type", r("mean").alias("mean"), r("std").alias("std"), "median", "max", "min", r("abs_mean").alias("abs_mean"), r("abs_sum", 2).alias("abs_sum"))


@query("task_dictionary_first_seen", f"WITH {STEPS}, f AS (SELECT label, min(episode_index * 1000000 + frame_index) AS pos FROM steps GROUP BY 1) SELECT label, CAST(row_number() OVER (ORDER BY pos, label) AS BIGINT) AS id FROM f")
def task_dictionary_first_seen(spark, d):
    return stats.dictionary_first_seen(steps(spark, d), "label", "episode_index", "frame_index", start=1)


@query("task_dictionary_sorted", "SELECT task, CAST(CASE WHEN task = 'not provided' THEN 0 ELSE row_number() OVER (PARTITION BY task = 'not provided' ORDER BY task) END AS BIGINT) AS id FROM (SELECT DISTINCT task FROM tasks WHERE task IS NOT NULL)")
def task_dictionary_sorted(spark, d):
    return stats.dictionary_sorted(table(spark, d, "tasks"), "task", "not provided")


@query("episode_summary", f"WITH {STEPS}, f AS (SELECT episode_index, label, min(frame_index) AS pos, count(*) AS n FROM steps GROUP BY ALL) SELECT episode_index, CAST(sum(n) AS BIGINT) AS length, string_agg(label, '|' ORDER BY pos) AS tasks FROM f GROUP BY 1")
def episode_summary(spark, d):
    s = stats.episode_summary(steps(spark, d), "episode_index", "frame_index", "label")
    return s.select("episode_index", F.col("length").cast("long").alias("length"), F.array_join("tasks", "|").alias("tasks"))


@query("dataset_totals", f"WITH {STEPS} SELECT count(DISTINCT episode_index) AS episodes, count(*) AS frames, count(DISTINCT label) AS tasks, CAST(ceil(count(DISTINCT episode_index) / 1000.0) AS BIGINT) AS chunks FROM steps")
def dataset_totals(spark, d):
    return stats.totals(steps(spark, d), "episode_index", "label")


@query("initial_values", f"WITH {STEPS} SELECT episode_index, value, k, label FROM steps WHERE frame_index = 0")
def initial_values(spark, d):
    return stats.first_values(steps(spark, d), "episode_index", "frame_index", ["value", "k", "label"])


@query("task_progress", f"WITH {STEPS} SELECT event_id, round(frame_index / length, 6) + 0.0 AS progress FROM steps")
def task_progress(spark, d):
    return stats.task_progress(steps(spark, d), "episode_index", "frame_index").select("event_id", r("progress", 6).alias("progress"))


@query("capped_stats", f"WITH {STEPS}, c AS (SELECT episode_index FROM (SELECT DISTINCT episode_index FROM steps) ORDER BY sha256(concat_ws(',', CAST(episode_index AS VARCHAR), '42')) LIMIT 100) SELECT count(value) AS n, {_SIX} FROM steps SEMI JOIN c USING (episode_index)")
def capped_stats(spark, d):
    """Statistics over at most 100 episodes, taken in seeded hash order: the sampling operator of the loader."""
    s = steps(spark, d)
    some = s.select("episode_index").distinct().orderBy(sampling.hash_order(F.col("episode_index"), 42)).limit(100)
    return _six(stats.feature_stats(s.join(some, "episode_index", "left_semi"), []), [])


# evaluation

_PAIRS = "p AS (SELECT l_returnflag AS key, CAST(l_linenumber AS BIGINT) AS dim, l_quantity / 50.0 AS prediction, l_discount * 10.0 AS truth FROM lineitem)"


@query("mse_grouping", f"WITH {_PAIRS} SELECT key, dim, round(avg((prediction - truth) * (prediction - truth)), 6) + 0.0 AS mse, count(*) AS n FROM p GROUP BY GROUPING SETS ((key, dim), (key), ())")
def mse_grouping(spark, d):
    p = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("key"), F.col("l_linenumber").cast("long").alias("dim"), (F.col("l_quantity") / 50.0).alias("prediction"), (F.col("l_discount") * 10.0).alias("truth"))
    return stats.squared_errors(p, "key", "dim", "prediction", "truth").select("key", "dim", r("mse", 6).alias("mse"), "n")


@query(
    "topk_accuracy",
    "WITH s AS (SELECT vec_id, label, CAST(d - 1 AS BIGINT) AS class, CAST(embedding[d] AS DOUBLE) AS score FROM (SELECT *, unnest(range(1, 65)) AS d FROM embeddings)), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class) AS rk FROM s), h AS (SELECT vec_id, max(CASE WHEN class = label AND rk <= 9 THEN 1 ELSE 0 END) AS hit FROM k GROUP BY 1)"
    " SELECT round(avg(hit), 6) + 0.0 AS accuracy, CAST(sum(hit) AS BIGINT) AS hits, count(*) AS n FROM h",
)
def topk_accuracy(spark, d):
    s = stats.tall(table(spark, d, "embeddings"), ["vec_id", "label"], ["embedding"])
    return stats.top_k_accuracy(s.withColumnRenamed("dim", "class"), "vec_id", "class", "value", "label", 9).select(r("accuracy", 6).alias("accuracy"), "hits", "n")


@query("best_of_n", "SELECT o_custkey, o_totalprice, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def best_of_n(spark, d):
    return stats.best_of(table(spark, d, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey", ["o_totalprice", "o_orderkey"])


@query("run_compare", "WITH a AS (SELECT event_id // 10 AS step, arg_max(value, event_id) AS a FROM events WHERE event_id % 3 <> 0 GROUP BY 1), b AS (SELECT event_id // 12 AS step, arg_max(value, event_id) AS b FROM events WHERE event_id % 3 = 0 GROUP BY 1) SELECT step, a, b, round(a - b, 4) + 0.0 AS difference FROM a FULL OUTER JOIN b USING (step)")
def run_compare(spark, d):
    e = table(spark, d, "events")
    a = e.where("event_id % 3 <> 0").withColumn("step", F.expr("event_id div 10"))
    b = e.where("event_id % 3 = 0").withColumn("step", F.expr("event_id div 12"))
    return joins.compared_runs(a, b, "step", "value", "event_id").select("step", "a", "b", r("difference").alias("difference"))


@query("trailing_mean", f"WITH {STEPS}, m AS (SELECT *, avg(value) OVER (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m FROM steps) SELECT episode_index, frame_index, round(m, 4) + 0.0 AS mean FROM m WHERE frame_index % 10 = 0")
def trailing_mean(spark, d):
    x = steps(spark, d).withColumn("m", windows.trailing_mean(["episode_index"], "frame_index", "value"))
    return x.where("frame_index % 10 = 0").select("episode_index", "frame_index", r("m").alias("mean"))


# validation


@query(
    "validate_episodes",
    f"WITH {ONCE}, s AS (SELECT episode_index, count(*) AS found, count(DISTINCT frame_index) AS nd, min(frame_index) AS a, max(frame_index) AS b FROM frames GROUP BY 1), e AS (SELECT episode_index, max(length) AS declared, count(*) AS n FROM episodes GROUP BY 1)"
    " SELECT episode_index, coalesce(found, 0) AS found, declared, coalesce(b - a + 1 = nd, false) AS consecutive, coalesce(nd = found, false) AS unique_frames, coalesce(n = 1, false) AS unique_episode, coalesce(found = declared, false) AS length_ok FROM s FULL OUTER JOIN e USING (episode_index)",
)
def validate_episodes(spark, d):
    return validate.episode_integrity(table(spark, d, "frames"), table(spark, d, "episodes"))


@query("out_of_sync", "WITH f AS (SELECT DISTINCT episode_index, frame_index, ts_sec, fps FROM frames JOIN datasets USING (dataset_path)), g AS (SELECT *, lag(frame_index) OVER w AS pf, lag(ts_sec) OVER w AS pt FROM f WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)) SELECT episode_index, CAST(sum(CASE WHEN frame_index = pf + 1 AND abs(ts_sec - pt - 1.0 / fps) > 0.001 THEN 1 ELSE 0 END) AS BIGINT) AS out_of_sync FROM g GROUP BY 1")
def out_of_sync(spark, d):
    f = table(spark, d, "frames").join(table(spark, d, "datasets").select("dataset_path", "fps"), "dataset_path").select("episode_index", "frame_index", "ts_sec", "fps").distinct()
    return validate.out_of_sync(f, "episode_index", "frame_index", "ts_sec", "fps", 0.001)


_FIELDS = ("joint_position", "joint_velocity", "cartesian_position", "gripper_position", "next_reward", "ts_sec")


@query("unresolved_keys", f"SELECT dataset_path, feature_key FROM (SELECT dataset_path, embodiment_tag, unnest({list(_FIELDS)}) AS feature_key FROM datasets) c WHERE feature_key <> 'ts_sec' AND NOT EXISTS (SELECT 1 FROM modality m WHERE m.embodiment_tag = c.embodiment_tag AND m.feature_key = c.feature_key)")
def unresolved_keys(spark, d):
    """Float fields of frames that a dataset's modality map lacks; times are exempt."""
    c = table(spark, d, "datasets").select("dataset_path", "embodiment_tag", F.explode(F.array(*map(F.lit, _FIELDS))).alias("feature_key"))
    c = c.withColumn("modality", F.when(F.col("feature_key") == "ts_sec", "time").otherwise("any"))
    return validate.unresolved_keys(c, table(spark, d, "modality"), ["embodiment_tag", "feature_key"], ["time"]).select("dataset_path", "feature_key")


@query("file_counts", "WITH f AS (SELECT DISTINCT data_path FROM episodes), e AS (SELECT count(DISTINCT episode_index) AS n FROM episodes) SELECT 'parquet' AS kind, (SELECT count(*) FROM f WHERE data_path LIKE '%.parquet') AS found, n AS expected, (SELECT count(*) FROM f WHERE data_path LIKE '%.parquet') = n AS complete FROM e UNION ALL SELECT 'mp4', 0, 2 * n, 0 = 2 * n FROM e")
def file_counts(spark, d):
    """Files that the episodes list, beside one table an episode and one video for each of two cameras."""
    e = table(spark, d, "episodes")
    n = e.agg(F.count_distinct("episode_index")).head()[0]
    return validate.file_counts(e.select("data_path").distinct(), n, 2, "data_path")


@query("modality_filter", "SELECT dataset_path, count(*) AS n FROM frames WHERE joint_position IS NOT NULL AND len(joint_position) > 0 AND gripper_position IS NOT NULL GROUP BY 1")
def modality_filter(spark, d):
    f = table(spark, d, "frames").select("dataset_path", "joint_position", "gripper_position")
    return filters.with_modality(f, ["joint_position", "gripper_position"]).groupBy("dataset_path").agg(F.count("*").alias("n"))


@query("valid_results", "SELECT dataset_path, feature_key, dim, count(*) AS n FROM dataset_stats WHERE isfinite(v_mean) AND isfinite(v_std) AND isfinite(q01) AND isfinite(q99) GROUP BY ALL")
def valid_results(spark, d):
    s = filters.valid_results(table(spark, d, "dataset_stats"), ["v_mean", "v_std", "q01", "q99"])
    return s.groupBy("dataset_path", "feature_key", "dim").agg(F.count("*").alias("n"))


@query("same_configuration", "SELECT embodiment_tag, count(DISTINCT codebase_version) AS configurations, count(DISTINCT codebase_version) = 1 AS identical FROM datasets GROUP BY 1")
def same_configuration(spark, d):
    return validate.same_configuration(table(spark, d, "datasets"), "embodiment_tag", ["codebase_version"])


@query("synthesized_index", f"WITH {STEPS} SELECT event_id, frame_index AS index FROM steps")
def synthesized_index(spark, d):
    return validate.with_index(steps(spark, d), "episode_index", "frame_index").select("event_id", "index")


@query("dataset_warnings", "SELECT 'video' AS rule, 'warning' AS severity, 'no video' AS message")
def dataset_warnings(spark, d):
    return spark.createDataFrame(validate.missing_parts({"fps": 15}, {"state": ["observation.state"], "action": ["action"], "video": []}, once(spark, d).count()), "rule string, severity string, message string")
