"""Statistics of vector features, their merging, dictionaries and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajecta.operators.prefix import running
from trajecta.operators.quantiles import with_quantiles
from trajecta.session import materialize

STATS = ("mean", "std", "min", "max", "q01", "q99")


def float_features(df: DataFrame) -> list[str]:
    """Columns that hold floating numbers, alone or as vectors."""
    floats = (T.FloatType, T.DoubleType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, floats) or isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, floats)]


def tall(df: DataFrame, keys: list[str], features: list[str], single: bool = False) -> DataFrame:
    """keys, feature, dim, value of every component; single rounds values to float32 first. Null components are kept as nulls."""
    arrays = []
    for name in features:
        c = F.col(name)
        c = c if isinstance(df.schema[name].dataType, T.ArrayType) else F.array(c)
        c = c.cast("array<float>") if single else c
        arrays.append(F.struct(F.lit(name).alias("feature"), c.cast("array<double>").alias("v")))
    x = df.select(*keys, F.explode(F.array(*arrays)).alias("f"))
    return x.select(*keys, F.col("f.feature").alias("feature"), F.posexplode("f.v").alias("dim", "value"))


def feature_stats(values: DataFrame, by: list[str], value: str = "value", accuracy: int | None = None) -> DataFrame:
    """Population statistics of each group; nulls and NaN aren't counted, a group without others gives no row.

    Quantiles are exact and interpolated, by two passes (operators.quantiles); with accuracy one pass gives those of percentile_approx.
    """
    if accuracy is None:
        return with_quantiles(values, by, value, {"q01": 0.01, "q99": 0.99})
    v = F.nanvl(F.col(value), F.lit(None).cast("double"))
    q = lambda p: F.percentile_approx(v, F.lit(p), F.lit(accuracy))
    out = values.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), q(0.01).alias("q01"), q(0.99).alias("q99"))
    return out.where("n > 0")


def relative_values(steps: DataFrame, action: str, state: str, horizon: int, variant: str = "loader", episode: str = "episode_index", frame: str = "frame_index") -> DataFrame:
    """episode, frame, h, value = action at frame + h less state at frame, for the frames whose whole horizon lies in the episode.

    The loader allows a start at length - horizon, the converter one fewer. Shifts of one window spec; no self-join.
    """
    w = Window.partitionBy(episode).orderBy(frame)
    length = F.count("*").over(Window.partitionBy(episode))
    last = length - horizon - (1 if variant == "converter" else 0)
    ahead = F.array(*[F.lead(action, h).over(w) - F.col(state) for h in range(horizon)])
    x = steps.select(episode, frame, ahead.alias("_d"), last.alias("_last")).where(F.col(frame) <= F.col("_last"))
    return x.select(episode, frame, F.posexplode("_d").alias("h", "value"))


def merged_stats(stats: DataFrame, by: list[str], weight: str, mode: str = "min_max") -> DataFrame:
    """Statistics of the weighted mixture of the rows of each group; weights are normalized within it.

    mode min_max takes the extreme quantiles, weighted_average their weighted mean.
    """
    if mode not in ("min_max", "weighted_average"):
        raise ValueError(f"unknown mode {mode}")
    w = F.col(weight) / F.sum(weight).over(Window.partitionBy(*by))
    x = stats.withColumn("_w", w)
    mean = F.sum(F.col("_w") * F.col("mean"))
    square = F.sum(F.col("_w") * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean")))
    quantile = {"q01": F.min("q01"), "q99": F.max("q99")} if mode == "min_max" else {q: F.sum(F.col("_w") * F.col(q)) for q in ("q01", "q99")}
    return x.groupBy(*by).agg(mean.alias("mean"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("std"), F.min("min").alias("min"), F.max("max").alias("max"), *[c.alias(q) for q, c in quantile.items()])


def moments(values: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """n, mean, m2 (sum of squared deviations) of each group: summaries that merge."""
    return values.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("m2"))


def merged_moments(parts: DataFrame, by: list[str]) -> DataFrame:
    """Moments of the union of the parts of each group: the parts' own deviations and those of their means from the common mean, so that
    no large squares cancel."""
    w = Window.partitionBy(*by)
    x = parts.withColumn("_mean", F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w))
    off = F.col("mean") - F.col("_mean")
    return x.groupBy(*by).agg(F.sum("n").alias("n"), F.max("_mean").alias("mean"), F.sum(F.when(F.col("n") > 0, F.col("m2") + F.col("n") * off * off)).alias("m2"))


def summary(values: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean, sample deviation, lower median, extremes and checksums."""
    v = F.col(value)
    return values.groupBy(*by).agg(
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value})").alias("median"), F.max(v).alias("max"), F.min(v).alias("min"), F.avg(F.abs(v)).alias("abs_mean"), F.sum(F.abs(v)).alias("abs_sum")
    )


def weighted_mean(df: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    return df.groupBy(*by).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("mean"))


def dictionary_first_seen(df: DataFrame, text: str, episode: str, frame: str, start: int = 0) -> DataFrame:
    """(text, id) in the order in which texts come first; null and empty texts have no id."""
    x = df.where(F.col(text).isNotNull() & (F.col(text) != "")).groupBy(text).agg(F.min(F.struct(F.col(episode).alias("e"), F.col(frame).alias("f"))).alias("_first")).withColumn("_one", F.lit(1).cast("long"))
    x = running(x, F.floor(F.col("_first.e") / 4096), ["_first", text], {"_n": ("_one", "sum")})
    return x.select(text, (F.col("_n") - 1 + start).alias("id"))


def dictionary_sorted(df: DataFrame, text: str, main: str | None = None) -> DataFrame:
    """(text, id) in binary order of the texts; a main text has id 0 and comes no second time."""
    x = df.where(F.col(text).isNotNull()).select(text).distinct()
    if main is not None:
        x = x.where(F.col(text) != main)
    parts = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, since the sampled bounds of the ranges may differ from one evaluation to the next
    x = materialize(x.repartitionByRange(parts, text).select(text, F.spark_partition_id().alias("_p"), F.lit(1).cast("long").alias("_one")), "dictionary")
    x = running(x, F.col("_p"), [text], {"_n": ("_one", "sum")})
    x = x.select(text, (F.col("_n") - (1 if main is None else 0)).alias("id"))
    return x if main is None else x.unionByName(x.sparkSession.createDataFrame([(main, 0)], f"{text} string, id long"))


def episode_summary(steps: DataFrame, episode: str, frame: str, text: str) -> DataFrame:
    """Length of each episode and its texts in order of first appearance, [""] without any. A group's list holds distinct texts only."""
    firsts = steps.groupBy(episode, text).agg(F.min(frame).alias("_f"), F.count("*").alias("_n"))
    known = F.col(text).isNotNull() & (F.col(text) != "")
    x = firsts.groupBy(episode).agg(F.sum("_n").alias("length"), F.array_sort(F.collect_list(F.when(known, F.struct("_f", F.col(text).alias("t"))))).alias("_t"))
    tasks = F.transform("_t", lambda s: s["t"])
    return x.select(episode, "length", F.when(F.size(tasks) > 0, tasks).otherwise(F.array(F.lit(""))).alias("tasks"))


def totals(steps: DataFrame, episode: str, text: str, per_chunk: int = 1000) -> DataFrame:
    x = steps.agg(F.count_distinct(episode).alias("episodes"), F.count("*").alias("frames"), F.count_distinct(text).alias("tasks"))
    return x.withColumn("chunks", F.ceil(F.col("episodes") / per_chunk))


def first_values(steps: DataFrame, episode: str, frame: str, columns: list[str]) -> DataFrame:
    """The columns' values at each episode's first frame."""
    return steps.groupBy(episode).agg(*[F.min_by(c, frame).alias(c) for c in columns])


def squared_errors(pairs: DataFrame, key: str, dim: str, prediction: str, truth: str) -> DataFrame:
    """Mean squared error per key and dim, per key, and overall (nulls in key and dim mark the totals)."""
    d = F.col(prediction) - F.col(truth)
    return pairs.withColumn("_e", d * d).groupingSets([[F.col(key), F.col(dim)], [F.col(key)], []], F.col(key), F.col(dim)).agg(F.avg("_e").alias("mse"), F.count("_e").alias("n"))


def top_k_accuracy(scores: DataFrame, sample: str, label: str, score: str, truth: str, k: int, mask: Column | None = None) -> DataFrame:
    """Share of samples (under the mask) whose true label is among the k best scores; ties go to the smaller label."""
    x = scores.withColumn("_r", F.row_number().over(Window.partitionBy(sample).orderBy(F.desc(score), label)))
    x = x.groupBy(sample).agg(F.max(((F.col(label) == F.col(truth)) & (F.col("_r") <= k)).cast("int")).alias("hit"), F.bool_and(F.lit(True) if mask is None else mask).alias("_m"))
    return x.agg(F.avg(F.when(F.col("_m"), F.col("hit"))).alias("accuracy"), F.sum(F.when(F.col("_m"), F.col("hit"))).alias("hits"), F.count(F.when(F.col("_m"), F.lit(1))).alias("n"))


def best_of(candidates: DataFrame, by: list[str], value: str, tie: str, keep: list[str]) -> DataFrame:
    """Of each group the candidate of the greatest value; ties go to the smaller tie column."""
    x = candidates.groupBy(*by).agg(F.max_by(F.struct(*keep), F.struct(F.col(value), (-F.col(tie)).alias("t"))).alias("_b"))
    return x.select(*by, "_b.*")


#: Statistics of the task progress, as if it were spread evenly.
PROGRESS_STATS = {"max": 1.0, "min": 0.0, "mean": 0.5, "std": 0.2887, "q01": 0.01, "q99": 0.99}


def task_progress(steps: DataFrame, episode: str, frame: str) -> DataFrame:
    """frame / length, so below 1."""
    return steps.withColumn("progress", F.col(frame) / F.count("*").over(Window.partitionBy(episode)))
