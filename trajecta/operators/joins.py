"""Joins by id, interval and nearest time. Intervals and times are bucketed so that every join has an equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def looked_up(df: DataFrame, dictionary: DataFrame, key: str, text: str, default: str | None = None) -> DataFrame:
    """The text of each key; an unknown key is an error, or has the default."""
    d = dictionary.select(key, F.col(text).alias("_text"), F.lit(True).alias("_known"))
    missing = F.raise_error(F.concat(F.lit(f"unknown {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))) if default is None else F.lit(default)
    x = df.join(d, key, "left")
    return x.withColumn(text, F.when(F.col("_known"), F.col("_text")).otherwise(missing)).drop("_text", "_known")


def cells_of(intervals: DataFrame, steps: DataFrame, episode: str, frame: str, grid: int) -> DataFrame:
    """Intervals [start, end) cut at multiples of grid: a row for each cell that one touches, no further than the frames of its own
    episode reach. Those with a null bound or without a frame are left out."""
    reach = steps.groupBy(episode).agg(F.max(frame).alias("_last"))
    x = intervals.where("start IS NOT NULL AND `end` IS NOT NULL").join(reach, episode)
    x = x.withColumn("start", F.greatest(F.lit(0), "start")).withColumn("end", F.least("end", F.col("_last") + 1)).drop("_last").where("start < `end`")
    return x.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / grid), F.floor((F.col("end") - 1) / grid))))


def interval_labels(steps: DataFrame, intervals: DataFrame, episode: str, frame: str, label: str, default: str = "N/A", grid: int = 64) -> DataFrame:
    """Label of the last listed interval [max(0, start), min(length, end)) that holds a frame.

    intervals: episode, ordinal, start, end, label; those with a null bound are skipped. The intervals of a cell are one row, so
    frames are shuffled once, by cell.
    """
    i = cells_of(intervals, steps, episode, frame, grid).groupBy(episode, "_cell").agg(F.collect_list(F.struct("ordinal", "start", "end", F.col(label).alias("label"))).alias("_i"))
    x = steps.withColumn("_cell", F.floor(F.col(frame) / grid)).join(i, [episode, "_cell"], "left")
    here = F.filter("_i", lambda k: (F.col(frame) >= k["start"]) & (F.col(frame) < k["end"]))
    last = F.array_max(F.transform(here, lambda k: F.struct(k["ordinal"].alias("ordinal"), k["label"].alias("label"))))
    return x.withColumn(label, F.coalesce(last["label"], F.lit(default))).drop("_i", "_cell")


def nearest(left: DataFrame, right: DataFrame, by: list[str], time: str, ident: str) -> DataFrame:
    """ident of the right row nearest in time to each left row, the smaller ident of equally near ones; null without any.

    One sort of both sides by time: of equal times the smallest ident, carried forward and backward.
    """
    r = right.groupBy(*by, time).agg(F.min(ident).alias("_i")).select(*by, F.col(time).alias("_t"), F.struct(F.col(time).alias("t"), F.col("_i").alias("i")).alias("_r"), F.lit(None).cast(left.schema.simpleString()).alias("_l"))
    l = left.select(*by, F.col(time).alias("_t"), F.lit(None).cast(r.schema["_r"].dataType).alias("_r"), F.struct(*[F.col(c) for c in left.columns]).alias("_l"))  # noqa: E741
    w = Window.partitionBy(*by).orderBy("_t")
    x = r.unionByName(l)
    x = x.withColumn("_a", F.last("_r", ignorenulls=True).over(w)).withColumn("_b", F.first("_r", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing)))
    x = x.where("_l IS NOT NULL")
    a, b = F.abs(F.col("_t") - F.col("_a.t")), F.abs(F.col("_b.t") - F.col("_t"))
    pick = F.when(F.col("_a").isNull(), F.col("_b.i")).when(F.col("_b").isNull(), F.col("_a.i")).when(a < b, F.col("_a.i")).when(b < a, F.col("_b.i")).otherwise(F.least("_a.i", "_b.i"))
    return x.select("_l.*", pick.alias(f"nearest_{ident}"))


def within_tolerance(left: DataFrame, right: DataFrame, by: list[str], left_time: Column, right_time: Column, tolerance: float) -> DataFrame:
    """Pairs whose times differ by less than tolerance: a right row is put into its time cell and both neighbours."""
    l = left.withColumn("_tl", left_time).withColumn("_cell", F.floor(F.col("_tl") / tolerance))  # noqa: E741
    r = right.withColumn("_tr", right_time).withColumn("_cell", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor(F.col("_tr") / tolerance) + k)))
    return l.join(r, [*by, "_cell"]).where(F.abs(F.col("_tl") - F.col("_tr")) < tolerance).drop("_cell", "_tl", "_tr")


def snapped(time: Column, interval: float, most: float = 0.01) -> tuple[Column, Column]:
    """The nearest multiple of interval (half to even), and whether it is nearer than the part most of the interval."""
    t = F.rint(time / interval) * interval
    return t, F.abs(time - t) < most * interval


def compared_runs(a: DataFrame, b: DataFrame, step: str, value: str, order: str) -> DataFrame:
    """Values of two runs side by side; of a step logged twice the last counts, a step of one run only has a null."""
    last = lambda df, name: df.groupBy(step).agg(F.max_by(value, order).alias(name))
    return last(a, "a").join(last(b, "b"), step, "full_outer").withColumn("difference", F.col("a") - F.col("b"))


def located(rows: DataFrame, starts: DataFrame, number: str, span: int = 1024) -> DataFrame:
    """(episode, local row) of global row numbers. starts: episode_index, start, length. Joined by blocks of span numbers."""
    s = starts.where("length > 0").withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / span), F.floor((F.col("start") + F.col("length") - 1) / span))))
    x = rows.withColumn("_cell", F.floor(F.col(number) / span)).join(s, "_cell").where((F.col(number) >= F.col("start")) & (F.col(number) < F.col("start") + F.col("length")))
    return x.withColumn("local_row", F.col(number) - F.col("start")).drop("_cell", "start", "length")


#: A key is hot that holds more than 1 / HOT_KEYS of all rows, so fewer than HOT_KEYS keys are; one of up to LEAST_HOT rows never is.
HOT_KEYS, LEAST_HOT = 1000, 100_000


def may_be_hot(total: int) -> bool:
    """Whether any key can be hot among so many rows."""
    return total > LEAST_HOT


def spread(large: DataFrame, keyed: DataFrame, on: list[str], counted: str, total: int) -> DataFrame:
    """Inner join of large with keyed, which has one row a key, no hot key in one task.

    counted is the number of large's rows with the key (dropped), total the number of all rows. The rows of hot keys (fewer than
    HOT_KEYS keys, whatever the data) meet a broadcast where they lie; only the others are shuffled. Null keys match nothing.
    """
    if not may_be_hot(total):
        return large.join(keyed.drop(counted), on)
    limit = max(total // HOT_KEYS, LEAST_HOT)
    hot = F.broadcast(keyed.where(F.col(counted) > limit))
    cold = keyed.where(F.col(counted) <= limit).drop(counted)
    rest = large.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return large.join(hot.drop(counted), on).unionByName(rest.join(cold, on))
