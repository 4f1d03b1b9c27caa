"""Percentiles per group with a guaranteed relative error, from counts in signed logarithmic buckets.

A reading v > 0 falls into bucket i = ceil(ln v / ln g), g = (1 + a) / (1 - a); the bucket's value 2 g^i / (g + 1) is within
the share a of every reading in it. Negative readings have mirrored buckets, zero has its own. Counts of the same bucket add
up over partitions and days, so sketches made apart merge without loss. A percentile is the linear interpolation between the
two neighbouring order statistics, each within the share a of the true one. So it is within the share a of the true percentile where
both have the same sign; where they lie on both sides of zero, the true percentile may be anything between them, and the error is
within the share a of the larger of their sizes.

Defined cases: each (episode_index, frame_index) counts once, the first ingested; nulls, NaN and infinities aren't counted;
a group without finite readings gives no row; a null dataset_path or recorded_at is a group or day of its own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajecta.functions.packing import Block, bucket_count, packed, per_bucket

FIELDS = (("cartesian_position", 6), ("gripper_position", 1), ("joint_position", 7), ("joint_velocity", 7))
RELATIVE_ERROR = 0.005
QUANTILES = {"median": 0.5, "q01": 0.01, "q99": 0.99}
#: Added to |bucket number|, so that the sign of a code is the sign of its readings and codes sort as readings do.
OFFSET = 1 << 20
NO_DAY = -(1 << 20)
SKETCH = "dataset_path string, feature_key string, dim bigint, day date, bucket int, cnt bigint"


def log_base(error: float) -> float:
    return math.log((1 + error) / (1 - error))


def bucket_codes(v: np.ndarray, error: float) -> np.ndarray:
    """Codes of finite readings."""
    a = np.abs(v)
    i = np.ceil(np.log(np.where(a > 0, a, 1)) / log_base(error)).astype("i8") + OFFSET
    return np.where(v > 0, i, np.where(v < 0, -i, 0))


def bucket_value(code: Column, error: float) -> Column:
    """The reading that a code stands for."""
    g = (1 + error) / (1 - error)
    size = F.exp((F.abs(code) - OFFSET) * log_base(error)) * 2 / (g + 1)
    return F.when(code == 0, 0.0).otherwise(F.signum(code.cast("double")) * size)


def _sketch(error: float, by_day: bool):
    def run(b: Block) -> Iterator:
        import pyarrow as pa

        codes, names = b.s[0]
        days = b.i[:, 0] if by_day else np.full(len(b.ep), NO_DAY)
        c = 0
        for name, width in FIELDS:
            for dim in range(width):
                v = b.m[:, c]
                c += 1
                at = np.flatnonzero(np.isfinite(v))
                if not len(at):
                    continue
                key = ((codes[at].astype("i8") << 21 | days[at] - NO_DAY) << 22) + bucket_codes(v[at], error) + (OFFSET << 1)
                key, cnt = np.unique(key, return_counts=True)
                day = (key >> 22 & (1 << 21) - 1) + NO_DAY
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[k] for k in key >> 43], pa.string()), pa.array([name] * len(key)), pa.array(np.full(len(key), dim, "i8")), pa.array(day.astype("i4"), mask=day == NO_DAY).cast(pa.date32()),
                    pa.array(((key & (1 << 22) - 1) - (OFFSET << 1)).astype("i4")), pa.array(cnt.astype("i8")),
                ], names=[z.split()[0] for z in SKETCH.split(", ")])

    return run


def merge(sketches: DataFrame, by: tuple[str, ...] = ("dataset_path", "feature_key", "dim")) -> DataFrame:
    """One sketch per group of by, of any sketches made apart."""
    return sketches.groupBy(*by, "bucket").agg(F.sum("cnt").alias("cnt"))


def sketch(frames: DataFrame, error: float = RELATIVE_ERROR, by_day: bool = False) -> DataFrame:
    """Bucket counts of each dataset, feature and dim, of each day of recorded_at if by_day."""
    buckets = bucket_count(frames, frames.count())
    order = F.unix_micros(F.col("ingested_at").cast("timestamp"))
    rows = frames.withColumn("_day", F.coalesce(F.unix_date(F.col("recorded_at").cast("date")), F.lit(NO_DAY)))
    parts = per_bucket(packed(rows, [*FIELDS], ["_day"], ["dataset_path"], order, buckets), buckets, _sketch(error, by_day), SKETCH)
    return merge(parts, ("dataset_path", "feature_key", "dim", "day"))


def percentiles(merged: DataFrame, error: float = RELATIVE_ERROR, by: tuple[str, ...] = ("dataset_path", "feature_key", "dim")) -> DataFrame:
    """Percentiles of each group's sketch; a group has at most some thousand buckets, whatever its rows."""
    w = Window.partitionBy(*by)
    x = merged.withColumn("_to", F.sum("cnt").over(w.orderBy("bucket"))).withColumn("_n", F.sum("cnt").over(w)).withColumn("_value", bucket_value(F.col("bucket"), error))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_to") - F.col("cnt")) & (rank < F.col("_to")), F.col("_value")))

    def quantile(q: float) -> Column:
        rank = F.lit(q) * (F.col("_n") - 1)
        part = F.max(rank - F.floor(rank))
        return at(F.floor(rank)) * (1 - part) + at(F.ceil(rank)) * part

    return x.groupBy(*by).agg(F.max("_n").alias("n"), *[quantile(q).alias(k) for k, q in QUANTILES.items()]).withColumn("relative_error", F.lit(error))
