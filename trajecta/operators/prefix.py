"""Running sums over pseudorandom order without putting a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 256


def hashed_prefix_sum(df: DataFrame, by: list[str], ident: str, value: Column, seed: int, out: str) -> DataFrame:
    """Adds out: the sum of value over the rows of the same group before this one, in the order of a seeded hash of ident.

    The hash range is cut into PARTS; their totals (at most PARTS rows a group) give the base to which each part adds its own
    running sum. Rows with equal ident and hash are ordered arbitrarily; ident should be unique in its group.
    """
    h = F.xxhash64(F.col(ident), F.lit(seed))
    x = df.withColumn("_h", h).withColumn("_part", F.shiftrightunsigned("_h", 56)).withColumn("_v", value)
    totals = x.groupBy(*by, "_part").agg(F.sum("_v").alias("_t"))
    base = totals.withColumn("_base", F.coalesce(F.sum("_t").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")
    inner = Window.partitionBy(*by, "_part").orderBy("_h", ident).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_in", F.coalesce(F.sum("_v").over(inner), F.lit(0))).join(base, [*by, "_part"])
    return x.withColumn(out, F.col("_base") + F.col("_in")).drop("_h", "_part", "_v", "_base", "_in")


def running(df: DataFrame, bucket: Column, order: list, outs: dict[str, tuple[str, str]], upto_row: bool = True) -> DataFrame:
    """Running totals over the whole table without a one-task sort of it.

    bucket must not fall along order; only one total per bucket goes through a global window, rows are sorted within buckets.
    outs: name -> (column, "sum" | "min"); upto_row includes the row itself (else sums of the rows before, 0 or null at the first).
    """
    fold = {"sum": F.sum, "min": F.min}
    x = df.withColumn("_b", bucket)
    totals = x.groupBy("_b").agg(*[fold[f](c).alias(f"_t{k}") for k, (c, f) in enumerate(outs.values())])
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_b", *[fold[f](f"_t{k}").over(before).alias(f"_p{k}") for k, (_, f) in enumerate(outs.values())])
    inner = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if upto_row else -1)
    x = x.join(base, "_b")
    for k, (name, (c, f)) in enumerate(outs.items()):
        own = fold[f](c).over(inner)
        x = x.withColumn(name, F.coalesce(F.col(f"_p{k}"), F.lit(0)) + F.coalesce(own, F.lit(0)) if f == "sum" else F.least(F.col(f"_p{k}"), own))
    return x.drop("_b", *[f"_p{k}" for k in range(len(outs))])
