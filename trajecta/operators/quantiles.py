"""Exact quantiles that scale: counts in fine buckets first, then the values of the deciding buckets alone.

A value falls into a signed logarithmic bucket of relative width WIDTH; buckets sort as values do. Counts per (group, bucket) combine
before the shuffle, and a group has at most some 300,000 buckets whatever its rows. They tell which buckets hold the wanted ranks; of
those, distinct values are counted in a second pass, so no group's values ever lie in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajecta.session import materialize

#: Relative width of a bucket.
WIDTH = 0.01
#: Deciding buckets (at most two a group and quantile) that are broadcast to the second pass, about 100 bytes each; with more, it is a shuffle join.
BROADCAST_BUCKETS = 200_000
_INF = 1 << 40


def bucket(value: Column) -> Column:
    """Number of a value's bucket, rising with the value; null for null and NaN."""
    size = F.abs(value)
    code = F.when(size == float("inf"), F.lit(_INF)).otherwise(F.floor(F.log(size) / WIDTH) + F.lit(1 << 21))
    return F.when(value == 0, F.lit(0).cast("long")).when(value > 0, code).otherwise(-code)


def _same(a: DataFrame, b: DataFrame, on: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[f"_k_{c}"]) for c in on])


def with_quantiles(values: DataFrame, by: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """One row per group with any value: by, n, mean, std (population), min, max and the quantiles, interpolated between neighbours.

    Nulls and NaN aren't counted; a null in by is a group. values is read twice.
    """
    v = values.select(*by, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)").withColumn("_b", bucket(F.col("_v")))
    m2 = F.coalesce(F.var_pop("_v") * F.count("*"), F.lit(0.0))
    cells = v.groupBy(*by, "_b").agg(F.count("*").alias("_n"), F.avg("_v").alias("_mean"), m2.alias("_m2"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    group = Window.partitionBy(*by)
    x = cells.withColumn("n", F.sum("_n").over(group)).withColumn("mean", F.sum(F.col("_n") * F.col("_mean")).over(group) / F.col("n"))
    x = x.withColumn("_to", F.sum("_n").over(group.orderBy("_b"))).withColumn("_from", F.col("_to") - F.col("_n"))
    off = F.col("_mean") - F.col("mean")
    ranks = [r for q in quantiles.values() for r in (F.floor(F.lit(q) * (F.col("n") - 1)), F.ceil(F.lit(q) * (F.col("n") - 1)))]
    here = [(r >= F.col("_from")) & (r < F.col("_to")) for r in ranks]
    hit = F.collect_list(F.when(reduce(lambda a, b: a | b, here), F.struct("_b", "_from")))
    sums = x.groupBy(*by).agg(F.max("n").alias("n"), F.max("mean").alias("mean"), F.sqrt(F.sum(F.col("_m2") + F.col("_n") * off * off) / F.max("n")).alias("std"), F.min("_lo").alias("min"), F.max("_hi").alias("max"), hit.alias("_hits"))
    sums = materialize(sums, "quantile-sums")
    wanted = sums.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("n").alias("_count"), F.explode("_hits").alias("_h")).select("*", F.col("_h._b").alias("_k__b"), F.col("_h._from").alias("_base")).drop("_h")
    if wanted.count() <= BROADCAST_BUCKETS:
        wanted = F.broadcast(wanted)
    counted = v.join(wanted, _same(v, wanted, [*by, "_b"]))
    counted = counted.groupBy(*by, "_b", "_base", "_count", "_v").agg(F.count("*").alias("_n"))
    to = F.col("_base") + F.sum("_n").over(Window.partitionBy(*by, "_b").orderBy("_v"))
    counted = counted.withColumn("_to", to).withColumn("_from", F.col("_to") - F.col("_n"))
    at = lambda rank: F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v")))
    found = []
    for name, q in quantiles.items():
        rank = F.lit(q) * (F.col("_count") - 1)
        part = F.max(rank - F.floor(rank))
        low, high = at(F.floor(rank)), at(F.ceil(rank))
        found.append(F.when(low == high, low).otherwise(low + part * (high - low)).alias(name))
    picked = counted.groupBy(*by).agg(*found)
    picked = picked.select(*[F.col(c).alias(f"_k_{c}") for c in by], *quantiles)
    out = sums.drop("_hits")
    return (out.join(picked, _same(out, picked, by)) if by else out.crossJoin(picked)).select(*by, "n", "mean", "std", "min", "max", *quantiles)
