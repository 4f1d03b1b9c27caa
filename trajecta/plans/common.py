"""What the query modules share: the registry, views of the tables as episodes of steps, and rounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajecta.operators import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a query, with the SQL that gives the same rows."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(x: Column | str, digits: int = 4) -> Column:
    """Rounded, without a negative zero."""
    return F.round(x, digits) + F.lit(0.0)


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as episodes of a user, in order of time."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("episode_index"), "event_id", "ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k"), F.col("event_type").alias("label"))
    return windows.indexed(e, "episode_index", ["ts", "event_id"])


STEPS = """steps AS (
  SELECT user_id AS episode_index, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_index,
         CAST(count(*) OVER (PARTITION BY user_id) AS BIGINT) AS length, event_id, ts, value,
         CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE) AS k, event_type AS label
  FROM events)"""


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as episodes of an order, with four numbers as a packed vector."""
    x = table(spark, sf_dir, "lineitem").withColumn("state", F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return windows.indexed(x, "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"])


def once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """episodes, each once: its first export."""
    return table(spark, sf_dir, "episodes").groupBy("episode_index").agg(*[F.min_by(c, F.struct("exported_at", "length")).alias(c) for c in ("dataset_path", "tasks", "length", "success")])


ONCE = """once AS (
  SELECT episode_index, dataset_path, tasks, length, success FROM (
    SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY exported_at, length) AS rn FROM episodes) WHERE rn = 1)"""
