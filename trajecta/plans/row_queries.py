"""Queries of filters, joins, windows, shards and sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from trajecta.functions.text import low_hash
from trajecta.operators import filters, joins, sampling, shards, windows
from trajecta.operators.prefix import running
from trajecta.plans.common import ONCE, STEPS, once, query, r, steps, table

# filters

_REWARD = "CASE WHEN label = 'purchase' AND value > 60 THEN value ELSE 0 END"


@query("success_filter", f"WITH {STEPS} SELECT episode_index, frame_index, event_id FROM steps s WHERE EXISTS (SELECT 1 FROM steps t WHERE t.episode_index = s.episode_index AND {_REWARD} <> 0)")
def success_filter(spark, d):
    s = steps(spark, d).withColumn("reward", F.expr(_REWARD))
    return filters.successful(s, "episode_index", "reward").select("episode_index", "frame_index", "event_id")


_SLOTS = ["language_instruction", "language_instruction_2", "language_instruction_3"]


@query("language_filter_documented", "SELECT annotation_id, count(*) AS n FROM annotations WHERE length(language_instruction) > 1 OR length(language_instruction_2) > 1 OR length(language_instruction_3) > 1 GROUP BY 1")
def language_filter_documented(spark, d):
    return filters.with_language(table(spark, d, "annotations"), "annotation_id", _SLOTS).groupBy("annotation_id").agg(F.count("*").alias("n"))


@query(
    "language_filter_strict",
    "WITH t AS (SELECT annotation_id, unnest([language_instruction, language_instruction_2, language_instruction_3]) AS x FROM annotations), f AS (SELECT x, min(annotation_id) AS annotation_id FROM t WHERE length(x) > 1 GROUP BY 1)"
    " SELECT annotation_id, count(*) AS n FROM annotations WHERE annotation_id IN (SELECT annotation_id FROM f) GROUP BY 1",
)
def language_filter_strict(spark, d):
    return filters.with_language(table(spark, d, "annotations"), "annotation_id", _SLOTS, "strict").groupBy("annotation_id").agg(F.count("*").alias("n"))


#: Ranges of every episode by its length, the second over a part of the first.
_RANGES = "ranges AS (SELECT episode_index, o AS ordinal, CASE o WHEN 0 THEN length // 2 ELSE length // 8 END AS lo, CASE o WHEN 0 THEN length * 3 // 4 ELSE (length * 5 + 7) // 8 END AS hi FROM (SELECT DISTINCT episode_index, length, unnest([0, 1]) AS o FROM steps))"


def _ranges(s):
    x = s.select("episode_index", "length").distinct().withColumn("ordinal", F.explode(F.array(F.lit(0), F.lit(1))))
    return x.select("episode_index", "ordinal", F.expr("CASE ordinal WHEN 0 THEN length div 2 ELSE length div 8 END AS start"), F.expr("CASE ordinal WHEN 0 THEN length * 3 div 4 ELSE (length * 5 + 7) div 8 END AS end"))


@query("idle_range_filter", f"WITH {STEPS}, {_RANGES} SELECT episode_index, frame_index, ordinal, CAST(row_number() OVER (PARTITION BY episode_index ORDER BY ordinal, frame_index) - 1 AS BIGINT) AS new_frame FROM steps JOIN ranges USING (episode_index) WHERE frame_index >= lo AND frame_index < hi")
def idle_range_filter(spark, d):
    s = steps(spark, d)
    return filters.within_ranges(s, _ranges(s), "episode_index", "frame_index").select("episode_index", "frame_index", "ordinal", "new_frame")


@query("all_idle_filter", "SELECT episode_index, count(*) AS n FROM episodes WHERE tasks IS NOT NULL AND len(tasks) > 0 GROUP BY 1")
def all_idle_filter(spark, d):
    return filters.without_idle(table(spark, d, "episodes").withColumn("kept", F.coalesce("tasks", F.array().cast("array<string>"))), "kept").groupBy("episode_index").agg(F.count("*").alias("n"))


@query("discard_antijoin", "SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')")
def discard_antijoin(spark, d):
    bad = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return filters.discarded(table(spark, d, "orders"), bad, ["o_orderkey"]).select("o_orderkey")


@query("step_filter_diff", f"WITH {STEPS} SELECT episode_index, frame_index FROM steps EXCEPT SELECT episode_index, frame_index FROM steps WHERE label = 'error'")
def step_filter_diff(spark, d):
    s = steps(spark, d).select("episode_index", "frame_index", "label")
    return filters.discarded(s, s.where("label = 'error'"), ["episode_index", "frame_index"]).select("episode_index", "frame_index")


@query("allowed_starts", f"WITH {STEPS} SELECT episode_index, frame_index FROM steps WHERE frame_index <= length - 24")
def allowed_starts(spark, d):
    return filters.allowed_starts(steps(spark, d), "episode_index", "frame_index", 24).select("episode_index", "frame_index")


@query("long_enough", f"WITH {STEPS} SELECT episode_index, count(*) AS n FROM steps WHERE length >= 61 GROUP BY 1")
def long_enough(spark, d):
    return filters.long_enough(steps(spark, d), "episode_index", 60).groupBy("episode_index").agg(F.count("*").alias("n"))


# joins


@query("task_lookup", "SELECT episode_index, frame_index, task, count(*) AS n FROM frames JOIN (SELECT DISTINCT task_index, task FROM tasks) USING (task_index) GROUP BY ALL")
def task_lookup(spark, d):
    t = table(spark, d, "tasks").select("task_index", "task").distinct()
    x = joins.looked_up(table(spark, d, "frames").select("episode_index", "frame_index", "task_index"), t, "task_index", "task")
    return x.groupBy("episode_index", "frame_index", "task").agg(F.count("*").alias("n"))


@query("task_lookup_default", "SELECT o_orderkey, coalesce(c_name, '') AS c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey")
def task_lookup_default(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.looked_up(table(spark, d, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey", "c_name", default="").select("o_orderkey", "c_name")


@query("text_encode", "SELECT event_id, id FROM events JOIN (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS BIGINT) AS id FROM (SELECT DISTINCT event_type FROM events)) USING (event_type)")
def text_encode(spark, d):
    from trajecta.operators import stats

    e = table(spark, d, "events").select("event_id", "event_type")
    return e.join(stats.dictionary_sorted(e, "event_type"), "event_type").select("event_id", "id")


#: Intervals of every episode by its length; frames from a half to three fifths are in none.
_INTERVALS = "intervals AS (SELECT episode_index, o AS ordinal, [-5, length // 5, length // 6, NULL, length * 3 // 5][o + 1] AS lo, [length // 4, length // 2, length * 2 // 5, length, 9999][o + 1] AS hi, ['reach', 'grasp', 'lift', 'never', 'rest'][o + 1] AS name FROM (SELECT DISTINCT episode_index, length, unnest(range(5)) AS o FROM steps))"


@query("interval_label", f"WITH {STEPS}, {_INTERVALS}, h AS (SELECT s.episode_index, s.frame_index, arg_max(name, ordinal) AS name FROM steps s JOIN intervals i ON s.episode_index = i.episode_index AND s.frame_index >= greatest(lo, 0) AND s.frame_index < least(hi, length) AND lo IS NOT NULL GROUP BY ALL) SELECT episode_index, frame_index, coalesce(name, 'N/A') AS name FROM steps LEFT JOIN h USING (episode_index, frame_index)")
def interval_label(spark, d):
    s = steps(spark, d).select("episode_index", "frame_index", "length")
    bounds = {"start": "-5L, length div 5, length div 6, CAST(NULL AS BIGINT), length * 3 div 5", "end": "length div 4, length div 2, length * 2 div 5, length, 9999L", "name": "'reach', 'grasp', 'lift', 'never', 'rest'"}
    i = s.select("episode_index", "length").distinct().withColumn("ordinal", F.explode(F.sequence(F.lit(0), F.lit(4))))
    i = i.select("episode_index", "ordinal", *[F.expr(f"array({x})[ordinal]").alias(n) for n, x in bounds.items()])
    return joins.interval_labels(s, i, "episode_index", "frame_index", "name").select("episode_index", "frame_index", "name")


_TIMES = "e AS (SELECT event_id, user_id, epoch_us(ts) AS t, event_type FROM events)"


def _times(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_type")


@query("nearest_timestamp", f"WITH {_TIMES}, p AS (SELECT a.event_id, b.event_id AS other, abs(a.t - b.t) AS dt FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase') SELECT event_id, nearest_other FROM (SELECT event_id, other AS nearest_other, row_number() OVER (PARTITION BY event_id ORDER BY dt, other) AS rn FROM p) WHERE rn = 1 UNION ALL SELECT event_id, NULL FROM e WHERE event_type = 'click' AND user_id NOT IN (SELECT user_id FROM e WHERE event_type = 'purchase')")
def nearest_timestamp(spark, d):
    e = _times(spark, d)
    right = e.where("event_type = 'purchase'").select("user_id", "t", F.col("event_id").alias("other"))
    return joins.nearest(e.where("event_type = 'click'").select("event_id", "user_id", "t"), right, ["user_id"], "t", "other").select("event_id", "nearest_other")


@query("tolerance_match", f"WITH {_TIMES} SELECT a.event_id AS left_id, b.event_id AS right_id FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'error' AND abs(a.t - b.t) < 3600000000")
def tolerance_match(spark, d):
    e = _times(spark, d)
    a = e.where("event_type = 'click'").select(F.col("event_id").alias("left_id"), "user_id", F.col("t").alias("ta"))
    b = e.where("event_type = 'error'").select(F.col("event_id").alias("right_id"), "user_id", F.col("t").alias("tb"))
    return joins.within_tolerance(a, b, ["user_id"], F.col("ta"), F.col("tb"), 3_600_000_000).select("left_id", "right_id")


@query("snap_to_grid", "SELECT event_id, round(CAST(round_even(value / 0.25, 0) AS DOUBLE) * 0.25, 4) + 0.0 AS snapped, abs(value - CAST(round_even(value / 0.25, 0) AS DOUBLE) * 0.25) < 0.0125 AS near FROM events")
def snap_to_grid(spark, d):
    t, ok = joins.snapped(F.col("value"), 0.25, 0.05)
    return table(spark, d, "events").select("event_id", r(t).alias("snapped"), ok.alias("near"))


@query("row_location", f"WITH {STEPS}, l AS (SELECT episode_index, max(length) AS length FROM steps GROUP BY 1), c AS (SELECT episode_index, length, sum(length) OVER (ORDER BY episode_index) - length AS start FROM l) SELECT event_id, episode_index, CAST(event_id - start AS BIGINT) AS local_row FROM events JOIN c ON event_id >= start AND event_id < start + length")
def row_location(spark, d):
    l = steps(spark, d).groupBy("episode_index").agg(F.count("*").alias("length"))  # noqa: E741
    s = running(l, F.floor(F.col("episode_index") / 4096), ["episode_index"], {"start": ("length", "sum")}, upto_row=False)
    return joins.located(table(spark, d, "events").select("event_id"), s, "event_id").select("event_id", "episode_index", "local_row")


@query("prediction_join", f"WITH {STEPS}, p AS (SELECT event_id, avg(value) OVER (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS prediction FROM steps) SELECT label, count(*) AS n, round(avg((prediction - value) * (prediction - value)), 4) + 0.0 AS mse FROM steps JOIN p USING (event_id) GROUP BY label")
def prediction_join(spark, d):
    s = steps(spark, d)
    p = s.select("event_id", windows.trailing_mean(["episode_index"], "frame_index", "value", 4).alias("prediction"))
    e = F.col("prediction") - F.col("value")
    return s.join(p, "event_id").groupBy("label").agg(F.count("*").alias("n"), r(F.avg(e * e)).alias("mse"))


@query("step_union", "SELECT event_id // 10 AS step FROM events WHERE event_type = 'click' UNION SELECT event_id // 12 FROM events WHERE event_type = 'error'")
def step_union(spark, d):
    e = table(spark, d, "events")
    return e.where("event_type = 'click'").selectExpr("event_id div 10 AS step").union(e.where("event_type = 'error'").selectExpr("event_id div 12")).distinct()


@query("dataset_union", "SELECT 'tasks' AS source, CAST(task_index AS BIGINT) AS id, task AS text, CAST(NULL AS VARCHAR) AS annotator FROM tasks UNION ALL SELECT 'annotations', annotation_id, language_instruction, annotator FROM annotations")
def dataset_union(spark, d):
    a = table(spark, d, "tasks").select(F.lit("tasks").alias("source"), F.col("task_index").alias("id"), F.col("task").alias("text"))
    b = table(spark, d, "annotations").select(F.lit("annotations").alias("source"), F.col("annotation_id").alias("id"), F.col("language_instruction").alias("text"), "annotator")
    return a.unionByName(b, allowMissingColumns=True)


# windows


@query("frame_index", f"WITH {STEPS} SELECT episode_index, frame_index, length, event_id, round(sum(value) OVER (PARTITION BY episode_index ORDER BY frame_index), 2) + 0.0 AS total FROM steps")
def frame_index(spark, d):
    w = Window.partitionBy("episode_index").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
    return steps(spark, d).select("episode_index", "frame_index", "length", "event_id", r(F.sum("value").over(w), 2).alias("total"))


@query("dense_reindex", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS new_index FROM orders WHERE o_orderstatus = 'F'")
def dense_reindex(spark, d):
    x = table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", F.lit(1).cast("long").alias("one"))
    return running(x, F.floor(F.col("o_orderkey") / 4096), ["o_orderkey"], {"new_index": ("one", "sum")}, upto_row=False).select("o_orderkey", "new_index")


def _gather_sql(deltas: list[int], padding: str) -> str:
    at = f"least(greatest(s.frame_index + o.d, 0), s.length - 1)"
    value = "t.value" if padding == "first_last" else "CASE WHEN s.frame_index + o.d BETWEEN 0 AND s.length - 1 THEN t.value ELSE 0.0 END"
    offsets = ", ".join(f"({k}, {d})" for k, d in enumerate(deltas))
    return f"WITH {STEPS}, o(place, d) AS (VALUES {offsets}), g AS (SELECT s.event_id, o.place, {value} AS v FROM steps s JOIN o ON true JOIN steps t ON t.episode_index = s.episode_index AND t.frame_index = {at}) SELECT event_id, " + ", ".join(f"max(CASE WHEN place = {k} THEN v END) AS v{k}" for k in range(len(deltas))) + " FROM g GROUP BY 1"


def _gather(spark, d, deltas, padding):
    x = windows.gathered(steps(spark, d), "value", deltas, padding)
    return x.select("event_id", *[F.get("window", F.lit(k)).alias(f"v{k}") for k in range(len(deltas))])


@query("gather_first_last", _gather_sql([0, 1, 2, 3], "first_last"))
def gather_first_last(spark, d):
    return _gather(spark, d, [0, 1, 2, 3], "first_last")


@query("gather_zero", _gather_sql([-1, 0, 1], "zero"))
def gather_zero(spark, d):
    return _gather(spark, d, [-1, 0, 1], "zero")


@query("gather_sparse_deltas", _gather_sql([-23, -16, -8, 0], "first_last"))
def gather_sparse_deltas(spark, d):
    return _gather(spark, d, [-23, -16, -8, 0], "first_last")


@query("needed_frames", f"WITH {STEPS}, n AS (SELECT DISTINCT episode_index, frame_index + d AS needed FROM (SELECT *, unnest([-8, 0, 8]) AS d FROM steps WHERE frame_index <= length - 8) WHERE frame_index + d >= 0 AND frame_index + d < length) SELECT episode_index, needed, CAST(row_number() OVER (PARTITION BY episode_index ORDER BY needed) - 1 AS BIGINT) AS place FROM n")
def needed_frames(spark, d):
    deltas = [-8, 0, 8]
    return windows.needed_frames(filters.allowed_starts(steps(spark, d), "episode_index", "frame_index", max(deltas)), deltas)


#: Most anchors of a start, the reference's max_chunk_size.
_MOST = 5
#: Long runs of one label: the coarse label of a step is its stretch of 60 frames, doubled for every third user.
_COARSE = "CASE WHEN episode_index % 3 = 0 THEN 0 ELSE frame_index // 60 END"
_ANCHORS = f"""{STEPS}, c AS (SELECT episode_index, frame_index, length, CAST({_COARSE} AS BIGINT) AS coarse, frame_index % 24 AS lane FROM steps),
n AS (SELECT *, CASE WHEN coarse IS DISTINCT FROM lag(coarse) OVER (PARTITION BY episode_index, lane ORDER BY frame_index) THEN 1 ELSE 0 END AS new FROM c),
i AS (SELECT *, sum(new) OVER (PARTITION BY episode_index, lane ORDER BY frame_index) AS island FROM n),
p AS (SELECT a.episode_index, a.frame_index AS first, b.frame_index AS anchor, a.length, (b.frame_index - a.frame_index) // 24 AS k
      FROM i a JOIN i b ON a.episode_index = b.episode_index AND a.lane = b.lane AND a.island = b.island AND b.frame_index + 23 < b.length),
q AS (SELECT *, row_number() OVER (PARTITION BY episode_index, first ORDER BY CASE WHEN k < 0 THEN -2 * k - 1 ELSE 2 * k END) AS rk FROM p),
anchors AS (SELECT episode_index, first, anchor, length, CAST(row_number() OVER (PARTITION BY episode_index, first ORDER BY anchor) - 1 AS BIGINT) AS number, CAST(count(*) OVER (PARTITION BY episode_index, first) AS BIGINT) AS anchors, max(anchor) OVER (PARTITION BY episode_index, first) + 24 < length AS more FROM q WHERE rk <= {_MOST})"""


def _anchors(spark, d):
    s = steps(spark, d).withColumn("coarse", F.when(F.col("episode_index") % 3 == 0, F.lit(0)).otherwise(F.floor(F.col("frame_index") / 60)))
    return s, windows.chunk_anchors(s, "coarse", _MOST)


@query("chunk_anchors_video", f"WITH {_ANCHORS} SELECT episode_index, first, anchor, number, anchors FROM anchors")
def chunk_anchors_video(spark, d):
    return _anchors(spark, d)[1]


@query("chunk_frames_video", f"WITH {_ANCHORS}, f AS (SELECT episode_index, first, anchor + o AS frame_index, number, anchors, more, o FROM (SELECT *, unnest([0, 3, 6, 9, 12, 15, 18, 21, 24]) AS o FROM anchors)) SELECT episode_index, first, frame_index FROM f WHERE (more OR anchors > 1) AND (CASE WHEN number < anchors - 1 THEN o < 24 WHEN more THEN true ELSE o = 0 END)")
def chunk_frames_video(spark, d):
    s, a = _anchors(spark, d)
    return windows.video_frames(a, s)


@query("chunk_state_action", f"WITH {_ANCHORS}, a AS (SELECT * FROM anchors WHERE more OR number < anchors - 1), x AS (SELECT a.episode_index, a.first, a.number, s.frame_index - a.anchor AS pos, s.value - t.value AS relative FROM a JOIN steps s ON s.episode_index = a.episode_index AND s.frame_index BETWEEN a.anchor AND a.anchor + 23 JOIN steps t ON t.episode_index = a.episode_index AND t.frame_index = a.anchor) SELECT episode_index, first, number, count(*) AS rows_in, round(sum(relative), 2) + 0.0 AS total, round(max(relative), 4) + 0.0 AS most FROM x GROUP BY ALL")
def chunk_state_action(spark, d):
    s, a = _anchors(spark, d)
    c = windows.action_anchors(a, s).withColumn("pos", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn("frame_index", F.col("anchor") + F.col("pos"))
    c = c.join(s.select("episode_index", "frame_index", "value"), ["episode_index", "frame_index"])
    c = windows.relative_to_first(c, "value", "value", ["episode_index", "first", "number"], "pos")
    return c.groupBy("episode_index", "first", "number").agg(F.count("*").alias("rows_in"), r(F.sum("relative"), 2).alias("total"), r(F.max("relative")).alias("most"))


@query("relative_to_absolute", f"WITH {STEPS} SELECT event_id, round(value, 4) + 0.0 AS a, round(k, 4) + 0.0 AS b FROM steps")
def relative_to_absolute(spark, d):
    s = steps(spark, d).withColumn("state", F.array(F.col("value") / 2, F.col("k") / 2))
    s = s.withColumn("relative", F.array(F.zip_with(F.array("value", "k"), "state", lambda a, b: a - b)))
    back = windows.absolute(F.col("relative"), F.col("state"))
    return s.select("event_id", r(back[0][0]).alias("a"), r(back[0][1]).alias("b"))


@query("frame_schedule", "SELECT o_orderkey, CAST(a AS BIGINT) AS anchor, CAST(greatest(a - 23, 0) AS BIGINT) AS first_frame, CAST(greatest(a - 8, 0) AS BIGINT) AS third_frame FROM (SELECT o_orderkey, unnest(generate_series(23, o_orderkey % 100 + 10 - 1, 24)) AS a FROM orders)")
def frame_schedule(spark, d):
    x = table(spark, d, "orders").select("o_orderkey", F.explode(windows.schedule(F.col("o_orderkey") % 100 + 10)).alias("w"))
    return x.select("o_orderkey", F.get("w", F.lit(3)).alias("anchor"), F.get("w", F.lit(0)).alias("first_frame"), F.get("w", F.lit(2)).alias("third_frame"))


@query("strided_starts", "SELECT o_orderkey, CAST(s AS BIGINT) AS start FROM (SELECT o_orderkey, o_orderkey % 100 AS n, unnest([0, 16, 32, 48, 64]) AS s FROM orders) WHERE s < n")
def strided_starts(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.explode(windows.strided_starts(F.col("o_orderkey") % 100, 16)).alias("start"))


@query("sequential_split", "WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i, count(*) OVER () AS c FROM orders) SELECT o_orderkey, CASE WHEN i <= CAST(floor(0.7 * c) AS BIGINT) THEN 'train' WHEN i <= CAST(floor(0.7 * c) AS BIGINT) + CAST(floor(0.2 * c) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM n")
def sequential_split(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return windows.sequential_split(o, "o_orderkey", [("train", 0.7), ("validation", 0.2), ("test", 0.1)], o.count())


@query("threshold_trigger", f"WITH {STEPS}, t AS (SELECT *, sum(k) OVER (PARTITION BY episode_index ORDER BY frame_index) AS total FROM steps), f AS (SELECT *, floor(total / 500) <> floor(coalesce(lag(total) OVER (PARTITION BY episode_index ORDER BY frame_index), 0.0) / 500) AS fired FROM t) SELECT episode_index, frame_index, CAST(total AS BIGINT) AS total FROM f WHERE fired")
def threshold_trigger(spark, d):
    w = Window.partitionBy("episode_index").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
    x = steps(spark, d).withColumn("total", F.sum("k").over(w))
    x = x.withColumn("fired", windows.crossings(x, ["episode_index"], "frame_index", "total", 500.0))
    return x.where("fired").select("episode_index", "frame_index", F.col("total").cast("long").alias("total"))


@query("call_triggers", f"WITH {STEPS} SELECT event_id, (frame_index + 1) % 10 = 0 AS tenth, frame_index % 10 = 0 AS tenth_from_first, row_number() OVER (PARTITION BY episode_index, label ORDER BY frame_index) <= 1 AS once, row_number() OVER (PARTITION BY episode_index, label ORDER BY frame_index) <= 3 AS thrice FROM steps")
def call_triggers(spark, d):
    times = lambda n: windows.first_times(["episode_index", "label"], ["frame_index"], n)
    return steps(spark, d).select("event_id", windows.every(F.col("frame_index"), 10).alias("tenth"), windows.every(F.col("frame_index"), 10, True).alias("tenth_from_first"), times(1).alias("once"), times(3).alias("thrice"))


@query(
    "relative_action_keys",
    f"WITH {STEPS}, c AS (SELECT *, frame_index // 24 * 24 AS anchor, (frame_index // 24 + 1) * 24 <= length AS whole FROM steps)"
    " SELECT a.episode_index, a.frame_index, round(CASE WHEN whole THEN a.value - s.k ELSE a.value END, 4) + 0.0 AS arm, round(a.k, 4) + 0.0 AS gripper, round(2 * a.value, 4) + 0.0 AS hand FROM c a JOIN steps s ON s.episode_index = a.episode_index AND s.frame_index = a.anchor",
)
def relative_action_keys(spark, d):
    """Action keys made relative chunk by chunk: arm is; gripper isn't chosen and hand has no state, so they stay."""
    rows = F.array_sort(F.collect_list(F.struct("frame_index", F.array("value").alias("arm"), F.array("k").alias("gripper"), F.array(F.col("value") * 2).alias("hand"))))
    e = steps(spark, d).groupBy("episode_index").agg(rows.alias("rows"))
    part = lambda k: F.transform("rows", lambda x: x[k])
    states = {"arm": part("gripper"), "gripper": part("gripper")}
    actions = {k: part(k) for k in ("arm", "gripper", "hand")}
    anchors = part("frame_index")
    for k in windows.relative_keys(list(actions), list(states), ["arm", "hand"]):
        actions[k] = windows.relative_chunks(actions[k], states[k], anchors)
    x = e.select("episode_index", F.posexplode(F.arrays_zip(*[v.alias(k) for k, v in actions.items()])).alias("frame_index", "a"))
    return x.select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), *[r(F.col(f"a.{k}")[0]).alias(k) for k in actions])


@query("synthesized_times", f"WITH {STEPS} SELECT event_id, round(CASE WHEN episode_index % 2 = 0 THEN frame_index / 15.0 ELSE value END, 4) + 0.0 AS t FROM steps")
def synthesized_times(spark, d):
    x = steps(spark, d).withColumn("t0", F.when(F.col("episode_index") % 2 == 0, 0.0).otherwise(F.col("value")))
    return x.select("event_id", r(windows.synthesized_times("episode_index", "t0", "frame_index", 15.0)).alias("t"))


# shards and sampling

_LENGTHS = f"{ONCE}, l AS (SELECT episode_index, coalesce(length, 0) AS length, CAST(row_number() OVER (ORDER BY episode_index) - 1 AS BIGINT) AS j, CAST(sum(coalesce(length, 0)) OVER (ORDER BY episode_index) AS BIGINT) AS c, CAST(sum(coalesce(length, 0)) OVER () AS BIGINT) AS t FROM once WHERE episode_index IS NOT NULL), g AS (SELECT *, (t + 999) // 1000 AS n, greatest((c * ((t + 999) // 1000) + t - 1) // t - 1, 0) AS g FROM l), x AS (SELECT *, least(j + 1, j + min(g - j) OVER (ORDER BY j)) AS nx FROM g), shards AS (SELECT episode_index, length, CAST(coalesce(lag(nx) OVER (ORDER BY j), 0) AS BIGINT) AS shard, CAST(n AS BIGINT) AS planned FROM x)"


def _shards(spark, d):
    e = once(spark, d).where("episode_index IS NOT NULL").select("episode_index", F.coalesce("length", F.lit(0)).alias("length"))
    return shards.balanced_shards(e, 1000)


@query("balanced_shards", f"WITH {_LENGTHS} SELECT * FROM shards")
def balanced_shards(spark, d):
    return _shards(spark, d)


@query("shard_report", f"WITH {_LENGTHS}, s AS (SELECT shard, sum(length) AS steps, count(*) AS episodes FROM shards GROUP BY 1) SELECT count(*) AS shards, CAST(max(steps) AS BIGINT) AS most_steps, CAST(min(steps) AS BIGINT) AS least_steps, max(episodes) AS most_episodes FROM s")
def shard_report(spark, d):
    return shards.shard_report(_shards(spark, d))


@query("chunk_check", f"WITH {ONCE}, c AS (SELECT CAST(floor(episode_index / 1000) AS BIGINT) AS chunk, count(*) AS episodes FROM once GROUP BY 1) SELECT chunk, episodes, episodes = 1000 OR chunk = (SELECT max(chunk) FROM c) AS as_expected FROM c")
def chunk_check(spark, d):
    return shards.chunk_check(once(spark, d))


_SIZES = f"{ONCE}, z AS (SELECT dataset_path, embodiment_tag, CAST(sum(coalesce(length, 0)) AS BIGINT) AS n, count(*) AS episodes FROM once JOIN datasets USING (dataset_path) GROUP BY ALL)"


def _sizes(spark, d):
    x = once(spark, d).join(table(spark, d, "datasets").select("dataset_path", "embodiment_tag"), "dataset_path")
    return x.groupBy("dataset_path", "embodiment_tag").agg(F.sum(F.coalesce("length", F.lit(0))).alias("n"), F.count("*").alias("episodes"))


_WEIGHT = "CASE WHEN embodiment_tag = 'arm7_lab' THEN 1.0 ELSE 0.5 END"


@query("mixture_weights", f"WITH {_SIZES}, w AS (SELECT *, {_WEIGHT} AS weight FROM z) SELECT dataset_path, round(weight * n / sum(weight * n) OVER (), 6) + 0.0 AS share, weight = 1.0 AS is_primary, round(weight * n / sum(n) OVER (PARTITION BY embodiment_tag), 6) + 0.0 AS weight_part FROM w")
def mixture_weights(spark, d):
    x = sampling.dataset_weights(_sizes(spark, d).withColumn("weight", F.expr(_WEIGHT).cast("double")), "weight", "n", True)
    x = sampling.distributed_weights(x, "embodiment_tag", "weight", "n")
    return x.select("dataset_path", r("share", 6).alias("share"), F.col("primary").alias("is_primary"), r("weight_part", 6).alias("weight_part"))


@query("trajectory_weights", f"WITH {ONCE}, w AS (SELECT episode_index, dataset_path, CASE WHEN success IS NOT DISTINCT FROM false THEN 0.0 ELSE 1.0 + coalesce(length, 0) END AS w FROM once) SELECT episode_index, round(w / sum(w) OVER (PARTITION BY dataset_path), 8) + 0.0 AS share FROM w")
def trajectory_weights(spark, d):
    x = once(spark, d).withColumn("kept", 1 + F.coalesce("length", F.lit(0)))
    x = sampling.trajectory_weights(x, "dataset_path", "kept", ~F.coalesce("success", F.lit(True)))
    return x.select("episode_index", r("share", 8).alias("share"))


@query("epoch_length", f"WITH {_SIZES}, w AS (SELECT *, {_WEIGHT} * n / sum({_WEIGHT} * n) OVER () AS share FROM z) SELECT 'training' AS kind, CAST(floor(sum(n * share)) AS BIGINT) AS epoch_length FROM w UNION ALL SELECT 'evaluation', CAST(sum(n) AS BIGINT) FROM w")
def epoch_length(spark, d):
    x = sampling.dataset_weights(_sizes(spark, d).withColumn("weight", F.expr(_WEIGHT).cast("double")), "weight", "n", True)
    a, b = (sampling.epoch_length(x, "share", "n", t).select(F.lit(k).alias("kind"), "epoch_length") for t, k in ((True, "training"), (False, "evaluation")))
    return a.unionByName(b)


@query("shard_schedule_eval", f"WITH {_LENGTHS}, n AS (SELECT max(shard) + 1 AS n FROM shards) SELECT CAST(i AS BIGINT) AS position, CAST(i % n AS BIGINT) AS shard FROM n, (SELECT unnest(range(1000)) AS i)")
def shard_schedule_eval(spark, d):
    n = _shards(spark, d).agg(F.max("shard") + 1).head()[0]
    return spark.range(1000).select(F.col("id").alias("position"), F.pmod("id", F.lit(n)).alias("shard"))


@query("worker_split", "SELECT CAST(i AS BIGINT) AS position, CAST(i % 12 // 3 AS BIGINT) AS rank, CAST(i % 3 AS BIGINT) AS worker FROM (SELECT unnest(range(1000)) AS i)")
def worker_split(spark, d):
    x = shards.worker_share(spark.range(1000).withColumnRenamed("id", "position"), "position", 4, 3)
    return x.select("position", "rank", F.col("worker").cast("long").alias("worker"))


@query("hash_sample", "WITH h AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY sha256(concat_ws(',', CAST(event_id AS VARCHAR), '5'))) AS rn FROM events) SELECT event_id, user_id FROM h WHERE rn <= 10")
def hash_sample(spark, d):
    """The sampling operator: the first int(100 * 0.1) rows of each user in seeded hash order."""
    return sampling.part_of_each(table(spark, d, "events"), "user_id", "event_id", 5, 0.1, 100).select("event_id", "user_id")


@query("hash_bits", "SELECT event_id, substring(sha256(CAST(event_id AS VARCHAR)), 33, 32) AS low_bits, md5(props) AS digest FROM events")
def hash_bits(spark, d):
    return table(spark, d, "events").select("event_id", low_hash(F.col("event_id")).alias("low_bits"), F.md5("props").alias("digest"))


@query(
    "weighted_draws",
    f"WITH {_SIZES}, c AS (SELECT dataset_path, n / sum(n) OVER () AS share, sum(n) OVER (ORDER BY dataset_path) / sum(n) OVER () AS high FROM z), u AS (SELECT CAST(('0x' || substr(sha256('0,' || CAST(i AS VARCHAR) || ',3'), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496.0 AS u FROM (SELECT unnest(range(10000)) AS i))"
    " SELECT dataset_path, count(*) AS draws, round(max(share), 9) AS share FROM u JOIN c ON u >= high - share AND u < high GROUP BY 1",
)
def weighted_draws(spark, d):
    """10 000 draws of datasets by weight: how often each came beside its share."""
    x = sampling.dataset_weights(_sizes(spark, d).withColumn("weight", F.lit(1.0)), "weight", "n", True)
    got = sampling.drawn(10_000, sampling.cumulative(x.select("dataset_path", "share"), "dataset_path", "share"), 3)
    return got.groupBy("dataset_path").agg(F.count("*").alias("draws"), r(F.max("share"), 9).alias("share"))


@query("derangement", "WITH h AS (SELECT event_id, user_id, sha256(CAST(event_id AS VARCHAR) || ',1') AS h FROM events), p AS (SELECT event_id, coalesce(lead(event_id) OVER w, first_value(event_id) OVER w) AS partner FROM h WINDOW w AS (PARTITION BY user_id ORDER BY h)) SELECT event_id, partner FROM p WHERE event_id <> partner")
def derangement(spark, d):
    return sampling.derangement(table(spark, d, "events"), ["user_id"], "event_id", 1).select("event_id", "partner")
