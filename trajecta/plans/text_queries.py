"""Queries of text functions, sources and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajecta.functions import text
from trajecta.operators import validate
from trajecta.plans.common import STEPS, once, query, steps, table
from trajecta.session import scratch
from trajecta.sources import datasets
from trajecta.streaming import sessions

_TEXTS = "SELECT DISTINCT task_index, task FROM tasks"
_CLASS = r"[^\p{L}\p{N}_\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _tasks(spark, d):
    return table(spark, d, "tasks").select("task_index", "task").distinct()


@query("formalize_text", f"SELECT task_index, regexp_replace(lower(task), '{_CLASS}', '', 'g') AS task FROM ({_TEXTS})")
def formalize_text(spark, d):
    return _tasks(spark, d).select("task_index", text.formalized(F.col("task")).alias("task"))


#: White space of Unicode, for the SQL.
_WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


@query("whitespace_clean", f"SELECT doc_id, trim(regexp_replace(text, '{_WS}+', ' ', 'g')) AS text FROM documents")
def whitespace_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", text.single_spaced(F.col("text")).alias("text"))


@query("remove_prefix", "SELECT doc_id, list_last(string_split(text, ': ')) AS text FROM documents")
def remove_prefix(spark, d):
    return table(spark, d, "documents").select("doc_id", text.without_prefix(F.col("text")).alias("text"))


@query("marker_flags", f"WITH t AS (SELECT task_index, CASE task_index % 4 WHEN 0 THEN '<LAPA>' WHEN 1 THEN '<DREAM> ' ELSE '' END || coalesce(task, '') AS x FROM tasks) SELECT DISTINCT task_index, contains(x, '<LAPA>') AS lapa, contains(x, '<DREAM>') AS dream, contains(x, '<COTRAIN>') AS cotrain, regexp_replace(replace(replace(x, '<LAPA>', ''), '<DREAM>', ''), '^{_WS}+|{_WS}+$', '', 'g') AS rest FROM t")
def marker_flags(spark, d):
    mark = F.when(F.col("task_index") % 4 == 0, "<LAPA>").when(F.col("task_index") % 4 == 1, "<DREAM> ").otherwise("")
    x = table(spark, d, "tasks").withColumn("x", F.concat(mark, F.coalesce("task", F.lit(""))))
    return x.select("task_index", *[c.alias(n) for n, c in text.marker_flags(F.col("x")).items()], text.without_markers(F.col("x")).alias("rest")).distinct()


_TEMPLATES = {"arm7_lab": "Seven joints: {}", "arm6_bench": "Six joints: {} Go slowly.", "bimanual_cart": "Both arms: {}", "mobile_rail": "{} (rail)"}


@query("prompt_template", "SELECT dataset_path, CASE embodiment_tag WHEN 'arm7_lab' THEN 'Seven joints: ' || codebase_version WHEN 'arm6_bench' THEN 'Six joints: ' || codebase_version || ' Go slowly.' WHEN 'bimanual_cart' THEN 'Both arms: ' || codebase_version ELSE codebase_version || ' (rail)' END AS prompt FROM datasets")
def prompt_template(spark, d):
    return table(spark, d, "datasets").select("dataset_path", text.prompt(F.col("embodiment_tag"), F.col("codebase_version"), _TEMPLATES).alias("prompt"))


@query("literal_list", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN 'don''t ' || p_name WHEN 2 THEN 'the \"' || p_name || '\"' ELSE p_name END AS first FROM part")
def literal_list(spark, d):
    """List literals with either kind of quotes, apostrophes and escapes within them, and plain texts."""
    n = F.col("p_name")
    kinds = [n, F.concat(F.lit('["don\'t '), n, F.lit("\", 'other']")), F.concat(F.lit("[ 'the \""), n, F.lit("\"' ]")), F.concat(F.lit("['"), n, F.lit("', \"it's\"]"))]
    x = F.when(F.col("p_partkey") % 4 == 0, kinds[0]).when(F.col("p_partkey") % 4 == 1, kinds[1]).when(F.col("p_partkey") % 4 == 2, kinds[2]).otherwise(kinds[3])
    return table(spark, d, "part").select("p_partkey", text.first_of_literal(x).alias("first"))


def _hash_part(what: str) -> str:
    return f"CAST(('0x' || substr(sha256(CAST(annotation_id AS VARCHAR) || ',3,{what}'), 1, 13)) AS BIGINT)::DOUBLE / 4503599627370496.0"


@query(
    "language_choice",
    "WITH s AS (SELECT annotation_id, annotator, list_filter([language_instruction, language_instruction_2, language_instruction_3], lambda x: length(x) > 1) AS t FROM annotations)"
    f" SELECT DISTINCT annotation_id, CASE WHEN len(t) < 1 OR {_hash_part('dropout')} < 0.1 THEN 'not provided' WHEN annotator IS NULL THEN t[1] ELSE t[CAST(floor({_hash_part('key')} * len(t)) AS BIGINT) + 1] END AS training, CASE WHEN len(t) < 1 THEN 'not provided' ELSE t[1] END AS evaluation FROM s",
)
def language_choice(spark, d):
    """In training one of the three instruction slots by hash (the first, where no annotator is known), a tenth of them the default; in evaluation the first."""
    slots = F.filter(F.array("language_instruction", "language_instruction_2", "language_instruction_3"), lambda x: F.length(x) > 1)
    key = F.col("annotation_id").cast("string")
    pick = lambda training: text.chosen(slots, key, "not provided", 3, 0.1, training, F.col("annotator").isNotNull())
    return table(spark, d, "annotations").select("annotation_id", pick(True).alias("training"), pick(False).alias("evaluation")).distinct()


@query("task_instruction", "SELECT p_partkey, coalesce(nullif(CASE WHEN p_size > 25 THEN p_name ELSE '' END, ''), p_type) || '.' || p_brand AS instruction FROM part")
def task_instruction(spark, d):
    x = text.task_instruction(F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(""), F.col("p_type"), F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", x.alias("instruction"))


@query("path_template", "SELECT DISTINCT episode_index, printf('data/chunk-%03d/episode_%06d.parquet', episode_index // 1000, episode_index) AS path FROM episodes")
def path_template(spark, d):
    return table(spark, d, "episodes").select("episode_index", text.episode_path(F.col("episode_index")).alias("path")).distinct()


@query("json_parse", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS BIGINT) END AS k FROM events")
def json_parse(spark, d):
    x = F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", text.json_or_empty(x, "k bigint")["k"].alias("k"))


@query("map_remap", "SELECT event_id, 'cam_' || CAST(user_id % 3 + 1 AS VARCHAR) AS camera FROM events")
def map_remap(spark, d):
    m = F.create_map(F.concat(F.lit("cam_"), (F.col("user_id") % 3).cast("string")), F.col("value"))
    moved = F.transform_keys(m, lambda k, v: F.concat(F.lit("cam_"), (F.substring_index(k, "_", -1).cast("int") + 1).cast("string")))
    return table(spark, d, "events").select("event_id", F.get(F.map_keys(moved), F.lit(0)).alias("camera"))


@query("collated", f"WITH {STEPS} SELECT episode_index, CAST(frame_index // 16 AS BIGINT) AS batch, count(*) AS rows_in, round(sum(value), 2) + 0.0 AS total FROM steps GROUP BY ALL")
def collated(spark, d):
    x = steps(spark, d).groupBy("episode_index", F.floor(F.col("frame_index") / 16).alias("batch")).agg(F.collect_list("value").alias("v"))
    return x.select("episode_index", "batch", F.size("v").cast("long").alias("rows_in"), (F.round(F.aggregate("v", F.lit(0.0), lambda a, b: a + b), 2) + F.lit(0.0)).alias("total"))


@query("rate_parse", "SELECT * FROM (VALUES ('15/1', CAST(15 AS DOUBLE)), ('30000/1001', 29.97), ('24', 24.0), ('5/0', NULL), ('fast', NULL)) t(x, fps)")
def rate_parse(spark, d):
    x = spark.createDataFrame([("15/1",), ("30000/1001",), ("24",), ("5/0",), ("fast",)], "x string")
    return x.select("x", F.round(text.rate(F.col("x")), 2).alias("fps"))


@query(
    "readable_counts",
    "WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice / 10) * 10 AS BIGINT) * CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END AS n FROM orders), g AS (SELECT *, least(CAST(ceil(length(CAST(n AS VARCHAR)) / 3) AS INT), 5) AS g FROM o),"
    " v AS (SELECT *, n::DOUBLE * [1.0::DOUBLE, 1e-3::DOUBLE, 1e-6::DOUBLE, 1e-9::DOUBLE, 1e-12::DOUBLE][g] AS v FROM g)"
    " SELECT o_orderkey, printf('%d', CAST(floor(v) AS BIGINT)) || CASE WHEN v - floor(v) > 0.01 THEN ltrim(printf('%.2f', v - floor(v)), '0') ELSE '' END || ' ' || [' ', 'K', 'M', 'B', 'T'][g] AS readable FROM v",
)
def readable_counts(spark, d):
    size = F.when(F.col("o_orderkey") % 3 == 0, 1).when(F.col("o_orderkey") % 3 == 1, 1000).otherwise(1_000_000)
    return table(spark, d, "orders").select("o_orderkey", text.readable_count((F.floor(F.col("o_totalprice") / 10) * 10).cast("long") * size).alias("readable"))


@query("scientific_strings", "SELECT event_id, CASE WHEN k = 0 THEN '0' ELSE replace(printf('%.1e', k::DOUBLE / 8192), 'e-0', 'e-') END AS shown FROM (SELECT event_id, event_id % 50 AS k FROM events)")
def scientific_strings(spark, d):
    return table(spark, d, "events").select("event_id", text.scientific((F.col("event_id") % 50).cast("double") / 8192).alias("shown"))


@query("frame_estimate", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity WHEN l_tax > 0 THEN floor(l_tax * 1000.0) ELSE 0 END AS BIGINT) AS frames FROM lineitem")
def frame_estimate(spark, d):
    """Frames of a probe, estimated from duration and rate where it counts none."""
    counted = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("long"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.frame_estimate(counted, F.col("l_tax"), F.lit(1000.0)).alias("frames"))


@query("encoded_names", "SELECT event_id, base64(CAST(event_type AS BLOB)) AS encoded, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events")
def encoded_names(spark, d):
    return table(spark, d, "events").select("event_id", F.base64(F.col("event_type").cast("binary")).alias("encoded"), F.date_format("ts", "yyyyMMdd_HHmmss").alias("stamp"))


@query("pattern_filter", "SELECT dataset_path FROM datasets WHERE dataset_path LIKE 'data/%arm%/%' AND dataset_path NOT LIKE '%/night_*%' AND dataset_path NOT LIKE '%/bench_sorting'")
def pattern_filter(spark, d):
    x = table(spark, d, "datasets").select("dataset_path")
    inside = datasets.glob_column(F.col("dataset_path"), "data/*arm*/*")
    out = datasets.glob_column(F.col("dataset_path"), "*/night_[*]*") | datasets.glob_column(F.col("dataset_path"), "*/bench_sorting")
    return x.where(inside & ~out)


@query("mixture_paths", "SELECT embodiment_tag AS tag, dataset_path AS path FROM datasets WHERE dataset_path LIKE 'data/bimanual_cart/laundry%' OR dataset_path = 'data/arm7_lab/quarry_bins'")
def mixture_paths(spark, d):
    known = [(x.embodiment_tag, x.dataset_path) for x in table(spark, d, "datasets").select("embodiment_tag", "dataset_path").collect()]
    spec = {"bimanual_cart": ["data/bimanual_cart/laundry*/"], "arm7_lab": ["data/arm7_lab/quarry_bins"]}
    return spark.createDataFrame(datasets.mixture_paths(spec, [p for _, p in known], {t for t, _ in known}), "tag string, path string")


@query("html_unescape", "SELECT p_partkey, '<b> ' || p_name || ' é!' AS name FROM part")
def html_unescape(spark, d):
    x = F.concat(F.lit("&amp;lt;b&amp;gt; "), F.col("p_name"), F.lit(" &eacute;&#33; "))
    return table(spark, d, "part").select("p_partkey", text.html_unescaped(x).alias("name"))


#: Tokens of a text, as the reference's configuration has it.
_WIDTH = 512


@query(
    "tokenize",
    "WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w FROM documents)"
    f" SELECT doc_id, CAST(len(w) AS BIGINT) AS words, CAST(least(len(w), {_WIDTH}) AS BIGINT) AS n, {_WIDTH} AS width, md5(array_to_string(w, ' ')) AS words_md5, md5(array_to_string(list_resize(w, {_WIDTH}, ''), ' ')) AS tokens_md5 FROM w",
)
def tokenize(spark, d):
    """Count and hash of all words, and the padded tokens (as a hash) with the length of their mask."""
    words = text.white_space_words(F.col("text"))
    tokens, mask = text.white_space_tokens(F.col("text"), _WIDTH)
    joined = lambda x: F.md5(F.array_join(x, " ").cast("binary"))
    return table(spark, d, "documents").select(
        "doc_id", F.size(words).cast("long").alias("words"), F.size(F.filter(mask, lambda m: m)).cast("long").alias("n"), F.size(tokens).alias("width"), joined(words).alias("words_md5"), joined(tokens).alias("tokens_md5")
    )


# sources and sinks: what is written is what is read back


@query("write_read_frames", "SELECT CAST(floor(episode_index / 1000) AS BIGINT) AS episode_chunk, count(*) AS n, count(DISTINCT episode_index) AS episodes FROM frames GROUP BY 1")
def write_read_frames(spark, d):
    at = scratch(spark, "frames")
    datasets.write_frames(table(spark, d, "frames"), at)
    x = datasets.read_frames(spark, at)
    return x.groupBy(F.col("episode_chunk").cast("long").alias("episode_chunk")).agg(F.count("*").alias("n"), F.count_distinct("episode_index").alias("episodes"))


@query("episode_lookup", "SELECT frame_index, count(*) AS copies FROM frames WHERE episode_index = 7 GROUP BY 1")
def episode_lookup(spark, d):
    """One episode by its number: the point lookup."""
    return datasets.read_episode(table(spark, d, "frames"), 7).groupBy("frame_index").agg(F.count("*").alias("copies"))


@query("json_lines", "SELECT episode_index, CAST(length AS BIGINT) AS length, CAST(len(tasks) AS BIGINT) AS n_tasks FROM (SELECT episode_index, length, tasks, row_number() OVER (PARTITION BY episode_index ORDER BY exported_at, length) AS rn FROM episodes) WHERE rn = 1")
def json_lines(spark, d):
    at = scratch(spark, "lines")
    datasets.write_lines(once(spark, d).select("episode_index", "tasks", "length"), at)
    x = datasets.read_lines(spark, at, "episode_index bigint, tasks array<string>, length bigint, success boolean")
    return x.select("episode_index", "length", F.when(F.col("tasks").isNotNull(), F.size("tasks")).cast("long").alias("n_tasks"))


@query("nested_steps", f"WITH {STEPS} SELECT episode_index, CAST(length AS INT) AS _len, CAST(frame_index AS INT) AS _frame_index, label FROM steps")
def nested_steps(spark, d):
    x = steps(spark, d).groupBy("episode_index").agg(F.array_sort(F.collect_list(F.struct("frame_index", "label"))).alias("steps"))
    return datasets.nested_steps(x, "steps", ["episode_index"]).select("episode_index", "_len", "_frame_index", "label")


@query("set_comparison", "SELECT true AS same_after_parquet, true AS same_after_json, true AS part, false AS reverse, count(*) AS n FROM episodes")
def set_comparison(spark, d):
    """Nested rows written to two formats and read back, compared with what was written, whole and in part."""
    e = table(spark, d, "episodes").select("episode_index", F.struct("dataset_path", "length", F.struct("tasks", "success").alias("of")).alias("nested"))
    at = scratch(spark, "nested")
    e.write.parquet(f"{at}/parquet")
    e.write.option("ignoreNullFields", "false").json(f"{at}/json")
    a, b = spark.read.parquet(f"{at}/parquet"), spark.read.schema(e.schema).json(f"{at}/json")
    part = a.where("nested.length > 50")
    return spark.createDataFrame([(validate.same_rows(e, a), validate.same_rows(e, b), validate.is_part_of(part, e), validate.is_part_of(e, part), a.count())], "same_after_parquet boolean, same_after_json boolean, part boolean, reverse boolean, n bigint")


# sessions: events of a user as messages of a channel, three at a time under one session id, now and then null or a reset

_MESSAGES = """m AS (SELECT CAST(user_id AS VARCHAR) AS channel, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS seq,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE ['a', 'b'][CAST(floor(extract(day FROM ts)) AS BIGINT) % 2 + 1] END AS session_id,
    CASE WHEN event_id % 11 = 0 THEN 'reset' ELSE 'infer' END AS endpoint, value AS frame FROM events)"""
_RUNS = f"""{_MESSAGES}, k AS (SELECT *, last_value(session_id IGNORE NULLS) OVER (PARTITION BY channel ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM m),
n AS (SELECT *, CASE WHEN seq = 1 OR endpoint = 'reset' OR (session_id IS NOT NULL AND session_id IS DISTINCT FROM known) THEN 1 ELSE 0 END AS new FROM k),
u AS (SELECT *, CAST(sum(new) OVER (PARTITION BY channel ORDER BY seq) AS BIGINT) AS run FROM n),
runs AS (SELECT *, CAST(row_number() OVER (PARTITION BY channel, run ORDER BY seq) - 1 AS BIGINT) AS turn FROM u)"""


def messages(spark, d):
    from pyspark.sql import Window

    e = table(spark, d, "events")
    name = F.when(F.dayofmonth("ts") % 2 == 0, "a").otherwise("b")
    return e.select(
        F.col("user_id").cast("string").alias("channel"), F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long").alias("seq"), F.when(F.col("event_id") % 7 != 0, name).alias("session_id"), F.when(F.col("event_id") % 11 == 0, "reset").otherwise("infer").alias("endpoint"), F.col("value").alias("frame")
    )


@query("session_runs", f"WITH {_RUNS} SELECT channel, seq, run, turn FROM runs")
def session_runs(spark, d):
    return sessions.session_runs(messages(spark, d), "channel", ["seq"], "session_id", "endpoint").select("channel", "seq", "run", "turn")


_BUFFERS = f"WITH {_RUNS}, f AS (SELECT *, first_value(frame) OVER w AS f0, lag(frame, 1) OVER w AS f1, lag(frame, 2) OVER w AS f2, lag(frame, 3) OVER w AS f3 FROM runs WINDOW w AS (PARTITION BY channel, run ORDER BY seq)) SELECT channel, seq, CASE WHEN turn = 0 THEN 1 ELSE 4 END AS n, CASE WHEN turn = 0 THEN frame ELSE coalesce(f3, f0) END AS oldest, CASE WHEN turn = 0 THEN NULL ELSE coalesce(f1, f0) END AS third FROM f"


def _buffer_columns(x):
    return x.select("channel", "seq", F.size("buffer").alias("n"), F.get("buffer", F.lit(0)).alias("oldest"), F.get("buffer", F.lit(2)).alias("third"))


@query("frame_buffer", _BUFFERS)
def frame_buffer(spark, d):
    x = sessions.session_runs(messages(spark, d), "channel", ["seq"], "session_id", "endpoint")
    return _buffer_columns(sessions.frame_buffer(x, "channel", ["seq"], "frame"))


@query("frame_buffer_stream", _BUFFERS)
def frame_buffer_stream(spark, d):
    """The same through a stream with state, over files."""
    at = scratch(spark, "sessions")
    messages(spark, d).repartition(3, "channel").write.parquet(f"{at}/in")
    x = spark.readStream.schema("channel string, seq bigint, session_id string, endpoint string, frame double").parquet(f"{at}/in")
    q = sessions.stream_sessions(x).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return _buffer_columns(spark.read.schema(sessions.OUT).parquet(f"{at}/out"))


@query("open_loop_replay", f"WITH {STEPS}, c AS (SELECT *, frame_index % 8 AS kk, lead(value, 0) OVER w AS v FROM steps WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)) SELECT event_id, kk = 0 AS asks, value AS action, CASE WHEN value > 0.5 THEN 1.0 ELSE 0.0 END AS gripper FROM c")
def open_loop_replay(spark, d):
    from pyspark.sql import Window

    s = steps(spark, d)
    w = Window.partitionBy("episode_index", F.floor(F.col("frame_index") / 8)).orderBy("frame_index").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("chunk", F.collect_list("value").over(w))
    asks, action = sessions.replayed(F.col("frame_index"), F.col("chunk"))
    return s.select("event_id", asks.alias("asks"), action.alias("action"), F.when(action > 0.5, 1.0).otherwise(0.0).alias("gripper"))


@query("message_defaults", f"WITH {_MESSAGES} SELECT channel, seq, coalesce(session_id, '') AS session_id, coalesce(CASE WHEN endpoint = 'reset' THEN NULL ELSE frame END, 0.0) AS frame FROM m")
def message_defaults(spark, d):
    x = messages(spark, d).withColumn("frame", F.when(F.col("endpoint") != "reset", F.col("frame")))
    return x.na.fill({"session_id": "", "frame": 0.0}).select("channel", "seq", "session_id", "frame")
