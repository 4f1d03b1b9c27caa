"""Queries on packed vectors and normalization."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajecta.functions import normalize, rotations, vectors
from trajecta.operators import stats, transforms
from trajecta.plans.common import STEPS, packed, query, r, steps, table
from trajecta.sources import datasets

V = "SELECT vec_id, CAST(d - 1 AS BIGINT) AS dim, CAST(embedding[d] AS DOUBLE) AS value, label FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS d FROM embeddings)"


def _values(spark, d):
    x = stats.tall(table(spark, d, "embeddings"), ["vec_id", "label"], ["embedding"])
    return x.select("vec_id", "label", F.col("dim").cast("long").alias("dim"), "value")


@query("vector_slice", f"SELECT vec_id, dim - 3 AS dim, round(value, 6) + 0.0 AS value FROM ({V}) WHERE dim >= 3 AND dim < 6")
def vector_slice(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", F.posexplode(vectors.slice_of(F.col("embedding").cast("array<double>"), 3, 6)).alias("dim", "value"))
    return x.select("vec_id", F.col("dim").cast("long").alias("dim"), r("value", 6).alias("value"))


_PARTS = [("cartesian_position", 6), ("gripper_position", 1), ("joint_position", 7)]


@query(
    "vector_concat_offsets",
    "WITH c AS (SELECT list_concat(list_concat(cartesian_position, [gripper_position]), joint_position) AS s FROM frames WHERE cartesian_position IS NOT NULL AND joint_position IS NOT NULL),"
    " u AS (SELECT CAST(d AS BIGINT) AS dim, s[d + 1] AS v FROM (SELECT s, unnest(range(len(s))) AS d FROM c))"
    " SELECT dim, CASE WHEN dim < 6 THEN 'cartesian_position' WHEN dim < 7 THEN 'gripper_position' ELSE 'joint_position' END AS part, count(v) AS n FROM u GROUP BY dim",
)
def vector_concat_offsets(spark, d):
    f = table(spark, d, "frames")
    state = vectors.stacked(F.col("cartesian_position"), vectors.as_vector(F.col("gripper_position")), F.col("joint_position"))
    x = f.select(F.posexplode(state).alias("dim", "v")).groupBy("dim").agg(F.count("v").alias("n"))
    part = F.lit(None).cast("string")
    for name, a, b in vectors.slice_catalog(_PARTS):
        part = F.when((F.col("dim") >= a) & (F.col("dim") < b), name).otherwise(part)
    return x.select(F.col("dim").cast("long").alias("dim"), part.alias("part"), "n")


@query("slice_catalog", "SELECT embodiment_tag, feature_key, CAST(start_pos AS BIGINT) AS start_pos, CAST(end_pos AS BIGINT) AS end_pos, end_pos - start_pos AS width FROM modality")
def slice_catalog(spark, d):
    m = table(spark, d, "modality")
    return m.select("embodiment_tag", "feature_key", "start_pos", "end_pos", (F.col("end_pos") - F.col("start_pos")).alias("width"))


@query("horizontal_stack", "SELECT l_orderkey, l_linenumber, round(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE), 2) + 0.0 AS a, round(CAST(CAST(l_tax AS FLOAT) AS DOUBLE), 4) + 0.0 AS b, 0.0 AS c FROM lineitem")
def horizontal_stack(spark, d):
    v = F.concat(F.array("l_quantity"), vectors.velocity_pair(F.array("l_tax"))).cast("array<float>").cast("array<double>")
    return packed(spark, d).select("l_orderkey", "l_linenumber", r(F.get(v, F.lit(0)), 2).alias("a"), r(F.get(v, F.lit(1))).alias("b"), F.get(v, F.lit(2)).alias("c"))


@query("concat_roundtrip", "SELECT count(*) AS n, 0 AS differing FROM lineitem")
def concat_roundtrip(spark, d):
    x = packed(spark, d).withColumns({"a": F.array("l_quantity", "l_tax"), "b": F.array("l_discount")}).withColumns({"a0": F.col("a"), "b0": F.col("b")})
    step = transforms.Concat([("a", 2), ("b", 1)], "ab")
    y = step.unapply(step.apply(x))
    return y.agg(F.count("*").alias("n"), F.sum(((F.col("a") != F.col("a0")) | (F.col("b") != F.col("b0"))).cast("int")).cast("int").alias("differing"))


@query("pad_and_mask", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(d AS BIGINT) AS dim, CASE WHEN d < 4 THEN [l_quantity, l_extendedprice, l_discount, l_tax][d + 1] ELSE 0.0 END AS value, d < 4 AS is_real FROM (SELECT *, unnest(range(6)) AS d FROM lineitem)")
def pad_and_mask(spark, d):
    x = packed(spark, d)
    both = F.arrays_zip(vectors.padded(F.col("state"), 6).alias("value"), vectors.pad_mask(F.col("state"), 6).alias("is_real"))
    x = x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.posexplode(both).alias("dim", "v"))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("dim").cast("long").alias("dim"), "v.value", "v.is_real")


@query("pad_strictly", "SELECT l_orderkey, l_linenumber, l_quantity AS first, 0.0 AS last, 8 AS width FROM lineitem")
def pad_strictly(spark, d):
    v = vectors.padded_strictly(F.col("state"), 8)
    return packed(spark, d).select("l_orderkey", "l_linenumber", F.get(v, F.lit(0)).alias("first"), F.get(v, F.lit(7)).alias("last"), F.size(v).alias("width"))


@query("nested_fields", "SELECT event_id, CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS BIGINT) AS k, CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS BIGINT) + 1 AS next_k FROM events")
def nested_fields(spark, d):
    s = F.from_json("props", "k bigint")
    return table(spark, d, "events").withColumn("p", F.struct(s.alias("props"))).withColumn("p", F.col("p").withField("props.next_k", F.col("p.props.k") + 1)).select("event_id", F.col("p.props.k").alias("k"), F.col("p.props.next_k").alias("next_k"))


@query("struct_of_arrays", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax, CAST(count(*) OVER (PARTITION BY l_orderkey) AS BIGINT) AS rows_in FROM lineitem")
def struct_of_arrays(spark, d):
    x = packed(spark, d).groupBy("l_orderkey").agg(*[F.collect_list(c).alias(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax")])
    z = vectors.rows_of(**{c: F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax")})
    return x.select("l_orderkey", F.size("l_tax").cast("long").alias("rows_in"), F.inline(z))


@query("chunk_equal", f"WITH {STEPS} SELECT episode_index, frame_index, CAST(ntile(5) OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS BIGINT) AS chunk FROM steps")
def chunk_equal(spark, d):
    from pyspark.sql import Window

    return steps(spark, d).select("episode_index", "frame_index", (F.ntile(5).over(Window.partitionBy("episode_index").orderBy("frame_index")) - 1).cast("long").alias("chunk"))


@query("multi_index", "SELECT p_partkey, p_partkey % 7 AS a, p_size % 5 AS b, (p_partkey % 7) * 5 + p_size % 5 AS flat FROM part")
def multi_index(spark, d):
    flat = vectors.flat_index([F.col("p_partkey") % 7, F.col("p_size") % 5], [7, 5])
    x = table(spark, d, "part").select("p_partkey", flat.cast("long").alias("flat"))
    a, b = vectors.multi_index(F.col("flat"), [7, 5])
    return x.select("p_partkey", a.cast("long").alias("a"), b.cast("int").alias("b"), "flat")


@query("multi_one_hot", "SELECT p_partkey, CAST(p_partkey % 3 AS BIGINT) AS first_place, CAST(3 + p_size % 4 AS BIGINT) AS second_place, 7 AS width FROM part")
def multi_one_hot(spark, d):
    v = vectors.multi_one_hot([F.col("p_partkey") % 3, F.col("p_size") % 4], [3, 4])
    place = lambda a: F.array_position(a, 1).cast("long") - 1
    return table(spark, d, "part").select("p_partkey", place(F.slice(v, 1, 3)).alias("first_place"), (place(F.slice(v, 4, 4)) + 3).alias("second_place"), F.size(v).alias("width"))


@query("batch_unbatch", "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS width, 1 AS leading, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) + 0.0 AS total FROM embeddings")
def batch_unbatch(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", vectors.batched({"e": F.col("embedding").cast("array<double>")})["e"].alias("e"))
    back = vectors.unbatched({"e": F.col("e")})["e"]
    return x.select("vec_id", F.size(back).cast("long").alias("width"), F.size("e").alias("leading"), r(F.aggregate(back, F.lit(0.0), lambda p, q: p + q)).alias("total"))


@query("equal_parts", "SELECT vec_id, CAST(k AS INT) AS part, CAST(CASE WHEN k < 4 THEN 13 ELSE 12 END AS INT) AS n, CAST(embedding[CASE WHEN k < 4 THEN 13 * k ELSE 12 * k + 4 END + 1] AS DOUBLE) AS first FROM (SELECT *, unnest(range(5)) AS k FROM embeddings)")
def equal_parts(spark, d):
    x = table(spark, d, "embeddings").select("vec_id", F.posexplode(vectors.equal_parts(F.col("embedding").cast("array<double>"), 5)).alias("part", "v"))
    return x.select("vec_id", "part", F.size("v").alias("n"), F.get("v", F.lit(0)).alias("first"))


_ORDER_KEY = "l_shipdate, l_linenumber, l_partkey, l_suppkey"


@query(
    "action_rows",
    "WITH o AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) - 1 AS i FROM lineitem)"
    " SELECT l_orderkey, CAST(i AS INT) AS row_number, l_quantity AS first, l_tax AS second, 0.0 AS last, 2 AS real FROM o WHERE n % 2 = 0 UNION ALL SELECT l_orderkey, CAST(i AS INT), 0.0, 0.0, 0.0, 0 FROM (SELECT DISTINCT l_orderkey, n FROM o WHERE n % 2 = 1), (SELECT unnest(range(2)) AS i)",
)
def action_rows(spark, d):
    """Orders as actions of two components: those of an even number of rows are padded to six, the others have no action."""
    x = packed(spark, d).groupBy("l_orderkey").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("frame_index", F.array("l_quantity", "l_tax").alias("v")))).alias("a"))
    x = x.withColumn("rows", F.when(F.col("n") % 2 == 0, F.transform("a", lambda s: s["v"])))
    rows, mask = vectors.action_rows(F.col("rows"), 2, 6)
    x = x.select("l_orderkey", F.posexplode(F.arrays_zip(rows.alias("v"), mask.alias("m"))).alias("row_number", "p"))
    return x.select("l_orderkey", "row_number", *[F.get("p.v", F.lit(k)).alias(n) for n, k in (("first", 0), ("second", 1), ("last", 5))], F.size(F.filter("p.m", lambda m: m)).alias("real"))


@query("concat_rules", "SELECT vec_id, CAST(CASE WHEN vec_id % 2 = 0 THEN 9 ELSE 12 END AS INT) AS state_width, 10 AS action_width, CAST(embedding[3] AS DOUBLE) AS third, round(CAST(embedding[6] AS DOUBLE), 6) + 0.0 AS rotation_last FROM embeddings")
def concat_rules(spark, d):
    """State parts may have doubled widths, rotations any representation's; the action's keys are exactly its columns."""
    e = F.col("embedding").cast("array<double>")
    x = table(spark, d, "embeddings").select("vec_id", F.slice(e, 1, 3).alias("state.arm"), F.slice(e, 4, 3).alias("state.hand"), F.slice(e, 1, 4).alias("action.arm"), F.slice(e, 1, 6).alias("action.turn"), F.slice(e, 1, 3).alias("state.extra"))
    x = x.withColumn("state.arm", F.when(F.col("vec_id") % 2 == 1, vectors.sin_cos(F.col("`state.arm`"))).otherwise(F.col("`state.arm`"))).withColumn("state.hand", F.concat("`state.hand`", "`state.hand`"))
    state = transforms.Concat([("state.arm", 3), ("state.hand", 3)], "state", "state", post={"state.hand": 6})
    action = transforms.Concat([("action.arm", 4), ("action.turn", 3)], "action", "action", "action.", ["action.turn"], {"action.turn": 6})
    x = state.apply(action.apply(x)).withColumns({"state_width": F.size("state"), "action_width": F.size("action")})
    x = action.unapply(x)
    return x.select("vec_id", "state_width", "action_width", F.get("`action.arm`", F.lit(2)).alias("third"), r(F.get("`action.turn`", F.lit(5)), 6).alias("rotation_last"))


_FEATURES = {"observation.state": "float64", "action": "float64", "observation.images.left": "video", "annotation.task": "int64", "annotation.language.language_instruction": "int64", "timestamp": "float64"}


@query("column_roles", "SELECT * FROM (VALUES ('state', 'observation.state'), ('action', 'action'), ('video', 'observation.images.left'), ('annotation', 'annotation.task'), ('annotation', 'annotation.language.language_instruction'), ('task key', 'annotation.task')) t(role, name)")
def column_roles(spark, d):
    roles = datasets.column_roles(_FEATURES)
    return spark.createDataFrame([(k, n) for k, ns in roles.items() for n in ns] + [("task key", datasets.task_key(roles["annotation"]))], "role string, name string")


@query("modality_catalog", "SELECT * FROM (VALUES ('state', 'arm', 'observation.state', 0, 6), ('state', 'gripper', 'observation.state', 6, 7), ('action', 'action', 'action', 0, 28), ('video', 'left', 'observation.images.left', NULL, NULL), ('annotation', 'task', 'annotation.task', NULL, NULL), ('annotation', 'language.language_instruction', 'annotation.language.language_instruction', NULL, NULL)) t(modality, key, original_key, start_pos, end_pos)")
def modality_catalog(spark, d):
    rows = datasets.modality_catalog(_FEATURES, {"observation.state": 14, "action": 28}, {"state": datasets.parse_slices('{"arm": [0, 6], "gripper": [6, 7]}')})
    return spark.createDataFrame(rows, "modality string, key string, original_key string, start_pos int, end_pos int")


@query("sin_cos", f"WITH {STEPS} SELECT event_id, round(sin(value), 6) + 0.0 AS sine, round(cos(k), 6) + 0.0 AS cosine FROM steps")
def sin_cos(spark, d):
    v = vectors.sin_cos(F.array("value", "k"))
    return steps(spark, d).select("event_id", r(F.get(v, F.lit(0)), 6).alias("sine"), r(F.get(v, F.lit(3)), 6).alias("cosine"))


@query("effector_rescale", "SELECT event_id, round(least(greatest((value - 35.0) / 85.0, 0.0), 1.0), 6) + 0.0 AS opening, CASE WHEN value > 0.5 THEN 1.0 ELSE 0.0 END AS is_open FROM events")
def effector_rescale(spark, d):
    return table(spark, d, "events").select("event_id", r(vectors.rescaled_effector(F.col("value")), 6).alias("opening"), vectors.binary(F.col("value")).alias("is_open"))


@query("byte_rescale", "SELECT event_id, CAST(floor(least(greatest((value - lo) / greatest(hi - lo, 1e-6) * 255.0, 0.0), 255.0)) AS INT) AS level FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events)")
def byte_rescale(spark, d):
    e = table(spark, d, "events")
    lo, hi = e.agg(F.min("value"), F.max("value")).head()
    return e.select("event_id", vectors.to_bytes(F.col("value"), F.lit(lo), F.lit(hi)).alias("level"))


@query("array_moments", f"SELECT vec_id, round(avg(value), 6) + 0.0 AS mean, round(var_pop(value), 6) + 0.0 AS variance, round(var_samp(value), 6) + 0.0 AS unbiased FROM ({V}) GROUP BY vec_id")
def array_moments(spark, d):
    v = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select("vec_id", r(vectors.mean_of(v), 6).alias("mean"), r(vectors.variance_of(v), 6).alias("variance"), r(vectors.variance_of(v, True), 6).alias("unbiased"))


@query("last_argmax", f"SELECT vec_id, CAST(max(dim) AS INT) AS place FROM (SELECT *, max(value) OVER (PARTITION BY vec_id) AS m FROM ({V})) WHERE value = m GROUP BY vec_id")
def last_argmax(spark, d):
    return table(spark, d, "embeddings").select("vec_id", vectors.last_argmax(F.col("embedding")).alias("place"))


@query("action_assembly", "SELECT episode_index, frame_index, count(*) AS copies, 8 AS width, max(CASE WHEN gripper_position IS NULL THEN 0.0 ELSE gripper_position END) AS gripper FROM frames WHERE joint_position IS NULL OR len(joint_position) = 7 GROUP BY episode_index, frame_index")
def action_assembly(spark, d):
    v = vectors.with_gripper(F.col("joint_position"), F.col("gripper_position"))
    x = table(spark, d, "frames").where("joint_position IS NULL OR size(joint_position) = 7").select("episode_index", "frame_index", v.alias("v"))
    return x.groupBy("episode_index", "frame_index").agg(F.count("*").alias("copies"), F.max(F.size("v")).alias("width"), F.max(F.get("v", F.lit(7))).alias("gripper"))


# normalization of embedding components by the statistics of their dim

_S = f"v AS ({V}), s AS (SELECT dim, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99 FROM v GROUP BY dim)"
_FORMULA = {
    "q99": "least(greatest(CASE WHEN q01 = q99 THEN value ELSE 2 * (value - q01) / (q99 - q01) - 1 END, -1.0), 1.0)",
    "mean_std": "CASE WHEN std = 0 THEN value ELSE (value - mean) / std END",
    "min_max": "least(greatest(CASE WHEN lo = hi THEN 0.0 ELSE 2 * (value - lo) / (hi - lo) - 1 END, -1.0), 1.0)",
    "scale": "CASE WHEN greatest(abs(lo), abs(hi)) = 0 THEN 0.0 ELSE value / greatest(abs(lo), abs(hi)) END",
    "binary": "CASE WHEN value > 0.5 THEN 1.0 ELSE 0.0 END",
}


def _with_stats(spark, d):
    v = _values(spark, d)
    return v.join(stats.feature_stats(v, ["dim"]).drop("n"), "dim")


def _columns():
    return {k: F.col(k) for k in stats.STATS}


def _normalizing(mode: str):
    @query(f"normalize_{mode}", f"WITH {_S} SELECT vec_id, dim, round({_FORMULA[mode]}, 4) + 0.0 AS y FROM v JOIN s USING (dim)")
    def run(spark, d):
        return _with_stats(spark, d).select("vec_id", "dim", r(normalize.normalized(mode, F.col("value"), _columns())).alias("y"))


for _mode in normalize.MODES:
    _normalizing(_mode)


@query("normalize_roundtrip", f"WITH {_S} SELECT dim, count(*) AS n, true AS exact FROM v JOIN s USING (dim) WHERE value BETWEEN q01 AND q99 GROUP BY dim")
def normalize_roundtrip(spark, d):
    x = _with_stats(spark, d).where("value BETWEEN q01 AND q99")
    back = [F.abs(normalize.restored(m, normalize.normalized(m, F.col("value"), _columns()), _columns()) - F.col("value")) for m in ("q99", "mean_std", "min_max")]
    return x.groupBy("dim").agg(F.count("*").alias("n"), (F.max(F.greatest(*back)) < 1e-9).alias("exact"))


@query(
    "normalize_per_horizon",
    f"WITH {STEPS}, s AS (SELECT frame_index % 4 AS h, min(value) AS lo, max(value) AS hi FROM steps GROUP BY 1)"
    " SELECT event_id, h, round(least(greatest(CASE WHEN lo = hi THEN 0.0 ELSE 2 * (value - lo) / (hi - lo) - 1 END, -1.0), 1.0), 4) + 0.0 AS y FROM steps JOIN s ON frame_index % 4 = h",
)
def normalize_per_horizon(spark, d):
    x = steps(spark, d).withColumn("h", F.pmod("frame_index", F.lit(4)))
    s = x.groupBy("h").agg(F.min("value").alias("min"), F.max("value").alias("max"))
    return x.join(s, "h").select("event_id", "h", r(normalize.min_max(F.col("value"), F.col("min"), F.col("max"))).alias("y"))


_BY_STEP = f"v AS (SELECT vec_id, dim // 8 AS step, dim % 8 AS place, value FROM ({V})), s AS (SELECT step % 4 AS h, place, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99 FROM v GROUP BY ALL)"


def _horizons(spark, d):
    """embeddings as eight rows of eight components, two horizons of four steps, with the statistics of each step."""
    e = F.col("embedding").cast("array<double>")
    x = table(spark, d, "embeddings").select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.slice(e, k * 8 + 1, F.lit(8))).alias("rows"))
    v = x.select(F.posexplode("rows").alias("step", "v")).select(F.pmod("step", F.lit(4)).alias("h"), F.posexplode("v").alias("place", "value"))
    s = stats.feature_stats(v, ["h", "place"])
    per = s.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("place", *stats.STATS))).alias("p"))
    whole = per.agg(F.array_sort(F.collect_list(F.struct("h", "p"))).alias("all"))  # one row of horizon by components
    part = lambda k: F.transform("all", lambda h: F.transform(h["p"], lambda p: p[k]))
    return x.crossJoin(F.broadcast(whole.select(*[part(k).alias(k) for k in stats.STATS])))


def _by_horizon(mode: str):
    @query(f"normalize_by_horizon_{mode}", f"WITH {_BY_STEP} SELECT vec_id, CAST(step AS INT) AS step, CAST(v.place AS INT) AS place, round({_FORMULA[mode]}, 4) + 0.0 AS y FROM v JOIN s ON step % 4 = h AND v.place = s.place")
    def run(spark, d):
        x = _horizons(spark, d)
        x = x.select("vec_id", F.posexplode(normalize.normalized_by_horizon(mode, F.col("rows"), _columns())).alias("step", "v"))
        return x.select("vec_id", "step", F.posexplode("v").alias("place", "y")).withColumn("y", r("y"))


for _mode in normalize.MODES:
    _by_horizon(_mode)


@query("restored_by_horizon", f"WITH {_BY_STEP} SELECT vec_id, CAST(step AS INT) AS step, CAST(v.place AS INT) AS place, round(value, 6) + 0.0 AS min_max, round(least(greatest(value, q01), q99), 6) + 0.0 AS q99 FROM v JOIN s ON step % 4 = h AND v.place = s.place")
def restored_by_horizon(spark, d):
    """What min_max restores is the value, what q99 restores the value within the quantiles."""
    x, back = _horizons(spark, d), {}
    for mode in ("min_max", "q99"):
        back[mode] = normalize.restored_by_horizon(mode, normalize.normalized_by_horizon(mode, F.col("rows"), _columns()), _columns())
    x = x.select("vec_id", F.posexplode(F.arrays_zip(*[v.alias(k) for k, v in back.items()])).alias("step", "v"))
    x = x.select("vec_id", "step", F.posexplode(F.arrays_zip(*[F.col(f"v.{k}").alias(k) for k in back])).alias("place", "p"))
    return x.select("vec_id", "step", "place", *[r(F.col(f"p.{k}"), 6).alias(k) for k in back])


_Q = "embedding[4 * k + {} + 1]"
_MATRIX = ("1 - s * (y * y + z * z)", "s * (x * y - z * w)", "s * (x * z + y * w)", "s * (x * y + z * w)", "1 - s * (x * x + z * z)", "s * (y * z - x * w)", "s * (x * z - y * w)", "s * (y * z + x * w)", "1 - s * (x * x + y * y)")


@query(
    "rotation_roundtrip",
    f"WITH q AS (SELECT vec_id, k, {', '.join(f'CAST({_Q.format(i)} AS DOUBLE) AS {c}' for i, c in enumerate('wxyz'))} FROM (SELECT *, unnest(range(16)) AS k FROM embeddings)), n AS (SELECT *, 2 / (w * w + x * x + y * y + z * z) AS s FROM q)"
    f" SELECT vec_id, CAST(k AS INT) AS part, kind, {', '.join(f'round({m}, 4) + 0.0 AS m{i}' for i, m in enumerate(_MATRIX))} FROM n, (SELECT unnest(['quaternion', 'rotation_6d', 'axis_angle', 'euler']) AS kind)",
)
def rotation_roundtrip(spark, d):
    """Matrices of all sixteen quaternions in a vector, converted to each kind and back."""
    e = F.col("embedding").cast("array<double>")
    v = table(spark, d, "embeddings").select("vec_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.slice(e, k * 4 + 1, F.lit(4)))).alias("part", "q")).withColumn("m", rotations.quaternion_to_matrix(F.col("q")))
    out = []
    for kind in ("quaternion", "rotation_6d", "axis_angle", "euler"):
        back = rotations.convert(rotations.convert(F.col("m"), "matrix", kind), kind, "matrix")
        out.append(F.struct(F.lit(kind).alias("kind"), back.alias("b")))
    x = v.select("vec_id", "part", F.explode(F.array(*out)).alias("x"))
    return x.select("vec_id", "part", "x.kind", *[r(F.get("x.b", F.lit(i))).alias(f"m{i}") for i in range(9)])


@query("transform_chain", "SELECT vec_id, CAST(k AS INT) AS place, round(CAST(embedding[k + 1] AS DOUBLE), 6) + 0.0 AS v, round(CAST(embedding[k + 1] AS DOUBLE) / 10, 6) + 0.0 AS scaled FROM (SELECT *, unnest(range(64)) AS k FROM embeddings)")
def transform_chain(spark, d):
    """Casting, normalization and concatenation in a chain by configuration: what it makes, and what undoing it gives back."""
    e = F.col("embedding").cast("array<double>")
    x = table(spark, d, "embeddings").select("vec_id", F.slice(e, 1, 40).alias("a"), F.slice(e, 41, 24).alias("b"))
    s = {"mean": 0.0, "std": 1.5, "min": -10.0, "max": 10.0, "q01": -9.0, "q99": 9.0}
    chain = transforms.built([
        {"step": "normalize", "column": "a", "mode": "min_max", "stats": [s] * 40}, {"step": "normalize", "column": "b", "mode": "min_max", "stats": [s] * 24},
        {"step": "concat", "parts": [("a", 40), ("b", 24)], "out": "v"}, {"step": "cast", "columns": ["v"], "to": "array<double>"},
    ])
    y = chain.apply(x)
    made = y.select("vec_id", F.posexplode("v").alias("place", "scaled"))
    back = chain.unapply(y).select("vec_id", F.posexplode(F.concat("a", "b")).alias("place", "v"))
    return made.join(back, ["vec_id", "place"]).select("vec_id", "place", r("v", 6).alias("v"), r("scaled", 6).alias("scaled"))


@query("augment_noise")
def augment_noise(spark, d):
    """Noise and dropout keep vectors within their extremes or zero them: rows by what became of them."""
    x = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v")).withColumn("v0", F.col("v"))
    y = transforms.Chain([transforms.Perturb("v", 0.05, 3), transforms.Dropout("v", 0.1, 4)]).apply(x)
    zero = F.forall("v", lambda a: a == 0)
    inside = (F.array_max("v") <= F.array_max("v0")) & (F.array_min("v") >= F.array_min("v0"))
    return y.groupBy(F.when(zero, "dropped").when(inside, "within").otherwise("outside").alias("outcome")).count()
