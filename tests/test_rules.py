"""Rules that raise, switches and edge cases of the reference operators."""

import datetime as dt
import math
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trajecta.functions import normalize, text, vectors
from trajecta.operators import draws, filters, joins, quantiles, sampling, stats, transforms, validate, windows
from trajecta.session import scratch_root, shared_dir
from trajecta.sources import datasets


def one(spark, *columns):
    return spark.range(1).select(*columns).head()


def test_concat_rules(spark):
    df = spark.createDataFrame([([1.0, 2.0], [0.1, 0.2, 0.3], [5.0])], "`action.a` array<double>, `action.r` array<double>, `action.z` array<double>")
    step = transforms.Concat([("action.a", 2), ("action.r", 4)], "action", "action", "action.", ["action.r"], {"action.r": 3})
    with pytest.raises(ValueError, match="action.z"):
        step.apply(df)
    with pytest.raises(ValueError, match="no columns"):
        transforms.Concat([("state.q", 2)], "state", "state").apply(df)
    with pytest.raises(ValueError, match="unknown kind"):
        transforms.Concat([], "x", "video")
    out = step.apply(df.drop("action.z"))
    assert out.head()["action"] == [1.0, 2.0, 0.1, 0.2, 0.3]
    assert step.unapply(out).head().asDict() == {"action.a": [1.0, 2.0], "action.r": [0.1, 0.2, 0.3]}
    with pytest.raises(PySparkException, match="components expected"):
        transforms.Concat([("action.a", 1)], "action", "action").apply(df.select("`action.a`")).collect()
    assert transforms.Concat([("action.a", 1)], "s", "state").apply(df.select("`action.a`")).head()["s"] == [1.0, 2.0]


def test_cast_is_restored(spark):
    df = spark.createDataFrame([([1.1, 2.0],)], "v array<double>")
    step = transforms.built([{"step": "cast", "columns": ["v"]}])
    out = step.apply(df)
    assert dict(out.dtypes)["v"] == "array<float>" and dict(step.unapply(out).dtypes)["v"] == "array<double>"


def test_normalize_step(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([4.0],), (None,)], "v array<double>")
    s = [{"min": 0.0, "max": 4.0}, {"min": 2.0, "max": 2.0}]
    got = [r.v for r in transforms.Normalize("v", "min_max", s).apply(df).collect()]
    assert got == [[-0.5, 0.0], [1.0, None], None]


def test_action_rows(spark):
    rows = lambda x: F.lit(x).cast("array<array<double>>") if x is None else F.array(*[F.lit([float(v) for v in r]) for r in x])
    a, m = vectors.action_rows(rows([[1, 2], [3, 4]]), 2, 3)
    assert list(one(spark, a, m)) == [[[1.0, 2.0, 0.0], [3.0, 4.0, 0.0]], [[True, True, False]] * 2]
    a, m = vectors.action_rows(rows(None), 2, 3)
    assert list(one(spark, a, m)) == [[[0.0] * 3] * 2, [[False] * 3] * 2]
    for bad in ([[1, 2]], [[1, 2, 3, 4]] * 2):
        with pytest.raises(PySparkException):
            one(spark, vectors.action_rows(rows(bad), 2, 3)[0])


def test_parts_and_batches(spark):
    v = F.lit([1.0, 2.0, 3.0, 4.0, 5.0])
    assert one(spark, vectors.equal_parts(v, 3))[0] == [[1.0, 2.0], [3.0, 4.0], [5.0]]
    with pytest.raises(PySparkException, match="not divisible"):
        one(spark, vectors.equal_parts(v, 3, strict=True))
    with pytest.raises(PySparkException, match="leading dimension"):
        one(spark, vectors.unbatched({"x": v})["x"])


def test_horizons(spark):
    s = {"min": F.array(F.lit([0.0]), F.lit([10.0])), "max": F.array(F.lit([1.0]), F.lit([20.0]))}
    rows = lambda n: F.array(*[F.lit([0.5 if k % 2 == 0 else 15.0]) for k in range(n)])
    assert one(spark, normalize.normalized_by_horizon("min_max", rows(4), s))[0] == [[0.0]] * 4
    assert one(spark, normalize.normalized_by_horizon("min_max", rows(1), s))[0] == [[0.0]]
    assert one(spark, normalize.restored_by_horizon("min_max", normalize.normalized_by_horizon("min_max", rows(2), s), s))[0] == [[0.5], [15.0]]
    with pytest.raises(PySparkException, match="multiple"):
        one(spark, normalize.normalized_by_horizon("min_max", rows(3), s))
    far = [normalize.out_of_range(F.lit(x), F.lit(0.0), F.lit(1.0)) for x in (0.5, 1.0, 1.000001, 1.1)] + [normalize.out_of_range(F.lit(9.0), F.lit(1.0), F.lit(1.0))]
    assert list(one(spark, *far)) == [False, False, False, True, False]


def test_mode_checks():
    for bad in ({"mode": "max"}, {"mode": "q99", "continuous": False}, {"mode": "min_max", "rotation": "quaternion", "absolute": False}, {"mode": "q99", "rotation": "quaternion"}):
        with pytest.raises(ValueError):
            normalize.check_mode(**bad)


def test_relative_chunks(spark):
    rows, states = F.array(*[F.lit([float(k)]) for k in range(5)]), F.array(*[F.lit([10.0 * k]) for k in range(3)])
    anchors = F.lit([2, 2, 1, 1, 0])
    assert one(spark, windows.relative_chunks(rows, states, anchors, 2))[0] == [[-20.0], [-19.0], [-8.0], [-7.0], [4.0]]
    assert one(spark, windows.relative_chunks(rows, states, F.lit([7, 7, 1, 1, 0]), 2))[0][:2] == [[0.0], [1.0]]
    assert windows.relative_keys(["a", "b", "c"], ["a", "b"]) == ["a", "b"] and windows.relative_keys(["a", "b"], ["a", "b"], ["b", "z"]) == ["b"]
    with pytest.raises(ValueError):
        windows.every(F.lit(1), 0)


def test_formalized_like_python(spark):
    texts = ["Pick　up NOW!", "a b-c_d", "café é ñ", "打开 抽屉。", "½ Ⅳ ²", "", None, "x" * 100_000, "don't", "हिन्दी", "\x1c\x85 a"]
    texts += [r.task for r in spark.read.parquet("/root/testdata/sf0.001/tasks.parquet").collect()]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r.k: r.f for r in df.select("k", text.formalized(F.col("t")).alias("f")).collect()}
    assert got == {k: None if t is None else re.sub(r"[^\w\s]", "", t.lower()) for k, t in enumerate(texts)}


def test_literals(spark):
    cases = {'["don\'t stop"]': "don't stop", "['it\\'s', 'b']": "it's", '[ "a \\"b\\"" , 3]': 'a "b"', "[7, 8]": "7", "plain ['x']": "plain ['x']", "['open": "['open", "[]": "[]", "['a']\n": "a", '["x, y]", "z"]': "x, y]"}
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    assert {r.t: r.f for r in df.select("t", text.first_of_literal(F.col("t")).alias("f")).collect()} == cases | {None: None}


def test_language_switches(spark):
    t, none = F.lit(["a", "b", "c"]), F.array().cast("array<string>")
    pick = lambda x, **k: one(spark, text.chosen(x, F.lit("7"), "d", **k))[0]
    assert pick(t, training=False) == "a" and pick(t, constant=True) == "d" and pick(none) == "d" and pick(none, training=False) == "d"
    assert pick(t, dropout=1.0) == "d" and pick(t, spread=F.lit(False)) == "a" and pick(t) in "abc"
    assert {one(spark, text.chosen(t, F.lit(str(k)), "d"))[0] for k in range(12)} == {"a", "b", "c"}


def test_counts_estimates_and_tokens(spark):
    shown = {0: "0  ", 999: "999  ", 1234567: "1.23 M", 12000: "12 K", 5_020_000_000: "5.02 B", 10**15 * 7: "7,000 T"}
    assert list(one(spark, *[text.readable_count(F.lit(n).cast("long")) for n in shown])) == list(shown.values())
    assert list(one(spark, text.scientific(F.lit(0.0015)), text.scientific(F.lit(0)), text.scientific(F.lit(1e-12)), text.scientific(F.lit(0.0015), 2, True))) == ["1.5e-3", "0", "1.0e-12", "1.50E-3"]
    assert list(one(spark, text.frame_estimate(F.lit(0), F.lit(2.5), F.lit(15.0)), text.frame_estimate(F.lit(None).cast("int"), F.lit(0.0), F.lit(15.0)), text.frame_estimate(F.lit(9), F.lit(2.5), F.lit(15.0)))) == [37, 0, 9]
    assert one(spark, text.decoded(text.white_space_tokens(F.lit(" pick  up\nthe cup "), 6)[0]))[0] == "pick up the cup"


def test_names_and_overrides():
    assert datasets.filtered(["a1", "b1", "a2"], [lambda n: n.endswith("1")], ["b*"]) == ["a1"]
    assert datasets.filtered(["a1", "b1"], ["a*", callable]) == ["a1"]
    config = {"action_horizon": 30, "max_action_dim": 8, "model": {"action_head_override_kwargs": {}, "expand_action_head_kwargs": {"expand_action_dim": {"old_action_dim": 8, "new_action_dim": 32}}}, "modality_configs": {"x": {"action": {"delta_indices": [0]}, "state": {"delta_indices": [0]}}}}
    got = datasets.with_overrides(config)
    assert got["max_action_dim"] == 32 and got["model"]["action_head_override_kwargs"]["action_horizon"] == 30
    assert got["modality_configs"]["x"] == {"action": {"delta_indices": list(range(30))}, "state": {"delta_indices": [0]}} and config["max_action_dim"] == 8
    assert datasets.with_overrides({"action_horizon": 3}) == {"action_horizon": 3}
    with pytest.raises(ValueError):
        datasets.with_horizon({}, 0)


def test_filters(spark):
    df = spark.createDataFrame([(1, [1.0], 2.0), (2, [], 1.0), (3, None, 0.0), (4, [2.0], float("nan")), (5, [2.0], None)], "k int, v array<double>, x double")
    assert [r.k for r in filters.with_modality(df, ["v", "x"]).collect()] == [1, 4]
    assert [r.k for r in filters.valid_results(df, ["x"]).collect()] == [1, 2, 3]
    with pytest.raises(ValueError, match="more than 3"):
        filters.long_enough(df.limit(3).select(F.lit(1).alias("e")), "e", 3)
    assert filters.long_enough(df.limit(0).select(F.lit(1).alias("e")), "e", 3).count() == 0
    assert filters.first_by(df, F.col("k"), 3).count() == 2
    got = {r.kind: (r.found, r.expected, r.complete) for r in validate.file_counts(spark.createDataFrame([("a.parquet",), ("b.mp4",), ("c.txt",)], "name string"), 1, 2).collect()}
    assert got == {"parquet": (1, 1, True), "mp4": (1, 2, False)}
    assert stats.PROGRESS_STATS["std"] == 0.2887


def test_quantiles_of_hard_values(spark):
    values = [("a", x) for x in (1e-300, -1e300, 0.0, -0.0, 5.0, 5.0, 5.0, math.inf, -math.inf, None, math.nan, 1e-320)] + [(None, 3.0), ("c", None)]
    df = spark.createDataFrame(values, "g string, x double")
    got = {r.g: r for r in quantiles.with_quantiles(df, ["g"], "x", {"low": 0.0, "half": 0.5, "top": 1.0, "q": 0.73}).collect()}
    assert set(got) == {"a", None} and got[None].half == 3.0
    xs = sorted(x for g, x in values if g == "a" and x is not None and not math.isnan(x))
    k = 0.73 * (len(xs) - 1)
    a, b = xs[math.floor(k)], xs[math.ceil(k)]
    assert (got["a"].low, got["a"].top, got["a"].half) == (-math.inf, math.inf, (xs[4] + xs[5]) / 2 if len(xs) % 2 == 0 else xs[len(xs) // 2])
    assert got["a"].q == pytest.approx(a + (k - math.floor(k)) * (b - a)) and got["a"].n == len(xs)
    assert quantiles.with_quantiles(df.limit(0), ["g"], "x", {"q": 0.5}).count() == 0
    whole = quantiles.with_quantiles(spark.range(1001), [], "id", {"q": 0.25}).head()
    assert (whole.q, whole.mean, round(whole.std, 6), whole.n) == (250.0, 500.0, round(math.sqrt((1001**2 - 1) / 12), 6), 1001)


def test_moments_do_not_cancel(spark):
    df = spark.createDataFrame([(k % 3, 1e9 + k) for k in range(9)], "p int, value double")
    m = stats.merged_moments(stats.moments(df, ["p"]).withColumn("all", F.lit(1)), ["all"]).head()
    assert m.m2 == pytest.approx(60.0, rel=1e-9) and m.n == 9


def test_intervals_of_odd_kinds(spark):
    steps = spark.createDataFrame([(e, f) for e in (1, 2, None) for f in range(5)], "e int, f bigint")
    i = spark.createDataFrame([(1, 0, 0, 2**62, "all"), (1, 1, 3, 4, "one"), (1, 2, 4, 2, "none"), (1, 3, None, 9, "null"), (7, 0, 0, 9, "other"), (None, 0, 0, 9, "lost")], "e int, ordinal int, start bigint, end bigint, label string")
    got = {(r.e, r.f): r.label for r in joins.interval_labels(steps, i, "e", "f", "label", grid=2).collect()}
    assert [got[1, f] for f in range(5)] == ["all", "all", "all", "one", "all"] and got[2, 0] == got[None, 3] == "N/A" and len(got) == 15
    assert filters.within_ranges(steps, i, "e", "f", 2).count() == 6


def test_spread_is_a_join(spark, monkeypatch):
    monkeypatch.setattr(joins, "LEAST_HOT", 2)
    monkeypatch.setattr(joins, "HOT_KEYS", 4)
    large = spark.createDataFrame([(k if k < 5 else 9, k) for k in range(60)] + [(None, 1)], "a int, b int")
    keyed = large.groupBy("a").agg(F.count("*").alias("n"), F.max("b").alias("m")).where("a IS NULL OR a <> 2")
    got = joins.spread(large, keyed, ["a"], "n", 61)
    assert sorted(map(tuple, got.collect())) == sorted((k if k < 5 else 9, k, k if k < 5 else 59) for k in range(60) if k != 2)


def test_draws_of_nothing_and_of_heavy_items(spark):
    items = spark.createDataFrame([(1, 5, 10**12), (1, 6, 1), (1, 7, 0), (2, 8, 3)], "g int, o bigint, w bigint")
    c = draws.cumulated(items, ["g"], "o", "w")
    d = spark.range(300).withColumnRenamed("id", "draw").withColumn("g", F.when(F.col("draw") < 200, 1).when(F.col("draw") < 250, 2).otherwise(3))
    got = draws.picked(d, c, ["g"], 1, 0, "x").collect()
    assert len(got) == 250 and {r.o for r in got if r.g == 1} == {5} and {r.o for r in got if r.g == 2} == {8}
    assert draws.picked(d, draws.cumulated(items.limit(0), ["g"], "o", "w"), ["g"], 1, 0, "x").count() == 0
    a, b = (draws.shuffled(items, "g", "o", 3, e).orderBy("o").collect() for e in (0, 1))
    assert sorted(r.position for r in a if r.g == 1) == [0, 1, 2] and len(a) == len(b)
    with pytest.raises(ValueError):
        sampling.part_of_each(items, "g", "o", 1, 1.5, 10)
    with pytest.raises(ValueError):
        windows.sequential_split(items, "o", [("a", 0.5)], 4)


def test_shared_folder(spark):
    assert scratch_root(spark).startswith(shared_dir(spark)) and spark.sparkContext.applicationId in scratch_root(spark)


def test_schema_difference(spark):
    df = spark.createDataFrame([(1, dt.date(2025, 1, 1))], "a int, b date")
    assert validate.schema_difference(df, {"a": "int", "c": "string"}) == [("b", None, "date"), ("c", "string", None)]


def test_sessions_in_any_cut(spark):
    """Messages dealt with in one piece or in several give the same runs and buffers, as one after the other would."""
    import random

    import pandas as pd

    from trajecta.streaming import sessions

    rng = random.Random(3)
    for _ in range(40):
        rows = [(k, rng.choice(["A", "B", None, None, "A"]), rng.choice(["infer"] * 6 + ["reset"]), float(k)) for k in range(rng.randint(1, 30))]
        session, run, turn, frames, want = None, 0, -1, [], []
        for seq, sid, endpoint, frame in rows:
            if run == 0 or (sid is not None and sid != session) or endpoint == "reset":
                run, turn, frames = run + 1, -1, []
            session = sid if sid is not None else session
            turn += 1
            frames.append(frame)
            want.append((seq, run, turn, [frame] if turn == 0 else [frames[0]] * (4 - len(frames)) + frames[-4:]))
        got, state, at = [], (None, 0, -1, []), 0
        while at < len(rows):
            n = rng.randint(1, 7)
            part = pd.DataFrame(rows[at : at + n], columns=["seq", "session_id", "endpoint", "frame"]).sample(frac=1, random_state=1)
            out, state = sessions._advanced(part, *state, 4)
            got += [(r.seq, r.run, r.turn, list(r.buffer)) for r in out.itertuples()]
            at += n
        assert got == want
