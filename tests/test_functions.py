import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajecta.functions import normalize, packing, rotations, text, vectors
from trajecta.operators import transforms, validate
from trajecta.sources import datasets


def test_block_round_trip():
    rng = np.random.default_rng(0)
    m = np.round(rng.normal(size=(50, 4)), 4)
    m[3, 1], m[4, 2], m[5, 0], m[6, 3], m[7, 0] = np.nan, packing.NULL, np.inf, 1 / 3, -0.0
    b = packing.Block(np.arange(50) // 9, np.arange(50) * 7 - 100, np.zeros(50, "i8"), m, np.stack([np.arange(50)], 1), [(np.arange(50) % 3, ["a", None, "c", "unused"])])
    c = packing.Block.unpack(b.pack())
    assert (c.m.view("u8") == m.view("u8")).all() and (c.ep == b.ep).all() and (c.fr == b.fr).all() and (c.i == b.i).all()
    assert [c.s[0][1][k] for k in c.s[0][0]] == [b.s[0][1][k] for k in b.s[0][0]]
    raw = packing.Block(b.ep, b.fr, b.order, rng.normal(size=(50, 2)), b.i, [])
    assert (packing.Block.unpack(raw.pack()).m == raw.m).all()


def test_rotations_agree_with_numpy(spark):
    rng = np.random.default_rng(1)
    angles = rng.uniform(-1.2, 1.2, size=(20, 3))
    df = spark.createDataFrame([(v.tolist(),) for v in angles], "v array<double>")
    for order in ("XYZ", "ZYX", "YXZ"):
        x = df.select("v", rotations.euler_to_matrix(F.col("v"), order).alias("m")).select("v", "m", rotations.matrix_to_euler(F.col("m"), order).alias("back")).collect()
        for r in x:
            m = np.eye(3)
            for axis, t in zip(order, r.v):
                c, s = np.cos(t), np.sin(t)
                m = m @ {"X": np.array([[1, 0, 0], [0, c, -s], [0, s, c]]), "Y": np.array([[c, 0, s], [0, 1, 0], [-s, 0, c]]), "Z": np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])}[axis]
            assert np.allclose(np.array(r.m).reshape(3, 3), m) and np.allclose(r.back, r.v)
    with pytest.raises(ValueError):
        rotations.convert(F.col("v"), "euler", "nothing")


def test_degenerate_statistics(spark):
    df = spark.createDataFrame([(5.0,)], "x double")
    one = lambda c: df.select(c.alias("y")).head().y
    five, x = F.lit(5.0), F.col("x")
    assert one(normalize.q99(x, five, five)) == 1.0  # passed through, then clamped
    assert one(normalize.min_max(x, five, five)) == 0.0
    assert one(normalize.mean_std(x, five, F.lit(0.0))) == 5.0
    assert one(normalize.scale(x, F.lit(0.0), F.lit(0.0))) == 0.0
    assert one(normalize.binary(F.lit(0.5))) == 0.0
    for bad in (dict(mode="mode"), dict(mode="q99", continuous=False), dict(mode="q99", rotation="quaternion"), dict(mode="min_max", rotation="quaternion", absolute=False)):
        with pytest.raises(ValueError):
            normalize.check_mode(**bad)
    with pytest.raises(ValueError):
        normalize.restored("scale", x, {})


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(vectors.padded(F.col("v"), 2)).collect()] == [[1.0, 2.0], [0.0, 0.0], None]
    assert df.select(vectors.pad_mask(F.col("v"), 2)).head()[0] == [True, True]
    with pytest.raises(Exception, match="longer than 2"):
        df.select(vectors.padded_strictly(F.col("v"), 2)).collect()
    assert df.select(vectors.with_gripper(F.col("v"), F.lit(None).cast("double"))).collect()[2][0] == [0.0] * 8
    assert df.select(vectors.last_argmax(F.array(F.lit(1), F.lit(3), F.lit(3)))).head()[0] == 2


def test_text(spark):
    df = spark.createDataFrame([("  A  b:  C!\n",), (None,), ("",)], "x string")
    one = lambda c: [r[0] for r in df.select(c).collect()]
    assert one(text.single_spaced(F.col("x"))) == ["A b: C!", None, ""]
    assert one(text.formalized(F.col("x")))[0] == "  a  b  c\n" or one(text.formalized(F.col("x")))[0].split() == ["a", "b", "c"]
    assert one(text.without_prefix(F.col("x")))[0] == " C!\n"
    assert one(text.html_unescaped(F.lit(" &amp;lt; "))) == ["<"] * 3
    with pytest.raises(Exception, match="no template"):
        df.select(text.prompt(F.lit("other"), F.lit("x"), {"a": "{}"})).collect()
    assert df.select(text.prompt(F.lit("other"), F.lit("x"), {"a": "{}"}, default="{}!")).head()[0] == "x!"
    tokens, mask = text.white_space_tokens(F.col("x"), 3)
    assert one(tokens) == [["A ", "b:", "C!"], ["", "", ""], ["", "", ""]] and one(mask)[1] == [False] * 3


def test_chain(spark):
    df = spark.createDataFrame([([0.0, 4.0], [1.0])], "a array<double>, b array<double>")
    s = [{"min": 0, "max": 4}, {"min": 0, "max": 4}]
    chain = transforms.built([{"step": "normalize", "column": "a", "mode": "min_max", "stats": s}, {"step": "concat", "parts": [("a", 2), ("b", 1)], "out": "ab"}, {"step": "perturb", "column": "ab", "std": 0.1}]).eval()
    out = chain.apply(df)
    assert out.head().ab == [-1.0, 1.0, 1.0]
    assert chain.unapply(out).head().asDict() == {"a": [0.0, 4.0], "b": [1.0]}
    with pytest.raises(ValueError, match="unknown step"):
        transforms.built([{"step": "os.system"}])
    with pytest.raises(ValueError, match="step 0"):
        transforms.Chain([transforms.SinCos("missing")]).apply(df)
    with pytest.raises(Exception, match="2 components expected"):
        transforms.Concat([("b", 2)], "c").apply(df).collect()


def test_sources(spark, tmp_path):
    (tmp_path / "info.json").write_text(json.dumps({"fps": 15}))
    assert datasets.read_json(spark, str(tmp_path / "info.json")) == {"fps": 15}
    assert datasets.read_config(str(tmp_path / "info.json")) == {"fps": 15}
    (tmp_path / "c.yaml").write_text("fps: 15\n")
    assert datasets.read_config(str(tmp_path / "c.yaml")) == {"fps": 15}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, x string")
    datasets.write_lines(df, str(tmp_path / "lines"))
    datasets.write_lines(df, str(tmp_path / "lines"))  # nothing is written twice without force
    (tmp_path / "lines" / "bad.json").write_text("{broken\n")
    got = datasets.read_lines(spark, str(tmp_path / "lines"), "id bigint, x string, absent double")
    assert sorted((r.id or 0) for r in got.collect()) == [0, 1, 2]
    (tmp_path / "bin").mkdir()
    (tmp_path / "bin" / "r.dat").write_bytes(b"\x01\x02")
    assert datasets.read_binary(spark, str(tmp_path / "bin"), lambda b: [{"v": x} for x in b], "v bigint").count() == 2
    with pytest.raises(ValueError, match="no reader"):
        datasets.read_plugin(spark, "hdf5", "x")
    assert datasets.filtered(["a1", "b1", "a2"], ["a*", "b*"], ["*2"]) == ["a1", "b1"]
    assert datasets.filtered(["b1", "a2", "a1"], ["a*", "b*"], ["*2"], "include", "include") == ["a2", "a1", "b1"]
    with pytest.raises(ValueError):
        datasets.parse_slices('{"a": [3, 1]}')
    with pytest.raises(ValueError):
        datasets.mixture_paths({"x": ["a"]}, [], set())
    assert datasets.split_name("annotation.language.x") == ("annotation", "language.x")
    assert datasets.plain_names(df.toDF("a.b", "c")).columns == ["a__b", "c"]
    assert datasets.episode_of("data/chunk-000/episode_000007.parquet") == 7
    assert validate.schema_difference(df, {"id": "bigint", "y": "int"}) == [("x", None, "string"), ("y", "int", None)]
