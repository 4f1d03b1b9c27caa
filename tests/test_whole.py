"""Queries do the whole job: every row, dim and token, and what an earlier cut gave is still part of it."""

import hashlib
import math
import os
import re

import pytest
from pyspark.sql import functions as F

from compare import SMALL, views
from trajecta.functions import text
from trajecta.plans import registry

QUERIES = registry.queries()
tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_formalized_as_in_python(spark):
    given = ["Grüße, Çà & Là!", "数到3。【左】", "a b　c d.", "tab\tline\nvt\x0bfs\x1cnel\x85", "снять—крышку", "x_1", "", " ", None]
    want = [None if t is None else re.sub(r"[^\w\s]", "", t.lower()) for t in given]
    x = spark.createDataFrame(list(enumerate(given)), "k int, t string").select("k", text.formalized(F.col("t")).alias("t"))
    assert [r.t for r in x.orderBy("k").collect()] == want


@tables
def test_formalize_text_has_every_task(spark):
    rows = views(SMALL).execute("SELECT DISTINCT task_index, task FROM tasks").fetchall()
    want = {(k, None if t is None else re.sub(r"[^\w\s]", "", t.lower())) for k, t in rows}
    got = [tuple(r) for r in QUERIES["formalize_text"](spark, SMALL).select("task_index", "task").collect()]
    assert len(got) == len(rows) and set(got) == want
    assert any(t and not t.isascii() for _, t in got) and any(t is None for _, t in rows) == any(t is None for _, t in got)


@tables
def test_tokenize_has_every_word(spark):
    want = {}
    for k, t in views(SMALL).execute("SELECT doc_id, text FROM documents").fetchall():
        w = [x for x in re.split(r"[ \t\n\x0b\f\r]+", t or "") if x]
        padded = (w + [""] * 512)[:512]
        want[k] = (len(w), min(len(w), 512), 512, *(hashlib.md5(" ".join(x).encode()).hexdigest() for x in (w, padded)))
    got = {r.doc_id: (r.words, r.n, r.width, r.words_md5, r.tokens_md5) for r in QUERIES["tokenize"](spark, SMALL).collect()}
    assert got == want and max(w[0] for w in want.values()) > 512


@tables
def test_feature_stats_has_every_float_value(spark):
    """A dataset's counts and means of all six features, in Python."""
    rows = views(SMALL).execute("SELECT dataset_path, ts_sec, joint_position, joint_velocity, cartesian_position, gripper_position, next_reward FROM frames").fetchall()
    names = ["ts_sec", "joint_position", "joint_velocity", "cartesian_position", "gripper_position", "next_reward"]
    values = {}
    for path, *row in rows:
        for name, x in zip(names, row):
            for k, v in enumerate(x if isinstance(x, list) else [x] if x is not None else []):
                if v is not None and math.isfinite(v):
                    values.setdefault((path, name, k), []).append(v)
    got = {(r.dataset_path, r.feature, r.dim): r for r in QUERIES["feature_stats"](spark, SMALL).collect()}
    assert set(got) == set(values) and {(f, k) for _, f, k in got} == {(f, k) for f, n in zip(names, (1, 7, 7, 6, 1, 1)) for k in range(n)}
    for key, v in values.items():
        r = got[key]
        assert r.n == len(v) and abs(r["mean"] - math.fsum(v) / len(v)) < 1e-5 and abs(r["min"] - min(v)) < 1e-6 and abs(r["max"] - max(v)) < 1e-6


def _lengths():
    return dict(views(SMALL).execute("SELECT user_id, count(*) FROM events GROUP BY 1").fetchall())


@tables
def test_needed_frames_of_every_start(spark):
    got = {}
    for r in QUERIES["needed_frames"](spark, SMALL).orderBy("place").collect():
        got.setdefault(r.episode_index, []).append(r.needed)
    assert got == {e: sorted({f + k for f in range(n) if f <= n - 8 for k in (-8, 0, 8) if 0 <= f + k < n}) for e, n in _lengths().items()}
    # the rows of every twentieth start are part of it
    assert all({f + k for f in range(0, n, 20) for k in (-8, 0, 8) if 0 <= f + k < n} <= set(got[e]) for e, n in _lengths().items())


@tables
def test_ranges_and_intervals_of_every_episode(spark):
    frames = {}
    for r in QUERIES["idle_range_filter"](spark, SMALL).orderBy("new_frame").collect():
        frames.setdefault(r.episode_index, []).append((r.ordinal, r.frame_index))
    assert frames == {e: [(0, f) for f in range(n // 2, n * 3 // 4)] + [(1, f) for f in range(n // 8, (n * 5 + 7) // 8)] for e, n in _lengths().items()}

    names = {(r.episode_index, r.frame_index): r.name for r in QUERIES["interval_label"](spark, SMALL).collect()}
    want = {}
    for e, n in _lengths().items():
        for f in range(n):
            want[e, f] = "N/A"
            for name, lo, hi in (("reach", 0, n // 4), ("grasp", n // 5, n // 2), ("lift", n // 6, n * 2 // 5), ("rest", n * 3 // 5, n)):
                if lo <= f < hi:
                    want[e, f] = name
    assert names == want


@tables
def test_anchors_up_to_five(spark):
    """The walk from each start, back before forward, in Python."""
    got = {}
    for r in QUERIES["chunk_anchors_video"](spark, SMALL).orderBy("number").collect():
        got.setdefault((r.episode_index, r.first), []).append(r.anchor)
    want = {}
    for e, n in _lengths().items():
        label = lambda f, e=e: 0 if e % 3 == 0 else f // 60
        for first in range(n):
            kept, open_sides = [first] if first + 23 < n else [], {-1, 1}
            for k in range(1, n):
                for side in (-1, 1):
                    a = first + side * 24 * k
                    if side in open_sides and (a < 0 or a >= n or label(a) != label(first)):
                        open_sides.discard(side)
                    elif side in open_sides and a + 23 < n:
                        kept.append(a)
            if kept:
                want[e, first] = sorted(kept[:5])
    assert got == want and max(map(len, got.values())) > 2


@tables
def test_relative_statistics_of_whole_action_chunks(spark):
    lengths = _lengths().values()
    got = {r.h: r.n for r in QUERIES["relative_stats_per_horizon"](spark, SMALL).collect()}
    assert got == {h: sum(n - 23 for n in lengths) for h in range(24)}
    assert QUERIES["relative_stats_pooled_loader"](spark, SMALL).head().n == 24 * sum(n - 23 for n in lengths)
    assert QUERIES["relative_stats_pooled_converter"](spark, SMALL).head().n == 24 * sum(n - 24 for n in lengths)
