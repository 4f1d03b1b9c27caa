"""Sequential procedures against their closed forms, on random cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajecta.operators import filters, joins, sampling, shards, stats, windows
from trajecta.operators.prefix import hashed_prefix_sum, running


def walk(labels, first, most):
    """Anchors out from first in turns, back before forward; a side ends at the bound or at another label."""
    n, found = len(labels), []
    back = forth = True
    k = 0
    if first + 23 < n:
        found.append(first)
    while back or forth:
        k += 1
        for side in (-1, 1):
            if (back if side < 0 else forth) is False:
                continue
            a = first + side * 24 * k
            if a < 0 or a >= n or labels[a] != labels[first]:
                if side < 0:
                    back = False
                else:
                    forth = False
            elif a + 23 < n and len(found) < most:
                found.append(a)
    return sorted(found)


def video(anchors, n):
    out = [a + o for a in anchors for o in range(0, 24, 3)]
    if not out:
        return []
    if anchors[-1] + 24 < n:
        return [*out, anchors[-1] + 24]
    return out[:-7] if len(out) > 8 else []


def test_chunks(spark):
    rng = random.Random(1)
    eps = {}
    for e in range(6):
        labels = []
        while len(labels) < rng.randint(60, 260):
            labels += [rng.choice("ab")] * rng.randint(1, 120)
        eps[e] = labels
    rows = [(e, f, len(ls), x) for e, ls in eps.items() for f, x in enumerate(ls)]
    s = spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, length bigint, label string")
    anchors = windows.chunk_anchors(s, "label", 3)
    got = {}
    for r in anchors.collect():
        got.setdefault((r.episode_index, r.first), []).append(r.anchor)
    frames = {}
    for r in windows.video_frames(anchors, s).collect():
        frames.setdefault((r.episode_index, r.first), []).append(r.frame_index)
    actions = {}
    for r in windows.action_anchors(anchors, s).collect():
        actions.setdefault((r.episode_index, r.first), []).append(r.anchor)
    for e, ls in eps.items():
        for f in range(len(ls)):
            want = walk(ls, f, 3)
            assert sorted(got.get((e, f), [])) == want
            pictures = video(want, len(ls))
            assert sorted(frames.get((e, f), [])) == pictures
            if pictures:
                assert sorted(actions.get((e, f), [])) == want[: (len(pictures) - 1) // 8]


@pytest.mark.parametrize("seed", range(4))
def test_balanced_shards(spark, seed):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 1, 5, 20, 90, 400]) for _ in range(60)]
    total = max(sum(lengths), 1)
    n = max(1, -(-sum(lengths) // 100))
    shard, c, want = 0, 0, []
    for x in lengths:
        want.append(shard)
        c += x
        if c * n > total * (shard + 1):  # past the cutoff; at most one step an episode
            shard += 1
    df = spark.createDataFrame([(k * 3000, x) for k, x in enumerate(lengths)], "episode_index bigint, length bigint")
    got = [r.shard for r in shards.balanced_shards(df, 100).orderBy("episode_index").collect()]
    assert got == want


def test_prefix_sums(spark):
    rng = random.Random(3)
    rows = [(g, k, rng.randint(0, 9)) for g in "ab" for k in range(500)]
    df = spark.createDataFrame(rows, "g string, k bigint, v bigint")
    got = hashed_prefix_sum(df, ["g"], "k", F.col("v"), 5, "s").collect()
    for g in "ab":
        own = sorted((r.s, r.v) for r in got if r.g == g)
        assert own[0][0] == 0 and all(b[0] == a[0] + a[1] or a[1] == 0 for a, b in zip(own, own[1:]))
    one = df.where("g = 'a'")
    r1 = running(one, F.floor(F.col("k") / 64), ["k"], {"s": ("v", "sum"), "m": ("v", "min")}).orderBy("k").collect()
    vs = [r.v for r in r1]
    assert [r.s for r in r1] == np.cumsum(vs).tolist() and [r.m for r in r1] == np.minimum.accumulate(vs).tolist()
    r0 = running(one, F.floor(F.col("k") / 64), ["k"], {"s": ("v", "sum")}, upto_row=False).orderBy("k").collect()
    assert [r.s for r in r0] == [0, *np.cumsum(vs).tolist()[:-1]]


def test_edges_of_episodes(spark):
    """Empty table; episodes of one row, of the horizon, one fewer."""
    rows = [(e, f, float(f)) for e, n in enumerate((1, 4, 3)) for f in range(n)]
    df = spark.createDataFrame(rows, "episode_index bigint, frame_index bigint, value double")
    loader = stats.relative_values(df, "value", "value", 4).collect()
    assert {(r.episode_index, r.frame_index, r.h, r.value) for r in loader} == {(1, 0, h, float(h)) for h in range(4)}
    assert stats.relative_values(df, "value", "value", 4, "converter").count() == 0
    assert stats.relative_values(df.limit(0), "value", "value", 4).count() == 0
    w = {(r.episode_index, r.frame_index): r.window for r in windows.gathered(df, "value", [-2, 0, 5]).collect()}
    assert w[0, 0] == [0.0, 0.0, 0.0] and w[1, 1] == [0.0, 1.0, 3.0]
    z = {(r.episode_index, r.frame_index): r.window for r in windows.gathered(df, "value", [-2, 1], "zero").collect()}
    assert z[1, 3] == [1.0, 0.0]
    assert filters.allowed_starts(df, "episode_index", "frame_index", 3).count() == 3
    assert filters.long_enough(df, "episode_index", 3).count() == 4


def test_merged_stats(spark):
    rows = [("a", 0, 1.0, 2.0, -1.0, 4.0, 0.0, 3.0, 1.0), ("b", 0, 3.0, 0.0, 3.0, 3.0, 3.0, 3.0, 3.0)]
    df = spark.createDataFrame(rows, "d string, dim int, mean double, std double, min double, max double, q01 double, q99 double, w double")
    m = stats.merged_stats(df, ["dim"], "w").head()
    assert (m["mean"], m["min"], m["max"], m["q01"], m["q99"]) == (2.5, -1.0, 4.0, 0.0, 3.0)
    assert abs(m["std"] - (0.25 * 5 + 0.75 * 9 - 6.25) ** 0.5) < 1e-12
    assert stats.merged_stats(df, ["dim"], "w", "weighted_average").head()["q01"] == 2.25
    with pytest.raises(ValueError):
        stats.merged_stats(df, ["dim"], "w", "mean")


def test_intervals_and_lookup(spark):
    s = spark.createDataFrame([(0, f) for f in range(150)], "episode_index bigint, frame_index bigint")
    i = spark.createDataFrame([(0, 0, -3, 70, "a"), (0, 1, 60, 10**9, "b"), (0, 2, 65, 66, "c"), (0, 3, None, 9, "d"), (0, 4, 9, 5, "e")], "episode_index bigint, ordinal int, start bigint, end bigint, name string")
    got = [r.name for r in joins.interval_labels(s, i, "episode_index", "frame_index", "name").orderBy("frame_index").collect()]
    assert got == ["c" if f == 65 else "b" if f >= 60 else "a" for f in range(150)]
    d = spark.createDataFrame([(1, "x")], "id bigint, text string")
    with pytest.raises(Exception, match="unknown id"):
        joins.looked_up(spark.createDataFrame([(1,), (2,)], "id bigint"), d, "id", "text").collect()
    with pytest.raises(Exception, match="without range list"):
        filters.without_idle(spark.createDataFrame([(None,)], "r array<int>"), "r").collect()


def test_draws_follow_shares(spark):
    items = sampling.cumulative(spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.0), ("d", 0.2)], "name string, share double"), "name", "share")
    got = {r["name"]: r["count"] for r in sampling.drawn(4000, items, 1).groupBy("name").count().collect()}
    assert sum(got.values()) == 4000 and abs(got["a"] - 2000) < 200 and "c" not in got
    with pytest.raises(ValueError):
        sampling.part_of_each(items, "name", "name", 1, 1.5, 3)
    with pytest.raises(ValueError):
        windows.sequential_split(items, "share", [("a", 0.5)], 4)
