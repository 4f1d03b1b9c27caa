"""Runs and percentiles against brute force on small dirty frames."""

import math

import numpy as np
import pytest

from frames_fixture import frames, make, once
from trajecta.llm import percentiles, runs


def vector(r):
    return [*(r[6] or [None] * 7), *(r[8] or [None] * 6), r[9]]


def near(a, b):
    return all(x is not None and y is not None and math.isfinite(x) and math.isfinite(y) and abs(x - y) <= 0.002 for x, y in zip(vector(a), vector(b)))


def brute_runs(rows):
    out = set()
    for e, rs in once(rows).items():
        start = 0
        for t in range(1, len(rs) + 1):
            if t == len(rs) or not near(rs[t - 1], rs[t]):
                if t - start > 1:
                    a, b = rs[start], rs[t - 1]
                    out.add((e, a[3], b[3], t - start, None if a[5] is None or b[5] is None else b[5] - a[5]))
                start = t
    return out


@pytest.mark.parametrize(("seed", "chunk"), [(0, 65536), (1, 10), (2, 3), (3, 1)])
def test_runs(spark, seed, chunk):
    rows = make(seed)
    got = [tuple(r) for r in runs.near_identical_runs(frames(spark, rows), chunk=chunk).collect()]
    want = brute_runs(rows)
    assert want and len(got) == len(want) and set(got) == want


def test_no_rows(spark):
    assert runs.near_identical_runs(frames(spark, [])).count() == 0
    assert percentiles.percentiles(percentiles.merge(percentiles.sketch(frames(spark, [])))).count() == 0


@pytest.mark.parametrize("by_day", [False, True])
def test_percentiles(spark, by_day):
    rows = make(7)
    got = percentiles.percentiles(percentiles.merge(percentiles.sketch(frames(spark, rows), by_day=by_day))).collect()
    values = {}
    for rs in once(rows).values():
        for r in rs:
            for name, width in percentiles.FIELDS:
                v = r[{"cartesian_position": 8, "gripper_position": 9, "joint_position": 6, "joint_velocity": 7}[name]]
                for dim in range(width):
                    x = v if name == "gripper_position" else v[dim] if v else None
                    if x is not None and math.isfinite(x):
                        values.setdefault((r[0], name, dim), []).append(x)
    assert len(got) == len(values)
    for r in got:
        x = np.sort(values[r.dataset_path, r.feature_key, r.dim])
        assert r.n == len(x)
        for q, p in (("median", 0.5), ("q01", 0.01), ("q99", 0.99)):
            k = p * (len(x) - 1)
            a, b = x[math.floor(k)], x[math.ceil(k)]
            part = k - math.floor(k)
            most = percentiles.RELATIVE_ERROR * (abs(a) * (1 - part) + abs(b) * part) + 1e-12
            assert abs(r[q] - (a * (1 - part) + b * part)) <= most


def test_merge_of_parts(spark):
    """Sketches of two halves of the frames, added, are the sketch of all."""
    rows = make(8)
    own = [r for r in rows if r[2] is not None and r[3] is not None]
    halves = [percentiles.sketch(frames(spark, [r for r in own if r[2] % 2 == k])) for k in (0, 1)]
    key = lambda r: str(r)
    parts = sorted(percentiles.merge(halves[0].unionByName(halves[1])).collect(), key=key)
    assert parts == sorted(percentiles.merge(percentiles.sketch(frames(spark, own))).collect(), key=key)


def test_bucket_error():
    v = np.concatenate([np.random.default_rng(0).lognormal(0, 5, 1000), [1e-300, 1e300, 1.0]])
    v = np.concatenate([v, -v, [0.0]])
    c = percentiles.bucket_codes(v, 0.01)
    g = 1.01 / 0.99
    back = np.where(c == 0, 0, np.sign(c) * 2 * np.exp((np.abs(c) - percentiles.OFFSET) * math.log(g)) / (g + 1))
    assert (np.abs(back - v) <= 0.01 * np.abs(v) * (1 + 1e-9)).all()
    assert (np.diff(c[np.argsort(v)]) >= 0).all()


def test_events_are_canonical():
    """Equal poses have one symbol wherever they come; what the expression finds needs no comparison, what lies across a border does."""
    a, b = np.full(14, 0.5), np.full(14, 0.7)
    x = np.stack([a, a + 1e-5, b, a, a, a + 3.0, np.full(14, np.nan), np.full(14, np.nan), np.full(14, 1e12), np.full(14, 1e12)])
    n = runs.events(x)
    assert n[0] == n[1] == n[3] == n[4] and len({n[0], n[2], *n[5:]}) == 7
    assert runs.repetitions(n) == [(0, 2), (3, 5)]
    assert runs.spans(x, n) == [(0, 2), (3, 5), (8, 10)]  # huge poses have no cell, they are compared
    creep = np.cumsum(np.full((400, 14), 0.0015), axis=0)
    n = runs.events(creep)
    assert 0 < sum(j - i for i, j in runs.repetitions(n)) < 400 and runs.spans(creep, n) == [(0, 400)]
    jump = creep.copy()
    jump[200:] += 0.0006
    assert runs.spans(jump, runs.events(jump)) == [(0, 200), (200, 400)]


def test_cells_are_narrower_than_the_tolerance():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-4000, 4000, (30000, 1)) * 0.002 + rng.choice([0, 1e-12, -1e-12, 0.0019, 0.00199], (30000, 1)), rng.uniform(-1e9, 1e9, (3000, 1)).repeat(2, axis=0) + rng.uniform(0, 0.003, (6000, 1))])
    x = x[np.argsort(x[:, 0])]
    n = runs.events(x)
    same = n[1:] == n[:-1]
    assert same.any() and runs._near(x[1:], x[:-1])[same].all()
