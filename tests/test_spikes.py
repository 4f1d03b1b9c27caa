import math

import numpy as np
import pytest

from frames_fixture import frames, make, once
from trajecta.operators import spikes
from trajecta.operators.spikes import COLUMNS

LIMITS = {"d1": {"joint_position": (-3.1, 3.1), "gripper_position": (0.0, 1.0)}, "d2": {"joint_position": (-2.8, 2.8), "gripper_position": (0.0, 0.85)}}


def value(row, name, dim):
    v = row[{"joint_position": 6, "joint_velocity": 7, "gripper_position": 9}[name]]
    return v if name == "gripper_position" else None if v is None else v[dim]


def brute(rows):
    eps = once(rows)
    found, series, changes = set(), {}, {}
    for e, rs in eps.items():
        for name, dim in COLUMNS:
            good = []
            for r in rs:
                v = value(r, name, dim)
                if v is None:
                    continue
                lo, hi = LIMITS[r[0]].get(name, (-math.inf, math.inf))
                if not math.isfinite(v) or v < lo or v > hi:
                    found.add((e, r[3], name, dim))
                else:
                    good.append((r[3], v, r[1], r[0]))
            series[e, name, dim] = good
            for a, b in zip(good, good[1:]):
                changes.setdefault((b[2], name, dim), []).append(abs(b[1] - a[1]))
    for (e, name, dim), good in series.items():
        for t, (f, v, robot, path) in enumerate(good):
            cut = 0.1 * LIMITS[path]["gripper_position"][1] if name == "gripper_position" else 6 * np.percentile(changes.get((robot, name, dim), [math.inf]), 95)
            for i in (1, 2, 3):
                for j in (1, 2, 3):
                    if i + j <= 4 and t - i >= 0 and t + j < len(good):
                        p, q = v - good[t - i][1], v - good[t + j][1]
                        if min(p, q) > cut or min(-p, -q) > cut:
                            found.add((e, f, name, dim))
    for e, rs in eps.items():
        for name, dim in COLUMNS:
            run = [0]
            for t in range(1, len(rs) + 1):
                linked = False
                if t < len(rs):
                    a, b = value(rs[t - 1], name, dim), value(rs[t], name, dim)
                    c, d = rs[t - 1][8], rs[t][8]
                    linked = a is not None and a == b and c is not None and d is not None and any(abs(x - y) > 0.002 for x, y in zip(c, d))
                if linked:
                    run.append(t)
                    continue
                if len(run) >= 15 and max(changes.get((rs[run[0]][1], name, dim), [0])) > 0:
                    found |= {(e, rs[k][3], name, dim) for k in run}
                run = [t]
    return found


def tables(spark):
    d = spark.createDataFrame([("d1", "t1", "x"), ("d2", "t2", "x")], "dataset_path string, embodiment_tag string, source string")
    rows = [(f"t{p[1]}", f, lo, hi) for p, fs in LIMITS.items() for f, (lo, hi) in fs.items()] + [("t1", "joint_velocity", None, None)]
    return d, spark.createDataFrame(rows, "embodiment_tag string, feature_key string, range_min double, range_max double")


@pytest.mark.parametrize(("seed", "chunk"), [(0, 65536), (1, 16), (2, 5), (3, 33)])
def test_like_brute_force(spark, seed, chunk):
    rows = make(seed)
    for r in rows:  # a joint that freezes while the arm goes on
        if r[2] == 1 and r[3] is not None and 20 <= r[3] < 45 and r[6]:
            r[6][2] = 0.123
    flags = spikes.implausible_readings(frames(spark, rows), *tables(spark), chunk=chunk)
    got = [tuple(r) for r in spikes.found(flags).collect()]
    want = brute(rows)
    assert len(got) == len(set(got))
    assert set(got) == want
    assert any(n == "joint_position" for _, _, n, _ in want)


def test_unknown_and_null_datasets_have_no_limits(spark):
    rows = [(None if k % 2 else "other", "r1", 1, k, 0, None, [50.0 + 0.01 * (k % 3)] * 7, None, None, 7.0, None, None, "x", None, None) for k in range(20)]
    rows[4] = (*rows[4][:6], [float("inf")] * 6 + [None], *rows[4][7:])
    flags = spikes.implausible_readings(frames(spark, rows), *tables(spark))
    assert {tuple(r) for r in spikes.found(flags).collect()} == {(1, 4, "joint_position", k) for k in range(6)}


def test_empty(spark):
    flags = spikes.implausible_readings(frames(spark, []), *tables(spark))
    assert spikes.found(flags).collect() == []


def test_excursion():
    seg = np.zeros(6, int)
    x = np.array([0.0, 0, 5, 5, 0, 0])
    assert spikes.excursion(x, seg).tolist()[2:4] == [5.0, 5.0]
    assert spikes.excursion(np.array([1.0]), seg[:1])[0] == -np.inf


def test_the_fitted_cutoff_decides_what_is_judged():
    rng = np.random.default_rng(5)
    exc, usual, limit = rng.lognormal(0, 2, 5000), rng.choice([0.1, 0.3, 1e6], 5000), rng.choice([7.0, 90.0, np.inf], 5000)
    exc[:10] = -np.inf
    residual, lowered = exc - usual, limit - usual
    count = [len(spikes.candidates(residual, np.full(5000, s), lowered)) for s in (-2e6, -5.0, 0.5, 3.0, 8.0, 1e9)]
    assert count[0] == 4990 and count == sorted(count, reverse=True) and len(set(count)) == 6
    for s in (-5.0, 0.5, 8.0, 1e9):
        kept = set(spikes.candidates(residual, np.full(5000, s), lowered))
        assert set(np.flatnonzero(exc > limit)) <= kept


def test_cutoffs(spark):
    got = {(r.robot_id, r.field_name, r.dim): r for r in spikes.cutoffs(frames(spark, make(0)), *tables(spark)).collect()}
    assert all(r.screen is None or r.tail_cutoff >= r.screen >= r.threshold for r in got.values())
    assert any(r.screen is not None and not r.screen_lowered for r in got.values() if r.rule)
