"""Small random frames with everything that can be wrong with them."""

import datetime as dt
import math
import random

SCHEMA = "dataset_path string, robot_id string, episode_index bigint, frame_index bigint, task_index bigint, ts_sec double, joint_position array<double>, joint_velocity array<double>, cartesian_position array<double>, gripper_position double, recorded_at timestamp_ntz, ingested_at timestamp_ntz, source string, _order int, lb string"


def make(seed=0, episodes=6, length=60):
    rng = random.Random(seed)
    rows = []
    t0 = dt.datetime(2025, 1, 1, 5)
    for e in range(episodes):
        robot = rng.choice(["r1", "r2", None])
        j = [rng.uniform(-1, 1) for _ in range(7)]
        c = [rng.uniform(0, 1) for _ in range(6)]
        still = 0
        for f in range(length):
            if rng.random() < 0.05:
                continue
            still = still - 1 if still > 0 else rng.choice([0] * 12 + [rng.randint(2, 25)])
            if still < 12:
                c = [round(x + rng.uniform(0.003, 0.02), 4) for x in c] if not still else c
            if not still:
                j = [round(x + rng.uniform(-0.02, 0.02), 4) for x in j]
            pos = list(j)
            k = rng.randrange(7)
            r = rng.random()
            if r < 0.04:
                pos[k] = rng.choice([None, math.nan, math.inf, 9.9])
            elif r < 0.10:
                pos[k] = round(pos[k] + rng.choice([-1, 1]) * rng.uniform(0.3, 1), 4)
            vel = [round(rng.uniform(-0.1, 0.1), 3) for _ in range(7)]
            g = rng.choice([None, round(0.5 + 0.01 * rng.random(), 4), 0.99, 1.7] if rng.random() < 0.1 else [round(0.5 + 0.01 * rng.random(), 4)])
            row = ("d1" if e % 2 else "d2", robot, e, f, 0, f / 15 if rng.random() > 0.03 else None, None if rng.random() < 0.02 else pos, None if rng.random() < 0.02 else vel, None if rng.random() < 0.03 else list(c), g, t0 + dt.timedelta(hours=7 * e, seconds=f), t0 + dt.timedelta(days=1, seconds=f), "x", 1, "y")
            rows.append(row)
            if rng.random() < 0.05:
                rows.append((*row[:11], row[11] + dt.timedelta(hours=1), *row[12:]))
    rows.append(("d1", "r1", None, 3, 0, 0.0, [0.0] * 7, [0.0] * 7, [0.0] * 6, 0.5, t0, t0, "x", 1, "y"))
    rows.append(("d1", "r1", 0, None, 0, 0.0, [0.0] * 7, [0.0] * 7, [0.0] * 6, 0.5, t0, None, "x", 1, "y"))
    rng.shuffle(rows)
    return rows


def frames(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def once(rows):
    """Rows by episode in frame order, the first ingested of each frame."""
    best = {}
    for r in rows:
        if r[2] is not None and r[3] is not None:
            key = (r[2], r[3])
            if key not in best or r[11] < best[key][11]:
                best[key] = r
    out = {}
    for (e, _), r in sorted(best.items()):
        out.setdefault(e, []).append(r)
    return out
