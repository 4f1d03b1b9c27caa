"""Duplicates, splits and mixtures against brute force."""

import datetime as dt
import random
import unicodedata

import numpy as np
import pytest

from trajecta.llm import duplicates, mixing, splits
from trajecta.operators import joins


def canon(t):
    return "".join(c for c in (t or "") if unicodedata.category(c)[0] in "LN").casefold()


TEXTS = ["Open the drawer", "open, the DRAWER!", "öffne die  Tür", "ÖFFNE DIE TÜR…", "straße 4", "STRASSE 4", "打开抽屉。", "打开 抽屉", "", " \t", None, "...", "x" * 50_000, "X " * 50_000, "Ⅳ ½", "ⅳ½", "not provided"]


def test_duplicates(spark):
    rng = random.Random(2)
    rows = [(k if rng.random() > 0.05 else None, *[rng.choice(TEXTS) for _ in range(3)], "n", 1) for k in range(150)]
    rows += rng.sample(rows, 20)
    df = spark.createDataFrame(rows, "id bigint, a string, b string, c string, _id string, _rows int")
    sets = {}
    for r in rows:
        key = tuple(sorted(x for x in map(canon, r[1:4]) if x))
        if key and r[0] is not None:
            sets.setdefault(key, set()).add(r[0])
    want = {(min(s), x) for s in sets.values() for x in s if x != min(s)}
    got = [tuple(r) for r in duplicates.copies(df, "id", ["a", "b", "c"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    counts = {r.keep_id: (r.n_records, r.n_rows) for r in duplicates.collapsed(df, "id", ["a", "b", "c"]).collect()}
    assert {k: v[0] for k, v in counts.items()} == {min(s): len(s) for s in sets.values()}
    assert sum(v[1] for v in counts.values()) == sum(1 for r in rows if r[0] is not None and any(map(canon, r[1:4])))
    assert duplicates.copies(df.limit(0), "id", ["a"]).count() == 0


def fixture(spark, seed, n=120):
    rng = random.Random(seed)
    tasks = [(k, t) for k, t in enumerate(["not provided", "Not Provided!", "A b", "a  B.", "c", "d", "e", "f", "g", None, " "])] + [(3, "a  B."), (50, "h")]
    names = ["a b", "A B!", "C", "d", "E", "f", "g", "h", "unlisted", "Unlisted too", "not provided", "", None, "?"]
    t0 = dt.datetime(2025, 1, 1)
    rows = []
    for e in range(n):
        ts = None if rng.random() < 0.05 else [rng.choice(names[: 5 if e < 20 else None]) for _ in range(rng.choice([0, 1, 1, 1, 2]))]
        row = (e, rng.choice(["d1", "d1", "d1", "d2", None]), ts, rng.choice([True, False, None]), t0, "x")
        rows += [row] * rng.choice([1, 1, 2])
    rows.append((None, "d1", ["a b"], True, t0, "x"))
    return spark.createDataFrame(rows, "episode_index bigint, dataset_path string, tasks array<string>, success boolean, exported_at timestamp, _n string"), spark.createDataFrame(tasks, "task_index bigint, task string"), rows, tasks


def brute_groups(rows, tasks):
    real = lambda t: canon(t) not in ("", "notprovided")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    eps = {}
    for r in rows:
        if r[0] is not None:
            own = {canon(t) for t in r[2] or [] if real(t)}
            eps.setdefault(r[0], set()).update(own)
            for a in own:
                parent[find(("t", a))] = find(("e", r[0]))
    listed = {}
    for k, t in tasks:
        if t is not None and real(t):
            listed[canon(t)] = min(k, listed.get(canon(t), k))
    out = {}
    for e, own in eps.items():
        if own:
            root = find(("e", e))
            ids = [listed[x] for x in {x for o in eps.values() for x in o} if x in listed and find(("t", x)) == root]
            out[e] = min(ids, default=None)
    return out, {e: find(("e", e)) for e in eps}


@pytest.mark.parametrize("seed", [0, 1])
def test_groups_and_splits(spark, seed):
    episodes, tasks, rows, task_rows = fixture(spark, seed)
    want, roots = brute_groups(rows, task_rows)
    got = [tuple(r) for r in splits.groups(episodes, tasks).collect()]
    assert len(got) == len(want) and dict(got) == want
    out = splits.splits(episodes, tasks).collect()
    assert sorted(r.episode_index for r in out) == sorted(roots)
    by = {}
    for r in out:
        by.setdefault(roots[r.episode_index], set()).add(r.split)
        assert r.split in {"train", "validation", "test"}
    assert all(len(s) == 1 for s in by.values())


def test_long_chain_and_proportions(spark):
    """A chain of episodes is one component; many single ones are divided as asked, label by label."""
    t0 = dt.datetime(2025, 1, 1)
    chain = [(k, "d1", [f"t{k}", f"t{k + 1}"], True, t0) for k in range(60)]
    single = [(100 + k, "d1" if k % 10 else "d2", [f"s{k}"], None, t0) for k in range(900)]
    episodes = spark.createDataFrame(chain + single, "episode_index bigint, dataset_path string, tasks array<string>, success boolean, exported_at timestamp")
    tasks = spark.createDataFrame([(5, "t33"), (7, "t2")], "task_index bigint, task string")
    assert {r.group_task_index for r in splits.groups(episodes, tasks).where("episode_index < 60").collect()} == {5}
    out = splits.splits(episodes, tasks, (("train", 0.6), ("test", 0.4))).collect()
    assert len({r.split for r in out if r.episode_index < 60}) == 1
    train = [r.episode_index for r in out if r.split == "train"]
    assert abs(len(train) - 576) < 15
    d2 = [e for e in train if e >= 100 and e % 10 == 0]
    assert abs(len(d2) - 54) <= 3


def test_nothing_to_split(spark):
    episodes, tasks, *_ = fixture(spark, 0)
    assert splits.groups(episodes.limit(0), tasks).count() == 0
    assert splits.splits(episodes.limit(0), tasks).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 4097])
def test_permutation(n):
    got = mixing.permute(np.arange(n), n, 12345)
    assert sorted(got.tolist()) == list(range(n))
    if n > 60:
        assert (got != mixing.permute(np.arange(n), n, 54321)).any()


def test_shard_counts():
    quota = [1000, 5, 2500, 0, 37]
    shards = -(-sum(quota) // mixing.SLOTS_A_SHARD)
    parts = [np.array(mixing.shard_counts(quota, k, shards, [1, 2])[0]) for k in range(shards)]
    assert np.sum(parts, axis=0).tolist() == quota
    assert all(p.sum() == mixing.SLOTS_A_SHARD for p in parts[:-1])


def test_mixture(spark):
    t0 = dt.datetime(2025, 1, 1)
    rng = random.Random(0)
    rows = [(k, f"data/{'abc'[min(k // 150, 2)]}", rng.choice([0, 1, 30, 100, None]), t0, "x") for k in range(330)]
    episodes = spark.createDataFrame(rows + rows[:10], "episode_index bigint, dataset_path string, length bigint, exported_at timestamp, block string")
    spec = spark.createDataFrame(
        [("m", "data/a/", 1.0, False, 2), ("m", "data/[bx]*", 9.0, False, 2), ("m", "data/b", 0.5, True, 2), ("m", "data/c", 0.25, False, 3), ("m", "data/c/", 0.25, False, 4), ("m", "data/none", 3.0, False, 1), ("m", "data/a", None, False, 9), ("z", "data/a", 0.0, False, 1), (None, "data/a", 1.0, None, 1), ("m", None, 1.0, None, None)],
        "mixture_name string, dataset_path string, dataset_weight double, distribute_weights boolean, max_repeats bigint",
    )
    spec = spec.where("dataset_path <> 'data/[bx]*'")
    length = {k: n for k, _, n, *_ in rows}
    out = mixing.mixture(episodes, spec).collect()
    assert {r.mixture_name for r in out} == {"m"}
    total, frames = {}, {}
    for r in out:
        assert 0 <= r.first_frame and r.first_frame + r.n_frames <= length[r.episode_index]
        total[r.dataset_path] = total.get(r.dataset_path, 0) + r.n_frames
        for f in range(r.first_frame, r.first_frame + r.n_frames):
            frames[r.dataset_path, r.episode_index, f] = frames.get((r.dataset_path, r.episode_index, f), 0) + 1
    cap = {"data/a": 2, "data/b": 2, "data/c": 3}
    assert all(n <= cap[d] for (d, _, _), n in frames.items())
    assert len({(r.shard, r.slot) for r in out}) == len({(r.shard, r.slot, r.dataset_path, r.block, r.repeat) for r in out})
    for r in mixing.shares(episodes, spec).collect():
        if r.mixture_name == "m":
            assert r.n_frames == total.get(r.dataset_path, 0)
            assert r.most_repeats <= r.max_repeats
            assert abs(r.share - r.target_share) < 0.05
            assert abs(r.target_share - {"data/a": 0.5, "data/b": 0.25, "data/c": 0.25}.get(r.dataset_path, 0)) < 1e-9
        else:
            assert r.share == 0
    assert mixing.mixture(episodes.limit(0), spec).count() == 0


def test_pattern():
    got = mixing.resolve([{"mixture_name": "m", "dataset_path": "d/x*/", "dataset_weight": 2.0, "distribute_weights": t, "max_repeats": None} for t in (True, False)], {"d/x1": 30, "d/x2": 10, "d/y": 5})
    assert {e["dataset_path"]: (e["weight"], e["cap"]) for e in got} == {"d/x1": (3.5, 1), "d/x2": (2.5, 1)}


def test_large_populations_are_drawn_by_the_same_law(monkeypatch):
    rng = np.random.default_rng(3)
    for good, bad, size in ((40, 60, 30), (5000, 20000, 700), (900, 3, 500)):
        want = rng.hypergeometric(good, bad, size, 6000)
        monkeypatch.setattr(mixing, "NUMPY_POPULATION", 0)
        got = np.array([mixing.hypergeometric(rng, good, bad, size) for _ in range(6000)])
        both = np.unique(np.concatenate([want, got]))
        cells = np.unique(np.quantile(want, np.linspace(0, 1, 12)))
        a, b = (np.histogram(x, [both[0] - 1, *cells, both[-1] + 1])[0] for x in (got, want))
        assert ((a - b) ** 2 / np.maximum(a + b, 1)).sum() < 40
    n = 10**13
    got = np.array([mixing.hypergeometric(rng, 3 * n // 10, 7 * n // 10, n // 2) for _ in range(4000)])
    assert abs(got.mean() - 0.15 * n) < 5 * got.std() / 4000**0.5
    assert abs(got.std() / (n * 0.5 * 0.3 * 0.7 * 0.5) ** 0.5 - 1) < 0.06


def test_shards_add_up_and_know_what_came_before():
    quota = [5000, 1, 0, 3300]
    shards = -(-sum(quota) // mixing.SLOTS_A_SHARD)
    seen = [0] * 4
    for k in range(shards):
        got, before = mixing.shard_counts(quota, k, shards, [1, 2])
        assert before == seen
        assert sum(got) == min(mixing.SLOTS_A_SHARD, sum(quota) - k * mixing.SLOTS_A_SHARD)
        seen = [a + b for a, b in zip(seen, got)]
    assert seen == quota


@pytest.fixture
def hot(monkeypatch):
    """Every popular key counts as hot, as it would among billions of rows."""
    monkeypatch.setattr(joins, "LEAST_HOT", 2)
    monkeypatch.setattr(joins, "HOT_KEYS", 12)


def test_hot_texts_and_tasks(spark, hot):
    test_duplicates(spark)
    test_groups_and_splits(spark, 1)
    test_long_chain_and_proportions(spark)


def test_the_rarest_label_comes_first():
    """Twenty groups of a rare label and many of a common one, under one label each and the same outcome."""
    vectors = {f"r{k}": {"rare": 1, "yes": 1} for k in range(20)} | {f"c{k}": {"common": 3, "yes": 3} for k in range(300)} | {"both": {"rare": 5, "common": 400, "yes": 405}}
    got = splits.stratified(vectors)
    part = lambda label, s: sum(v.get(label, 0) for g, v in vectors.items() if got[g] == s)
    for label, total in (("rare", 25), ("common", 1300), ("yes", 1325)):
        for s, p in splits.PROPORTIONS:
            assert abs(part(label, s) - p * total) <= 3
    assert set(got) == set(vectors) and splits.stratified({}) == {}


def test_many_labels_keep_their_shares(spark):
    """Seventy datasets of fifty episodes each: every one is stratified, none is lumped with others."""
    t0 = dt.datetime(2025, 1, 1)
    rows = [(70 * k + d, f"d{d}", [f"only {70 * k + d}"], k % 3 == 0, t0) for k in range(50) for d in range(70)]
    episodes = spark.createDataFrame(rows, "episode_index bigint, dataset_path string, tasks array<string>, success boolean, exported_at timestamp")
    got = splits.shares(episodes, spark.createDataFrame([], "task_index bigint, task string")).collect()
    assert len(got) == 3 * 73
    assert all(abs(r.share - r.target_share) <= 0.025 for r in got)
    assert sum(r.n for r in got if r.label == "all") == 3500
