"""Episodes drawn from several datasets so that each has a target share of the total length.

The episodes of a dataset, in pseudorandom order, are laid end to end and cut into blocks of BLOCK frames. A mixture has as many
slots as its datasets have blocks, or fewer where a small dataset with a large weight would have to be repeated too often.
Every output shard draws how many of its slots go to each dataset from a multinomial of the target shares, conditioned on the
mixture's totals so that chance doesn't move the shares (each shard finds its draw, and what all shards before it drew, by halving the
range of shards, so none needs another's; the law is the same at every size); the k-th slot of a dataset takes, of repeat k div n, the block at place k mod n of a pseudorandom permutation of its n blocks, so a block (and
thereby an episode) comes at most once a repeat, and slots are joined to blocks by number.

Defined cases: a trailing slash of a path is ignored, `*` is a pattern over the datasets that have episodes; a path listed twice
has the sum of its weights and the smaller cap; null, NaN, negative and zero weights are 0; a path without data is reported with
share 0, as is a null path; a spec without mixture_name is left out; a null cap is 1; a spec with distribute_weights divides its weight by length among the datasets it matches, one without
gives it to each; episodes delivered twice count once (their last export), null or non-positive lengths hold no frames.
"""

from __future__ import annotations

import fnmatch
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajecta.operators.prefix import hashed_prefix_sum
from trajecta.session import materialize

BLOCK = 64
SLOTS_A_SHARD = 1024
SEED = 11
#: Specs and datasets are configuration; more than so many rows are refused rather than collected.
CONFIGURATION_ROWS = 100_000
SLOTS = "mixture_name string, shard bigint, slot bigint, dataset_path string, repeat bigint, block bigint"


def permute(j: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of each j in a pseudorandom permutation of range(n): a Feistel network on the next even number of bits, walked until it falls below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x = j.astype("u8")
    todo = np.ones(len(x), bool)
    while todo.any():
        a, b = x[todo] >> np.uint64(half), x[todo] & mask
        for r in range(4):
            with np.errstate(over="ignore"):
                z = (b + np.uint64((key * 1000003 + r * 7919) % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
                z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((z >> np.uint64(32)) & mask)
        x[todo] = a << np.uint64(half) | b
        todo = x >= np.uint64(n)
    return x.astype("i8")


def resolve(spec: list, lengths: dict[str, int]) -> list[dict]:
    """One entry per mixture and dataset: weight, cap, share. lengths: frames of the datasets that have any."""
    out: dict[tuple, dict] = {}
    for r in spec:
        path = (r["dataset_path"] or "").rstrip("/")
        hits = sorted(fnmatch.filter(lengths, path)) if "*" in path else [path]
        w = r["dataset_weight"]
        w = 0.0 if w is None or not math.isfinite(w) or w < 0 else w
        total = sum(lengths.get(h, 0) for h in hits)
        for h in hits:
            part = (lengths.get(h, 0) / total if total else 0.0) if r["distribute_weights"] else 1.0
            e = out.setdefault((r["mixture_name"], h), {"mixture_name": r["mixture_name"], "dataset_path": h, "weight": 0.0, "cap": None})
            cap = 1 if r["max_repeats"] is None else max(0, r["max_repeats"])
            e["weight"] += w * part
            e["cap"] = cap if e["cap"] is None else min(e["cap"], cap)
    for name in {e["mixture_name"] for e in out.values()}:
        own = [e for e in out.values() if e["mixture_name"] == name]
        for e in own:
            e["drawn"] = e["weight"] if lengths.get(e["dataset_path"]) and e["cap"] else 0.0
        total = sum(e["drawn"] for e in own)
        for e in own:
            e["share"] = e["drawn"] / total if total else 0.0
    return list(out.values())


def quotas(entries: list[dict], blocks: dict[str, int]) -> list[int]:
    """Slots of each entry of a mixture: as many in all as there are blocks, or fewer so that no cap is passed; rounded by largest remainder."""
    most = sum(blocks[e["dataset_path"]] for e in entries)
    most = int(min([most, *(blocks[e["dataset_path"]] * e["cap"] / e["share"] for e in entries)]))
    exact = [e["share"] * most for e in entries]
    out = [int(x) for x in exact]
    for k in sorted(range(len(out)), key=lambda i: out[i] - exact[i])[: most - sum(out)]:
        out[k] += 1
    return [min(q, blocks[e["dataset_path"]] * e["cap"]) for q, e in zip(out, entries)]


#: Populations that numpy's hypergeometric takes; larger ones are drawn by `_rejected`, by the same law.
NUMPY_POPULATION = 1_000_000_000


def _log_factorials(a: int, b: int) -> float:
    """ln a! - ln b!, exact to about 1e-9 however large both are."""
    if min(a, b) < 256:
        return math.lgamma(a + 1) - math.lgamma(b + 1)
    d = a - b
    rest = lambda x: (1 / 12 - (1 / 360 - 1 / (1260.0 * x * x)) / (x * x)) / x
    return (b + 0.5) * math.log1p(d / b) + d * math.log(a) - d + rest(a) - rest(b)


def _rejected(rng: np.random.Generator, good: int, bad: int, size: int) -> int:
    """A hypergeometric draw by the ratio of uniforms (Stadlober 1990), with log factorials taken as differences from the mode's."""
    n = good + bad
    p = size / n
    spread = math.sqrt(good * p * (1 - p) * (bad / n) * n / (n - 1) + 0.5)
    center = good * p + 0.5
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    mode = (size + 1) * (good + 1) // (n + 2)
    low, high = max(0, size - bad), min(size, good)
    while True:
        u = rng.random()
        x = math.floor(center + width * (rng.random() - 0.5) / u) if u else low - 1
        if low <= x <= high:
            ratio = -sum(_log_factorials(a + s * x, a + s * mode) for a, s in ((0, 1), (good, -1), (size, -1), (bad - size, 1)))
            if 2 * math.log(u) <= ratio:
                return x


def hypergeometric(rng: np.random.Generator, good: int, bad: int, size: int) -> int:
    """Good ones among size drawn without replacement from good and bad."""
    if not good or not size:
        return 0
    if not bad or size == good + bad:
        return min(size, good)
    if good + bad < NUMPY_POPULATION:
        return int(rng.hypergeometric(good, bad, size))
    return _rejected(rng, good, bad, size)


def _urn(rng: np.random.Generator, quota: list[int], size: int) -> list[int]:
    """How many of size slots, drawn from all, are of each dataset: one margin after the other."""
    out, rest = [], sum(quota)
    for q in quota:
        rest -= q
        got = hypergeometric(rng, q, rest, size)
        out.append(got)
        size -= got
    return out


def shard_counts(quota: list[int], shard: int, shards: int, key: list[int]) -> tuple[list[int], list[int]]:
    """Slots of each dataset in one shard, and in all shards before it."""
    q, before, lo, hi, total = list(quota), [0] * len(quota), 0, shards, sum(quota)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _urn(np.random.default_rng([*key, lo, hi]), q, min(mid * SLOTS_A_SHARD, total) - lo * SLOTS_A_SHARD)
        if shard < mid:
            q, hi = left, mid
        else:
            q, before, lo = [a - b for a, b in zip(q, left)], [a + b for a, b in zip(before, left)], mid
    return q, before


def _pieces(episodes: DataFrame) -> DataFrame:
    """Stretches of episodes in each block: dataset_path, block, episode_index, first_frame, n_frames."""
    last = Window.partitionBy("episode_index").orderBy(F.desc("exported_at"), F.xxhash64("dataset_path", "length"))
    e = episodes.where("episode_index IS NOT NULL AND dataset_path IS NOT NULL").withColumn("_r", F.row_number().over(last)).where("_r = 1 AND length > 0")
    e = e.select(F.regexp_replace("dataset_path", "/+$", "").alias("dataset_path"), "episode_index", "length")
    e = hashed_prefix_sum(e, ["dataset_path"], "episode_index", F.col("length"), SEED, "start")
    e = e.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("length") - 1) / BLOCK))))
    lo = F.greatest(F.col("start"), F.col("block") * BLOCK)
    hi = F.least(F.col("start") + F.col("length"), (F.col("block") + 1) * BLOCK)
    return e.select("dataset_path", "block", "episode_index", (lo - F.col("start")).alias("first_frame"), (hi - lo).alias("n_frames"))


def plan(episodes: DataFrame, spec: DataFrame) -> tuple[DataFrame, list[dict], dict[str, int]]:
    """Pieces (a table), resolved entries and blocks per dataset."""
    pieces = materialize(_pieces(episodes), "p7-pieces")
    sums = pieces.groupBy("dataset_path").agg(F.sum("n_frames").alias("n"), F.max("block").alias("b")).limit(CONFIGURATION_ROWS + 1).collect()
    rows = spec.where("mixture_name IS NOT NULL").select("mixture_name", "dataset_path", "dataset_weight", "distribute_weights", "max_repeats").limit(CONFIGURATION_ROWS + 1).collect()
    if max(len(sums), len(rows)) > CONFIGURATION_ROWS:
        raise ValueError(f"more than {CONFIGURATION_ROWS} datasets or specs")
    return pieces, resolve(rows, {r["dataset_path"]: r["n"] for r in sums}), {r["dataset_path"]: r["b"] + 1 for r in sums}


def drawn_slots(spark, entries: list[dict], blocks: dict[str, int], seed: int = SEED) -> DataFrame:
    """The block that each slot takes."""
    names = sorted({e["mixture_name"] for e in entries})
    own = {n: sorted((e for e in entries if e["mixture_name"] == n and e["share"] > 0), key=lambda e: e["dataset_path"]) for n in names}
    quota = {n: quotas(own[n], blocks) if own[n] else [] for n in names}
    shards = [-(-sum(quota[n]) // SLOTS_A_SHARD) for n in names]
    ends = np.cumsum(shards)
    number = {p: k for k, p in enumerate(sorted(blocks))}

    def draw(batches: Iterator) -> Iterator:
        """Slots of each numbered shard; no shard needs another's."""
        import pyarrow as pa

        for batch in batches:
            for i in batch.column(0).to_pylist():
                m = int(np.searchsorted(ends, i, "right"))
                shard, n, s0 = i - int(ends[m] - shards[m]), names[m], 0
                for e, size, k0 in zip(own[n], *shard_counts(quota[n], shard, shards[m], [seed, m])):
                    if not size:
                        continue
                    path, of = e["dataset_path"], blocks[e["dataset_path"]]
                    k = k0 + np.arange(size)
                    block = np.empty(size, "i8")
                    for r in np.unique(k // of):
                        at = k // of == r
                        block[at] = permute(k[at] % of, of, ((seed * 1009 + m) * 1009 + number[path]) * 1009 + int(r))
                    yield pa.RecordBatch.from_arrays([pa.array([n] * size), pa.array(np.full(size, shard)), pa.array(s0 + np.arange(size)), pa.array([path] * size), pa.array(k // of), pa.array(block)], names=[z.split()[0] for z in SLOTS.split(", ")])
                    s0 += size

    total = int(ends[-1]) if names else 0
    return spark.range(0, total, 1, max(1, min(total, spark.sparkContext.defaultParallelism * 4))).mapInArrow(draw, SLOTS)


def mixture(episodes: DataFrame, spec: DataFrame) -> DataFrame:
    """One row per stretch of an episode in a slot of a mixture."""
    pieces, entries, blocks = plan(episodes, spec)
    return drawn_slots(episodes.sparkSession, entries, blocks).join(pieces, ["dataset_path", "block"])


def _entry_table(spark, entries: list[dict]) -> DataFrame:
    rows = [(e["mixture_name"], e["dataset_path"], float(e["weight"]), float(e["share"]), int(e["cap"])) for e in entries]
    return spark.createDataFrame(rows, "mixture_name string, dataset_path string, weight double, target_share double, max_repeats bigint")


def targets(episodes: DataFrame, spec: DataFrame) -> DataFrame:
    """Weight, target share and cap of each mixture and dataset."""
    return _entry_table(episodes.sparkSession, plan(episodes, spec)[1])


def shares(episodes: DataFrame, spec: DataFrame) -> DataFrame:
    """Of each mixture and dataset: weight, target share, share reached, frames drawn, and the most often an episode's stretch was drawn, beside the cap."""
    pieces, entries, blocks = plan(episodes, spec)
    spark = episodes.sparkSession
    table = _entry_table(spark, entries)
    size = pieces.groupBy("dataset_path", "block").agg(F.sum("n_frames").alias("n"))
    got = drawn_slots(spark, entries, blocks).join(size, ["dataset_path", "block"]).groupBy("mixture_name", "dataset_path").agg(F.sum("n").alias("n_frames"), (F.max("repeat") + 1).alias("most_repeats"))
    out = table.join(got, ["mixture_name", "dataset_path"], "left").na.fill(0, ["n_frames", "most_repeats"])
    total = F.sum("n_frames").over(Window.partitionBy("mixture_name"))
    return out.withColumn("share", F.when(total > 0, F.col("n_frames") / total).otherwise(0.0))
