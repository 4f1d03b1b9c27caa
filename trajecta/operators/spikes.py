"""Implausible readings per source: impossible values, tail excursions, stuck values.

The statistic of a reading is its excursion: how far it stands out, on one side, from a reading before and one after
within four rows. Per source (robot_id), field and dim the excursions, less the usual level of the source's time of
day, have a generalized Pareto fitted to their peaks over a high threshold, which gives a cutoff for any risk. Readings beyond the
cutoff of risk SCREEN are candidates; the rule of the data (six times the 95th percentile of the change between successive
readings, or a tenth of range_max) is judged on candidates alone. Readings beyond the far cutoff of risk RISK are tail readings. Where
a fit lies so high that a case of the rule could stay below the screen, the screen is lowered to the rule's own limit less the level.

Plan: one shuffle of compressed blocks (functions.packing), kept as a table in the shared folder; the 95th percentile
is exact, by counts in 5 % wide buckets and then the values of the deciding bucket. Long episodes are spread over many
blocks, and readings near the border of two blocks are judged again on the rows around it.

Defined cases: rows without episode_index or frame_index are left out; of several copies of a frame the first ingested
counts; null readings never are cases and are stepped over; a null robot_id is a source of its own; unknown
dataset_path or null bounds mean no limit; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajecta.functions.packing import CHUNK, Block, bucket_count, is_null, packed, per_bucket
from trajecta.session import materialize, scratch

#: The readings judged, in the order of the packed columns.
FIELDS = (("joint_position", 7), ("joint_velocity", 7), ("gripper_position", 1))
COLUMNS = [(name, dim) for name, width in FIELDS for dim in range(width)]
GRIPPER = len(COLUMNS) - 1
N = len(COLUMNS)
REACH = 3
STUCK_ROWS = 15
MOVE = 0.002
FACTOR, QUANTILE, GRIPPER_PART = 6.0, 0.95, 0.1
SEASONS, SEASON_HOURS = 4, 6
CHANGE_WIDTH, EXCURSION_WIDTH = np.log(1.05), np.log(1.1)
#: Datasets whose limits are broadcast (about 100 bytes each); with more the join is left to the optimizer.
BROADCAST_DATASETS = 100_000
PEAK_SHARE, SCREEN, RISK = 0.02, 0.01, 1e-4
ZERO = -(2**31)
NO_SOURCE = "\0"

STATS = "kind int, source string, col int, season int, lb int, cnt bigint, episode bigint, chunk bigint, payload binary"
FLAGS = "episode_index bigint, frame_index bigint, field_name string, dim bigint, value double, residual double, impossible boolean, spike boolean, stuck boolean, tail boolean"


def _buckets(v: np.ndarray, width: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(v > 0, np.floor(np.log(np.where(v > 0, v, 1)) / width), ZERO).astype("i8")


def _judged(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Readings, which of them are impossible, which are neither that nor null."""
    x = b.m[:, :N]
    lim = b.m[:, N + 6 : N + 12]
    rep = np.repeat([0, 1, 2], [w for _, w in FIELDS])
    lo, hi = lim[:, 0::2][:, rep], lim[:, 1::2][:, rep]
    null = is_null(x)
    with np.errstate(invalid="ignore"):
        bad = ~null & (~np.isfinite(x) | (x < lo) | (x > hi))
    return x, bad, ~null & ~bad


def _units(b: Block, chunk: int) -> np.ndarray:
    """Number of the (episode, block of frames) of each row."""
    part = np.floor_divide(b.fr, chunk)
    new = np.ones(len(b.ep), bool)
    new[1:] = (b.ep[1:] != b.ep[:-1]) | (part[1:] != part[:-1])
    return np.cumsum(new)


def excursion(x: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """Largest distance by which each reading stands out, on one side, from one i rows before and one j rows after, i + j <= 4; -inf without such."""
    out = np.full(len(x), -np.inf)
    for sign in (1.0, -1.0):
        before, after = [], []
        for k in range(1, REACH + 1):
            p, q = np.full(len(x), -np.inf), np.full(len(x), -np.inf)
            if len(x) > k:
                same = seg[k:] == seg[:-k]
                d = sign * (x[k:] - x[:-k])
                p[k:][same] = d[same]
                q[:-k][same] = -d[same]
            before.append(np.maximum(before[-1], p) if before else p)
            after.append(np.maximum(after[-1], q) if after else q)
        for i in range(REACH):
            out = np.maximum(out, np.minimum(before[i], after[REACH - 1 - i]))
    return out


def _changes(x: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of the later reading) and absolute changes between successive readings of a segment."""
    at = np.flatnonzero(seg[1:] == seg[:-1]) + 1
    return at, np.abs(x[at] - x[at - 1])


def _runs(link: np.ndarray) -> np.ndarray:
    """Length in rows of the chain of linked successive rows that each row is in."""
    ids = np.concatenate([[0], np.cumsum(~link)])
    return np.bincount(ids)[ids]


def _moving(b: Block) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return (np.abs(np.diff(b.m[:, N : N + 6], axis=0)) > MOVE).any(axis=1)


def _count(*cols: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of integer columns, and how often each occurs."""
    at = np.lexsort(cols[::-1])
    cols = [c[at] for c in cols]
    new = np.ones(len(at), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    starts = np.flatnonzero(new)
    return [c[starts] for c in cols], np.diff(np.append(starts, len(at)))


def _stat_rows(kind: int, names: list, source, season, lb, cnt, col: int):
    import pyarrow as pa

    n = len(cnt)
    nulls = lambda t: pa.nulls(n, t)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, "i4")), pa.array([names[k] for k in source], pa.string()), pa.array(np.full(n, col, "i4")), pa.array(season.astype("i4")), pa.array(lb.astype("i4")), pa.array(cnt.astype("i8")), nulls(pa.int64()), nulls(pa.int64()), nulls(pa.binary())], names=[x.split()[0] for x in STATS.split(", ")])


def _blob_rows(kind: int, source: list, episode: list, chunk: list, blobs: list[bytes]):
    import pyarrow as pa

    n = len(blobs)
    i4 = pa.nulls(n, pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, "i4")), pa.array(source, pa.string()), i4, i4, i4, pa.nulls(n, pa.int64()), pa.array(episode, pa.int64()), pa.array(chunk, pa.int64()), pa.array(blobs, pa.binary())], names=[x.split()[0] for x in STATS.split(", ")])


SERIES, CHANGE, EXCURSION, EDGE = range(4)


def _borders(b: Block, valid: np.ndarray, unit: np.ndarray, chunk: int) -> Iterator[tuple[int, int, Block]]:
    """Of each unit of an episode that has several: the rows near its ends, with their number in the unit and the unit's row count."""
    several = b.i[:, 1] > 0
    for u in np.unique(unit[several]):
        at = np.flatnonzero(unit == u)
        keep = {*range(min(STUCK_ROWS, len(at))), *range(max(0, len(at) - STUCK_ROWS), len(at))}
        for c in range(N):
            v = np.flatnonzero(valid[at, c])
            keep |= {*v[: 2 * REACH], *v[-2 * REACH :]}
        rows = np.array(sorted(keep))
        e = b.take(at[rows])
        e.i = np.hstack([e.i, rows[:, None], np.full((len(rows), 1), len(at))])
        yield int(e.ep[0]), int(e.fr[0] // chunk), e


def _statistics(chunk: int):
    def run(b: Block) -> Iterator:
        x, _, valid = _judged(b)
        unit = _units(b, chunk)
        src, names = b.s[0]
        season = b.i[:, 0]
        for c in range(N):
            at = np.flatnonzero(valid[:, c])
            if not len(at):
                continue
            v, seg, s = x[at, c], unit[at], src[at]
            later, d = _changes(v, seg)
            if len(d):
                (k, lb), n = _count(s[later], _buckets(d, CHANGE_WIDTH))
                yield _stat_rows(CHANGE, names, k, np.zeros(len(k)), lb, n, c)
            (k, t, lb), n = _count(s, season[at], _buckets(excursion(v, seg), EXCURSION_WIDTH))
            yield _stat_rows(EXCURSION, names, k, t, lb, n, c)
        used = np.unique(src)
        yield _blob_rows(SERIES, [names[k] for k in used], [None] * len(used), [None] * len(used), [b.take(src == k).pack() for k in used])
        if edges := [*_borders(b, valid, unit, chunk)]:
            yield _blob_rows(EDGE, [None] * len(edges), [e for e, _, _ in edges], [c for _, c, _ in edges], [e.pack() for _, _, e in edges])

    return run


def _per_episode(edges: DataFrame, f, schema: str) -> DataFrame:
    """f over the joined border rows of each episode, at most some 200 rows for each block of CHUNK frames."""

    def run(batches: Iterator) -> Iterator:
        now, held = None, []
        for batch in batches:
            for ep, payload in zip(batch.column(0).to_pylist(), batch.column(2)):
                if ep != now and held:
                    yield from f(Block.concat(held))
                    held = []
                now = ep
                held.append(Block.unpack(payload.as_py()))
        if held:
            yield from f(Block.concat(held))

    return edges.select("episode", "chunk", "payload").repartition("episode").sortWithinPartitions("episode", "chunk").mapInArrow(run, schema)


def _across(b: Block, chunk: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Changes from the last reading of one unit to the first of the next: column, rows, values."""
    x, _, valid = _judged(b)
    part = np.floor_divide(b.fr, chunk)
    for c in range(N):
        at = np.flatnonzero(valid[:, c])
        later = np.flatnonzero(part[at][1:] != part[at][:-1]) + 1
        yield c, at[later], np.abs(x[at[later], c] - x[at[later - 1], c])


def _edge_changes(chunk: int):
    def run(b: Block) -> Iterator:
        src, names = b.s[0]
        for c, rows, d in _across(b, chunk):
            if len(d):
                (k, lb), n = _count(src[rows], _buckets(d, CHANGE_WIDTH))
                yield _stat_rows(CHANGE, names, k, np.zeros(len(k)), lb, n, c)

    return run


VALUES = "source string, col int, lb int, value double, cnt bigint"


def _value_rows(source: str, col: int, lb, values):
    import pyarrow as pa

    at = np.argsort(values, kind="stable")
    v, b = values[at], lb[at]
    starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, int)
    n = np.diff(np.append(starts, len(v)))
    k = len(starts)
    return pa.RecordBatch.from_arrays([pa.array([source] * k, pa.string()), pa.array(np.full(k, col, "i4")), pa.array(b[starts].astype("i4")), pa.array(v[starts]), pa.array(n.astype("i8"))], names=[x.split()[0] for x in VALUES.split(", ")])


def _deciding_values(chunk: int):
    """Of each series, the changes in the buckets that hold the wanted ranks; column 2 lists those buckets."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for source, payload, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if not wanted:
                    continue
                b = Block.unpack(payload.as_py())
                x, _, valid = _judged(b)
                unit = _units(b, chunk)
                for c in {w["col"] for w in wanted}:
                    at = np.flatnonzero(valid[:, c])
                    _, d = _changes(x[at, c], unit[at])
                    lb = _buckets(d, CHANGE_WIDTH)
                    hit = np.isin(lb, [w["lb"] for w in wanted if w["col"] == c])
                    if hit.any():
                        yield _value_rows(source, c, lb[hit], d[hit])

    return run


def _edge_values(chunk: int):
    def run(b: Block) -> Iterator:
        src, names = b.s[0]
        for c, rows, d in _across(b, chunk):
            for k in np.unique(src[rows]):
                one = d[src[rows] == k]
                yield _value_rows(names[k], c, _buckets(one, CHANGE_WIDTH), one)

    return run


def candidates(residual: np.ndarray, screen: np.ndarray, lowered: np.ndarray) -> np.ndarray:
    """Positions of the readings that the fitted cutoff lets through to the rule. lowered is where the rule's limit lies on the scale of
    residuals; subtraction rounds monotonically, so >= loses no reading beyond the limit."""
    return np.flatnonzero(residual >= np.minimum(screen, lowered))


def _flag_rows(b: Block, x, bad, valid, seg, link_ok, near, cuts: dict) -> Iterator:
    """Flags of a block's readings. near(col, rows): which valid rows may be judged as spikes, or None for all."""
    import pyarrow as pa

    moving = _moving(b) & link_ok if len(b.ep) > 1 else np.zeros(0, bool)
    src, names = b.s[0]
    season = b.i[:, 0]
    grip = np.where(is_null(b.m[:, N + 11]), np.inf, GRIPPER_PART * b.m[:, N + 11])
    for c, (name, dim) in enumerate(COLUMNS):
        rule, screen, pot, level, moves = (np.array([cuts[n][k][c] for n in names]) for k in range(5))
        at = np.flatnonzero(valid[:, c])
        exc = excursion(x[at, c], seg[at])
        usual = level[src[at], season[at]]
        limit = grip[at] if c == GRIPPER else rule[src[at]]
        residual = exc - usual
        tail = residual > pot[src[at]]
        judged = candidates(residual, screen[src[at]], limit - usual)
        if (some := near(c, at)) is not None:
            judged, tail = judged[some[judged]], tail & some
        spike = np.zeros(len(at), bool)
        spike[judged] = exc[judged] > limit[judged]
        flags = np.zeros((len(b.ep), 4), bool)
        flags[:, 0] = bad[:, c]
        flags[at, 1], flags[at, 3] = spike, tail
        res = np.full(len(b.ep), np.nan)
        res[at] = np.where(np.isfinite(residual), residual, np.nan)
        if len(b.ep) >= STUCK_ROWS:
            flags[:, 2] = (_runs(moving & (x[1:, c] == x[:-1, c])) >= STUCK_ROWS) & moves[src].astype(bool)
        hit = np.flatnonzero(flags.any(axis=1))
        if len(hit):
            r = res[hit]
            yield pa.RecordBatch.from_arrays([pa.array(b.ep[hit]), pa.array(b.fr[hit]), pa.array([name] * len(hit)), pa.array(np.full(len(hit), dim, "i8")), pa.array(x[hit, c]), pa.array(r, mask=np.isnan(r)), *[pa.array(flags[hit, k]) for k in range(4)]], names=[z.split()[0] for z in FLAGS.split(", ")])


def _cuts(rows: list[dict] | None) -> tuple:
    """Arrays over the columns: rule cutoff, screening cutoff, tail cutoff, level by season, whether the dim ever changes."""
    rule, screen, pot, level, moves = np.full(N, np.inf), np.full(N, np.inf), np.full(N, np.inf), np.zeros((N, SEASONS)), np.zeros(N)
    for r in rows or []:
        c = r["col"]
        rule[c] = np.inf if r["rule"] is None else r["rule"]
        screen[c] = np.inf if r["screen"] is None else r["screen"]
        pot[c] = np.inf if r["pot"] is None else r["pot"]
        moves[c] = bool(r["moves"])
        for s, v in enumerate(r["level"] or []):
            level[c, s] = v or 0.0
    return rule, screen, pot, level, moves


def _flag_series(chunk: int):
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for source, payload, rows in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                b = Block.unpack(payload.as_py())
                x, bad, valid = _judged(b)
                seg = _units(b, chunk)
                yield from _flag_rows(b, x, bad, valid, seg, seg[1:] == seg[:-1], lambda c, at: None, {source: _cuts(rows)})

    return run


def _flag_borders(chunk: int):
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for payload, rows in zip(batch.column(0), batch.column(1).to_pylist()):
                b = Block.unpack(payload.as_py())
                by: dict = {}
                for r in rows or []:
                    by.setdefault(r["source"], []).append(r)
                x, bad, valid = _judged(b)
                part, number, size = np.floor_divide(b.fr, chunk), b.i[:, 2], b.i[:, 3]
                same = part[1:] == part[:-1]
                joined = np.where(same, number[1:] == number[:-1] + 1, (number[1:] == 0) & (number[:-1] == size[:-1] - 1))

                def near(c: int, at: np.ndarray) -> np.ndarray:
                    p = part[at]
                    new = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else np.zeros(0, int)
                    n = np.diff(np.append(new, len(p)))
                    rank = np.arange(len(p)) - np.repeat(new, n)
                    return (rank < REACH) | (np.repeat(n, n) - 1 - rank < REACH)

                yield from _flag_rows(b, x, bad & False, valid, np.zeros(len(b.ep), int), joined, near, {n: _cuts(by.get(n)) for n in b.s[0][1]})

    return run


def _tail_cutoffs(excursions: DataFrame) -> DataFrame:
    """Per source and column: generalized Pareto cutoffs of the risks SCREEN and RISK over the seasonal residuals, and the seasons' levels."""
    # counts are summed before they are shuffled; all windows then lie within (source, col) and share one exchange
    x = excursions.groupBy("source", "col", "season", "lb").agg(F.sum("cnt").alias("cnt"))
    mid = F.when(F.col("lb") == ZERO, 0.0).otherwise(F.exp((F.col("lb") + 0.5) * float(EXCURSION_WIDTH)))
    group = Window.partitionBy("source", "col")
    season = Window.partitionBy("source", "col", "season")
    x = x.withColumn("level", F.sum(mid * F.col("cnt")).over(season) / F.sum("cnt").over(season)).withColumn("res", mid - F.col("level"))
    top = group.orderBy(F.desc("res")).rangeBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("n", F.sum("cnt").over(group)).withColumn("above", F.sum("cnt").over(top))
    x = x.withColumn("u", F.max(F.when(F.col("above") >= PEAK_SHARE * F.col("n"), F.col("res"))).over(group))
    over = F.col("res") > F.col("u")
    y, w = F.when(over, F.col("res") - F.col("u")), F.when(over, F.col("cnt"))
    fit = x.groupBy("source", "col").agg(
        F.sum(w).alias("nu"), F.max("n").alias("n"), F.max("u").alias("u"), (F.sum(y * w) / F.sum(w)).alias("m"), (F.sum(y * y * w) / F.sum(w)).alias("m2"),
        F.array(*[F.max(F.when(F.col("season") == s, F.col("level"))) for s in range(SEASONS)]).alias("level"),
    )
    s2 = F.greatest(F.col("m2") - F.col("m") * F.col("m"), F.lit(1e-18))
    ratio = F.col("m") * F.col("m") / s2
    fit = fit.withColumn("xi", F.greatest(F.lit(-0.5), F.least(F.lit(0.5), 0.5 * (1 - ratio)))).withColumn("sigma", F.col("m") * (1 - F.col("xi")))

    def cutoff(risk: float):
        part = F.lit(risk) * F.col("n") / F.col("nu")
        grown = F.when(F.abs("xi") < 1e-6, -F.log(part)).otherwise((F.pow(part, -F.col("xi")) - 1) / F.col("xi"))
        return F.col("u") + F.col("sigma") * F.greatest(grown, F.lit(0.0))

    return fit.select("source", "col", "level", "n", "u", "xi", "sigma", cutoff(SCREEN).alias("screen"), cutoff(RISK).alias("pot"))


def _rule_cutoffs(changes: DataFrame, values) -> DataFrame:
    """FACTOR times the exact QUANTILE (linear between neighbours) of each source's changes. values(wanted) gives the changes in the wanted buckets."""
    x = changes.groupBy("source", "col", "lb").agg(F.sum("cnt").alias("cnt"))
    w = Window.partitionBy("source", "col")
    x = x.withColumn("upto", F.sum("cnt").over(w.orderBy("lb"))).withColumn("n", F.sum("cnt").over(w)).withColumn("moves", F.max("lb").over(w) > ZERO)
    rank = F.lit(QUANTILE) * (F.col("n") - 1)
    x = x.withColumn("low", F.floor(rank)).withColumn("high", F.ceil(rank)).withColumn("part", rank - F.floor(rank)).withColumn("base", F.col("upto") - F.col("cnt"))
    hit = x.where("(low >= base AND low < upto) OR (high >= base AND high < upto)")
    hit = materialize(hit.select("source", "col", "lb", "base", "low", "high", "part", "moves"), "p1-ranks")
    v = values(hit.select("source", "col", "lb")).groupBy("source", "col", "lb", "value").agg(F.sum("cnt").alias("cnt"))
    v = v.join(hit, ["source", "col", "lb"])
    v = v.withColumn("to", F.col("base") + F.sum("cnt").over(Window.partitionBy("source", "col", "lb").orderBy("value"))).withColumn("from", F.col("to") - F.col("cnt"))
    at = lambda k: F.max(F.when((F.col(k) >= F.col("from")) & (F.col(k) < F.col("to")), F.col("value")))
    q = v.groupBy("source", "col").agg(at("low").alias("a"), at("high").alias("b"), F.max("part").alias("part"), F.max("moves").alias("moves"))
    return q.select("source", "col", (FACTOR * (F.col("a") + F.col("part") * (F.col("b") - F.col("a")))).alias("rule"), "moves")


def _fitted(frames: DataFrame, datasets: DataFrame, modality: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """Stored series and block borders, the cutoffs of each source and column, and whether episodes may have several blocks."""
    spark = frames.sparkSession
    size = frames.agg(F.count("*"), F.max("frame_index"), F.min("frame_index")).head()
    buckets = bucket_count(frames, size[0])
    long = size[0] and ((size[1] or 0) >= chunk or (size[2] or 0) < 0)

    key = F.col("feature_key")
    limits = datasets.select("dataset_path", "embodiment_tag").join(modality.where(key.isin([f for f, _ in FIELDS])), "embodiment_tag")
    limits = limits.groupBy("dataset_path").agg(*[f(F.when(key == name, F.col(side))).alias(f"{side}{k}") for k, (name, _) in enumerate(FIELDS) for side, f in (("range_min", F.max), ("range_max", F.min))])
    limits = materialize(limits, "p1-limits")
    if limits.count() <= BROADCAST_DATASETS:
        limits = F.broadcast(limits)
    rows = frames.select("episode_index", "frame_index", "robot_id", "dataset_path", "ingested_at", "recorded_at", *[n for n, _ in FIELDS], "cartesian_position")
    rows = rows.join(limits, "dataset_path", "left")
    if long:
        # keyed by (episode, block), so that the rows of the longest episode are many keys
        rows = rows.withColumn("_part", F.floor(F.col("frame_index") / chunk))
        parts = frames.select("episode_index", F.floor(F.col("frame_index") / chunk).alias("_part")).dropna().distinct()
        parts = parts.withColumn("several", (F.count("*").over(Window.partitionBy("episode_index")) > 1).cast("int"))
        rows = rows.join(parts.where("several = 1"), ["episode_index", "_part"], "left")
    else:
        rows = rows.withColumn("several", F.lit(0))
    rows = rows.withColumn("source", F.coalesce("robot_id", F.lit(NO_SOURCE))).withColumn("season", F.coalesce(F.floor(F.hour("recorded_at") / SEASON_HOURS), F.lit(0)))
    order = F.unix_micros(F.col("ingested_at").cast("timestamp"))
    vectors = [*FIELDS, ("cartesian_position", 6), *[(f"{side}{k}", 1) for k in range(len(FIELDS)) for side in ("range_min", "range_max")]]
    blocks = packed(rows, vectors, ["season", "several"], ["source"], order, buckets, chunk)
    at = scratch(spark, "p1-blocks")
    per_bucket(blocks, buckets, _statistics(chunk), STATS).write.partitionBy("kind").parquet(at)
    stored = spark.read.schema(STATS).parquet(at)
    series, edges = stored.where(F.col("kind") == SERIES), stored.where(F.col("kind") == EDGE)
    changes = stored.where(F.col("kind") == CHANGE).select("source", "col", "lb", "cnt")
    if long:
        changes = changes.unionByName(_per_episode(edges, _edge_changes(chunk), STATS).select("source", "col", "lb", "cnt"))

    def values(wanted: DataFrame) -> DataFrame:
        by = wanted.groupBy("source").agg(F.collect_list(F.struct("col", "lb")).alias("wanted"))
        v = series.join(by, "source").select("source", "payload", "wanted").mapInArrow(_deciding_values(chunk), VALUES)
        if long:
            v = v.unionByName(_per_episode(edges, _edge_values(chunk), VALUES).join(wanted, ["source", "col", "lb"], "left_semi"))
        return v

    cut = materialize(_tail_cutoffs(stored.where(F.col("kind") == EXCURSION)).join(_rule_cutoffs(changes, values), ["source", "col"], "left"), "p1-cutoffs")
    return series, edges, cut, bool(long)


def cutoffs(frames: DataFrame, datasets: DataFrame, modality: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per robot_id, field and dim: readings, the fitted Pareto (threshold, shape, scale), its cutoffs of the risks SCREEN and RISK, the
    rule's cutoff (null for gripper_position, whose rule goes by range_max), and whether that lowers the screen in some season."""
    cut = _fitted(frames, datasets, modality, chunk)[2]
    names = F.array(*[F.struct(F.lit(n).alias("field_name"), F.lit(d).cast("long").alias("dim")) for n, d in COLUMNS])[F.col("col")]
    rule = F.when(F.col("col") != GRIPPER, F.col("rule"))
    return cut.select(
        F.when(F.col("source") != NO_SOURCE, F.col("source")).alias("robot_id"), names["field_name"].alias("field_name"), names["dim"].alias("dim"), "n", F.col("u").alias("threshold"), F.col("xi").alias("shape"), F.col("sigma").alias("scale"), "screen", F.col("pot").alias("tail_cutoff"),
        rule.alias("rule"), (rule - F.array_max("level") < F.col("screen")).alias("screen_lowered"),
    )


def implausible_readings(frames: DataFrame, datasets: DataFrame, modality: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per flagged reading: impossible, spike (the rule, judged on the candidates), stuck, tail (beyond the far fitted cutoff)."""
    series, edges, cut, long = _fitted(frames, datasets, modality, chunk)
    cut_type = F.struct("source", "col", "rule", "screen", "pot", "moves", "level")
    by = cut.groupBy("source").agg(F.collect_list(cut_type).alias("cuts"))
    found = series.join(by, "source", "left").select("source", "payload", "cuts").mapInArrow(_flag_series(chunk), FLAGS)
    if long:
        joined = _per_episode(edges, _whole, "episode bigint, source array<string>, payload binary")
        with_cuts = joined.select("episode", F.explode("source").alias("source")).join(cut, "source").groupBy("episode").agg(F.collect_list(cut_type).alias("cuts"))
        extra = joined.join(with_cuts, "episode", "left").select("payload", "cuts").mapInArrow(_flag_borders(chunk), FLAGS)
        keys = ["episode_index", "frame_index", "field_name", "dim"]
        found = found.unionByName(extra).groupBy(keys).agg(F.first("value").alias("value"), F.max("residual").alias("residual"), *[F.max(c).alias(c) for c in ("impossible", "spike", "stuck", "tail")])
    return found


def _whole(b: Block) -> Iterator:
    import pyarrow as pa

    yield pa.RecordBatch.from_arrays([pa.array([int(b.ep[0])]), pa.array([b.s[0][1]], pa.list_(pa.string())), pa.array([b.pack()], pa.binary())], names=["episode", "source", "payload"])


def found(flags: DataFrame) -> DataFrame:
    """The readings that the rules of the data call cases; tail readings alone are none."""
    return flags.where("impossible OR spike OR stuck").select("episode_index", "frame_index", "field_name", "dim")
