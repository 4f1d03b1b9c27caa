"""Compressed hand-over of frame rows between stages.

A frame is about thirty doubles with four decimals; as JVM rows they barely compress, and a shuffle of them
costs several times the Parquet input. Here each map task groups its rows by target bucket, drops copies of a
frame it has already seen, and ships each bucket as one compressed block. The bucket is a hash of the episode and
of a block of `chunk` frame indices, so that an episode of any length is spread over many buckets.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the NaN that stands for null; a NaN reading keeps other bits.
NULL_BITS = 0x7FF80000DEADBEEF
NULL = np.array([NULL_BITS], dtype="<u8").view("<f8")[0]
CHUNK = 65536
SCALE = 1e4
FLUSH_ROWS = 120_000
BUCKET_ROWS = 150_000


def is_null(m: np.ndarray) -> np.ndarray:
    return m.view("<u8") == NULL_BITS


def _vectors(arr, width: int) -> np.ndarray:
    """Arrow list<double> (or double, width 1) as a matrix; null lists, null elements and missing positions become NULL."""
    import pyarrow as pa

    n = len(arr)
    is_list = pa.types.is_list(arr.type) or pa.types.is_large_list(arr.type)
    vals = arr.values if is_list else arr
    v = np.array(vals.fill_null(0.0).to_numpy(zero_copy_only=False), dtype="<f8")
    if vals.null_count:
        v[vals.is_null().to_numpy(zero_copy_only=False)] = NULL
    if not is_list:
        return v.reshape(n, 1)
    offs = np.asarray(arr.offsets)
    lens = np.diff(offs)
    if not arr.null_count and (lens == width).all():
        return v[offs[0] : offs[-1]].reshape(n, width)
    ok = arr.is_valid().to_numpy(zero_copy_only=False)
    out = np.full((n, width), NULL)
    for j in range(width):
        sel = ok & (lens > j)
        out[sel, j] = v[offs[:-1][sel] + j]
    return out


def _planes(a: np.ndarray) -> bytes:
    """Bytes of equal significance side by side."""
    return np.ascontiguousarray(a.reshape(-1).view("u1").reshape(-1, a.itemsize).T).tobytes()


def _unplanes(b: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, "u1").reshape(size, -1).T).view(dtype).reshape(-1)


def _encode(m: np.ndarray) -> tuple:
    """Lossless: multiples of 1/SCALE as int32 differences down each column, all other values listed raw."""
    with np.errstate(all="ignore"):
        k = np.rint(m * SCALE)
        exact = (np.abs(k) < 2**29) & (k / SCALE == m) & ~((m == 0) & np.signbit(m))
    bad = np.flatnonzero(~exact)
    if bad.size > m.size // 2:
        return (m.shape, None, None, _planes(np.asfortranarray(m).T))
    k = np.where(exact, k, 0).astype("<i4")
    return (m.shape, bad.astype("<i8").tobytes(), m.reshape(-1)[bad].tobytes(), _planes(np.diff(k.T, axis=1, prepend=np.int32(0)).astype("<i4")))


def _decode(shape: tuple, at: bytes | None, raw: bytes | None, planes: bytes) -> np.ndarray:
    n, w = shape
    if at is None:
        return np.ascontiguousarray(_unplanes(planes, "<f8").reshape(w, n).T)
    m = np.ascontiguousarray((np.cumsum(_unplanes(planes, "<i4").reshape(w, n), axis=1) / SCALE).T)
    m.reshape(-1)[np.frombuffer(at, "<i8")] = np.frombuffer(raw, "<f8")
    return m


def dump(obj) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(obj, protocol=5))


def load(b: bytes):
    """Only for blocks this package wrote itself."""
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(b))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two integer columns."""
    with np.errstate(over="ignore"):
        z = a.astype("u8") * np.uint64(0x9E3779B97F4A7C15) + b.astype("u8") * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class Block:
    """Rows of one bucket in (episode, frame) order, each frame once: ep, fr, order; f64 matrix m; i64 matrix i; s: list of (codes, values)."""

    __slots__ = ("ep", "fr", "order", "m", "i", "s")

    def __init__(self, ep, fr, order, m, i, s):
        self.ep, self.fr, self.order, self.m, self.i, self.s = ep, fr, order, m, i, s

    def take(self, at) -> Block:
        return Block(self.ep[at], self.fr[at], self.order[at], self.m[at], self.i[at], [(c[at], v) for c, v in self.s])

    def sorted(self) -> Block:
        """In order, the earliest delivery of each frame kept."""
        at = np.lexsort((self.order, self.fr, self.ep))
        e, f = self.ep[at], self.fr[at]
        keep = np.ones(len(at), bool)
        keep[1:] = (e[1:] != e[:-1]) | (f[1:] != f[:-1])
        return self.take(at[keep])

    def pack(self) -> bytes:
        strings = []
        for c, v in self.s:
            used, back = np.unique(c, return_inverse=True)
            strings.append((back.astype("<i4").tobytes(), [v[k] for k in used]))
        ints = [_planes(np.diff(x, prepend=np.int64(0)).astype("<i8")) for x in (self.ep, self.fr, self.order, *self.i.T)]
        return dump((ints, _encode(self.m), strings))

    @staticmethod
    def unpack(b: bytes) -> Block:
        ints, m, strings = load(b)
        ints = [np.cumsum(_unplanes(x, "<i8")) for x in ints]
        m = _decode(*m)
        i = np.stack(ints[3:], axis=1) if len(ints) > 3 else np.zeros((len(ints[0]), 0), "<i8")
        return Block(ints[0], ints[1], ints[2], m, i, [(np.frombuffer(c, "<i4"), v) for c, v in strings])

    @staticmethod
    def concat(blocks: list[Block]) -> Block:
        if len(blocks) == 1:
            return blocks[0]
        strings = []
        for j in range(len(blocks[0].s)):
            codes: dict = {}
            parts = []
            for b in blocks:
                c, v = b.s[j]
                parts.append(np.array([codes.setdefault(x, len(codes)) for x in v] or [0], "<i4")[c])
            strings.append((np.concatenate(parts), list(codes)))
        return Block(*(np.concatenate([getattr(b, k) for b in blocks]) for k in ("ep", "fr", "order", "m", "i")), strings)


def packed(df: DataFrame, vectors: list[tuple[str, int]], ints: list[str], strings: list[str], order: Column, buckets: int, chunk: int = CHUNK) -> DataFrame:
    """Blocks (bucket, payload) of df's rows, ready to be hash-partitioned by bucket; rows without episode_index or frame_index are left out."""
    df = df.where("episode_index IS NOT NULL AND frame_index IS NOT NULL").select(
        F.col("episode_index").cast("long"), F.col("frame_index").cast("long"), F.coalesce(order, F.lit(0)).cast("long").alias("_order"),
        *[F.col(c) for c, _ in vectors], *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ints], *[F.col(c).cast("string") for c in strings],
    )
    widths = [w for _, w in vectors]
    n_ints, n_strings = len(ints), len(strings)

    def flush(parts: list[Block]):
        import pyarrow as pa

        b = Block.concat(parts)
        to = (mix(b.ep, np.floor_divide(b.fr, chunk)) % np.uint64(buckets)).astype("<i8")
        at = np.argsort(to, kind="stable")
        cuts = np.flatnonzero(np.diff(to[at])) + 1
        starts, groups = np.concatenate([[0], cuts]), np.split(at, cuts)
        yield pa.RecordBatch.from_arrays([pa.array(to[at][starts].astype("i4")), pa.array([b.take(g).sorted().pack() for g in groups], pa.binary())], names=["bucket", "payload"])

    def run(batches: Iterator) -> Iterator:
        parts, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = batch.columns
            ep, fr, od = (c.to_numpy(zero_copy_only=False) for c in cols[:3])
            m = np.hstack([_vectors(c, w) for c, w in zip(cols[3:], widths)])
            k = 3 + len(widths)
            i = np.stack([c.to_numpy(zero_copy_only=False) for c in cols[k : k + n_ints]], axis=1) if n_ints else np.zeros((batch.num_rows, 0), "<i8")
            s = []
            for c in cols[k + n_ints : k + n_ints + n_strings]:
                d = c.dictionary_encode()
                codes = d.indices.fill_null(len(d.dictionary)).to_numpy(zero_copy_only=False)
                s.append((codes, [*d.dictionary.to_pylist(), None]))
            parts.append(Block(ep, fr, od, m, i, s))
            rows += batch.num_rows
            if rows >= FLUSH_ROWS:
                yield from flush(parts)
                parts, rows = [], 0
        if parts:
            yield from flush(parts)

    return df.mapInArrow(run, "bucket int, payload binary")


def per_bucket(blocks: DataFrame, buckets: int, f: Callable[[Block], Iterator], schema: str) -> DataFrame:
    """f over each bucket's Block; f yields Arrow record batches of schema. Only one bucket is in a worker's memory at a time."""

    def run(batches: Iterator) -> Iterator:
        now, held = None, []
        for batch in batches:
            for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != now and held:
                    yield from f(Block.concat(held).sorted())
                    held = []
                now = bucket
                held.append(Block.unpack(payload.as_py()))
        if held:
            yield from f(Block.concat(held).sorted())

    return blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def bucket_count(df: DataFrame, rows: int) -> int:
    """So many buckets that each holds about BUCKET_ROWS rows, and no fewer than the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
