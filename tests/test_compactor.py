import glob
import os
import shutil

import pytest

from frames_fixture import frames, make
from trajecta.streaming import compactor
from trajecta.streaming.compactor import compact, compacted


def keys(rows):
    return {(r[2], r[3]) for r in rows if r[2] is not None and r[3] is not None}


def small_files(spark, tmp_path, n=7):
    rows = make(5, 4, 40)
    for k in range(n):
        frames(spark, rows[k::n]).withColumnRenamed("source", "_file").withColumnRenamed("lb", "_n").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return rows


def test_batches_retry_and_new_files(spark, tmp_path):
    rows = small_files(spark, tmp_path)
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    got = compact(spark, src, out, cp, files_per_batch=2)
    assert "_file" in got.columns and "_n" in got.columns
    found = [tuple(r) for r in got.select("episode_index", "frame_index").collect()]
    whole = [x for x in found if None not in x]
    assert len(whole) == len(set(whole)) and set(whole) == keys(rows)
    assert len(found) - len(whole) == 2  # rows without a key are kept
    assert len(glob.glob(f"{out}/_batch=*")) == 4
    # the last batch again, as after a failure before its commit: replaced, not added
    os.remove(f"{cp}/commits/3")
    os.path.exists(f"{cp}/commits/.3.crc") and os.remove(f"{cp}/commits/.3.crc")
    again = compact(spark, src, out, cp, files_per_batch=2)
    assert sorted(map(str, again.select("episode_index", "frame_index").collect())) == sorted(f"Row(episode_index={e}, frame_index={f})" for e, f in found)
    # a file that comes later, with a frame already there and a new one
    extra = [rows[0], (*rows[1][:2], 99, 7, *rows[1][4:])]
    frames(spark, extra).withColumnRenamed("source", "_file").withColumnRenamed("lb", "_n").coalesce(1).write.mode("append").parquet(src)
    more = [tuple(r) for r in compact(spark, src, out, cp).select("episode_index", "frame_index").collect()]
    new = keys(extra) - keys(rows)
    assert {x for x in more if None not in x} == keys(rows) | new
    assert len([x for x in more if None not in x]) == len(keys(rows) | new)


def test_no_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    frames(spark, []).write.parquet(src)
    assert compact(spark, src, str(tmp_path / "out"), str(tmp_path / "cp")).count() == 0
    shutil.rmtree(tmp_path / "out", ignore_errors=True)
    assert compacted(spark, str(tmp_path / "out"), frames(spark, []).schema).count() == 0


def test_one_file_per_episode(spark, tmp_path):
    """The delivered frames of the smallest tables, one tiny file an episode, in several batches by bytes: each frame once, as first ingested."""
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    given = spark.read.parquet("/root/testdata/sf0.001/frames.parquet")
    given.repartition(4, "episode_index").write.partitionBy("episode_index").parquet(f"{src}-by")
    for k, p in enumerate(sorted(glob.glob(f"{src}-by/*/*.parquet"))):
        e = int(p.split("episode_index=")[1].split("/")[0])
        spark.read.parquet(p).selectExpr(f"{e}L AS episode_index", "*").select(given.columns).coalesce(1).write.mode("append").parquet(src)
    n = len(glob.glob(f"{src}/*.parquet"))
    got = compact(spark, src, out, cp, batch_bytes=150_000, order=("ingested_at",))
    want = given.selectExpr("*", "row_number() OVER (PARTITION BY episode_index, frame_index ORDER BY ingested_at) AS r").where("r = 1").drop("r")
    assert n >= 30 and len(glob.glob(f"{out}/_batch=*")) > 1 and len(glob.glob(f"{out}/*/*.parquet")) < n / 3
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_copies_over_batches_and_too_many_to_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compactor, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(compactor, "BLOCK", 8)
    test_batches_retry_and_new_files(spark, tmp_path)


def test_files_are_as_many_as_cores_need():
    mb = 1 << 20
    assert [compactor._file_count(t * mb, 6, 128 * mb) for t in (0, 1, 60, 290, 900, 6 * 128, 7 * 128)] == [1, 1, 1, 6, 8, 6, 7]


def test_a_position_is_an_integer(spark, tmp_path):
    small_files(spark, tmp_path, 1)
    with pytest.raises(ValueError):
        compact(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), keys=("episode_index", "robot_id"))
