"""Checkpointed compaction of many small files into few well-sized ones, each frame kept exactly once.

A file stream (availableNow) discovers every file once: its checkpoint is the list of files done. A micro-batch takes as many bytes
as all cores can write at once, so that batches are few and each as wide as the cluster. It is written to a folder named by its batch
id, overwritten on a retry, so a batch that failed half-way is replaced and never added twice.

Frame rows are not shuffled: the scan itself packs small files into tasks, as many as files are to come out, and each task writes one.
Only keys are shuffled, once, to the block of the sequence that they lie in. From there come the copies within the batch and an index,
kept beside the files: of each block the positions it has. Keys that an earlier batch has written are found by joining blocks, of
which there are a ten-thousandth to a hundredth of the rows, with the index; no written file is read again.

Defined cases: of several copies of a key the first by `order`, then by (file, row), stays; rows with a null in the key name no
frame and are all kept; all columns are kept under their names; an empty source gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("episode_index", "frame_index")
#: Bytes of a file written; where a batch has less than that for every core, files may be as small as LEAST_BYTES for more cores to write.
TARGET_BYTES, LEAST_BYTES = 128 << 20, 32 << 20
#: Keys with copies are broadcast up to so many (about 200 bytes each); beyond, the join is left to shuffle.
BROADCAST_KEYS = 500_000
#: Positions of a sequence that share a row of the index.
BLOCK = 32768
BATCH = "_batch"


def _done(spark: SparkSession, out: str, before: int) -> list[str]:
    """Folders of the batches before this one; a batch without rows wrote none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(out)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [f"{out}/{n}" for n in sorted(names) if n.startswith(f"{BATCH}=") and int(n.split("=")[1]) < before]


def _free(name: str, taken: list[str]) -> str:
    """The name, longer if a column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def _file_count(total: int, cores: int, target_bytes: int) -> int:
    """Files that a batch of so many bytes is written to: of the target size, or smaller down to LEAST_BYTES to use the cores."""
    return max(1, math.ceil(total / target_bytes), min(cores, total // min(LEAST_BYTES, target_bytes)))


def _index(known: DataFrame, keys: tuple[str, ...], order: list[str]) -> DataFrame:
    """Per sequence and block: positions, and of those with copies the place of the copy that stays. One shuffle of keys."""
    *group, at = keys
    known = known.withColumn("_block", F.floor(F.col(at) / BLOCK)).repartition(*group, "_block")
    one = known.groupBy(*group, "_block", at).agg(F.count("*").alias("_n"), F.min(F.struct(*order, "_file", "_row")).alias("_keep"))
    copy = F.when(F.col("_n") > 1, F.struct(F.col(at).alias("at"), F.col("_keep._file").alias("file"), F.col("_keep._row").alias("row")))
    return one.groupBy(*group, "_block").agg(F.collect_list(F.col(at)).alias("positions"), F.collect_list(copy).alias("copies"))


def _write_batch(spark: SparkSession, files: list[tuple[str, int]], schema, out: str, batch_id: int, target_bytes: int, keys: tuple[str, ...], order: tuple[str, ...]) -> None:
    paths, total = [f for f, _ in files], sum(n for _, n in files)
    # the session of a micro-batch is its own: the scan's packing decides how many files are written
    spark.conf.set("spark.sql.files.minPartitionNum", str(_file_count(total, spark.sparkContext.defaultParallelism, target_bytes)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))  # for a batch of too many copies to broadcast
    file, row, mark = (_free(x, schema.names) for x in ("_file", "_row", "_mark"))
    rows = spark.read.schema(schema).parquet(*paths).select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    *group, at = keys
    known = rows.dropna(subset=list(keys)).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(group)], F.col(at).cast("long").alias("_at"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(file).alias("_file"), F.col(row).alias("_row"))
    own = [f"_k{i}" for i in range(len(group))]
    index_at = f"{out}-index/{BATCH}={batch_id}"
    index = _index(known, (*own, "_at"), [f"_o{i}" for i in range(len(order))])
    index.write.mode("overwrite").parquet(index_at)
    index = spark.read.schema(index.schema).parquet(index_at)
    found = index.select(*own, F.explode("copies").alias("c")).select(*own, F.col("c.at").alias("_at"), F.struct(F.col("c.file").alias("file"), F.col("c.row").alias("row")).alias("_keep"), F.lit(0).alias("_old"))
    if earlier := _done(spark, f"{out}-index", batch_id):
        before = spark.read.schema(index.schema).parquet(*earlier).select(*own, "_block", F.col("positions").alias("_had"))
        if own:
            ends = index.agg(F.min(own[0]), F.max(own[0])).head()
            before = before.where(F.col(own[0]).between(ends[0], ends[1]))
        had = index.join(before, [*own, "_block"]).select(*own, F.explode(F.array_intersect("positions", "_had")).alias("_at"))
        found = found.unionByName(had.select("*", F.lit(None).cast(found.schema["_keep"].dataType).alias("_keep"), F.lit(1).alias("_old")))
        found = found.groupBy(*own, "_at").agg(F.max("_keep").alias("_keep"), F.max("_old").alias("_old"))
    found = found.select(*[F.col(o).alias(k) for o, k in zip(own, group)], F.col("_at").alias(at), F.struct("_old", "_keep").alias(mark))
    copies_at = f"{out}-copies/{BATCH}={batch_id}"
    found.write.mode("overwrite").parquet(copies_at)
    found = spark.read.schema(found.schema).parquet(copies_at)
    if found.count() <= BROADCAST_KEYS:
        found = F.broadcast(found)
    stays = F.col(mark).isNull() | ((F.col(f"{mark}._old") == 0) & (F.col(f"{mark}._keep.file") == F.col(file)) & (F.col(f"{mark}._keep.row") == F.col(row)))
    rows.join(found, list(keys), "left").where(stays).select(*schema.names).write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")


def compact(
    spark: SparkSession, source: str, out: str, checkpoint: str, target_bytes: int = TARGET_BYTES, files_per_batch: int | None = None, batch_bytes: int | None = None, keys: tuple[str, ...] = KEYS, order: tuple[str, ...] = ()
) -> DataFrame:
    """Compact what is new in source since the last call with this checkpoint; returns the table of all compacted files.

    The last key is an integer position within the others. A batch takes batch_bytes, by default target_bytes for every core, or
    files_per_batch files. Of copies the first by the columns of order stays.
    """
    schema = spark.read.parquet(source).schema
    if not isinstance(schema[keys[-1]].dataType, T.IntegralType):
        raise ValueError(f"{keys[-1]} is no integer position")
    p = spark._jvm.org.apache.hadoop.fs.Path(source)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", batch_bytes or target_bytes * spark.sparkContext.defaultParallelism)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile():  # a stream reads folders
        reader, source = reader.option("pathGlobFilter", p.getName()), str(p.getParent())
    found = reader.parquet(source)
    found = found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))

    def write(batch: DataFrame, batch_id: int) -> None:
        files = sorted((r["path"], r["size"]) for r in batch.distinct().collect())  # the files of one batch
        if files:
            _write_batch(batch.sparkSession, files, schema, out, batch_id, target_bytes, keys, order)

    stream = found.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return compacted(spark, out, schema)


def compacted(spark: SparkSession, out: str, schema) -> DataFrame:
    """The compacted rows, without those of folders that no batch wrote."""
    p = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out).select(*schema.names)


def file_report(table: DataFrame) -> DataFrame:
    """Of each file: rows and bytes."""
    return table.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n_rows"), F.max("_metadata.file_size").alias("n_bytes"))
