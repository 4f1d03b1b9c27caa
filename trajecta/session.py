"""Session builder and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "trajecta", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with AQE, UTC and Arrow; master and partitions only where the cluster doesn't set them."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local master may do without; it gets a temporary folder that goes with the process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not at.isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: executors need a folder that all of them share")
        base = tempfile.mkdtemp(prefix="trajecta-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
    return at.get()


def scratch_root(spark: SparkSession) -> str:
    """Where this application's intermediate tables lie."""
    return f"{shared_dir(spark).rstrip('/')}/trajecta/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage is cut, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. Results that weren't read yet still need theirs, so the caller says when."""
    p = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
