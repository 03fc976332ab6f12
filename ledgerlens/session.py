"""Session helpers: a configured local session for tests and bench, stage tables.

Library functions never create a session; they take DataFrames. The
caller owns the cluster configuration and names a shared folder in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlens") -> SparkSession:
    """Session for tests and the local bench, with a scratch folder that goes with the process."""
    scratch = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session, as set on it or named in ``spark.checkpoint.dir``.

    A session without one is an error: the library does not pick a folder
    that other executors may not see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bytes of an Arrow batch, and rows of a Parquet batch, while rows are a few MB each.
LARGE_ROWS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
              "spark.sql.parquet.columnarReaderBatchSize": "4"}


@contextmanager
def large_rows(spark: SparkSession) -> Iterator[None]:
    """Read rows of a few MB a few at a time, in the jobs that run inside the block.

    By default a task takes 4096 rows of Parquet and 10000 of Arrow at once: of such rows,
    its whole partition, in the heap, outside it and in the Python worker.
    """
    before = {k: spark.conf.get(k, None) for k in LARGE_ROWS}
    for k, v in LARGE_ROWS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---- stage tables -------------------------------------------------------
#: Stage tables written by this process and not released yet.
_stages: list[str] = []


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    For a stage that several branches of one plan read (the slim logs):
    each branch then scans a pruned columnar table instead of recomputing
    the stage with its own scan and shuffle. Survives executor loss like
    any written table. The tables live in one folder per application until
    ``release_stages`` or the ``stages`` block around them ends.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that goes with the stage tables (``release_stages``)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    _stages.append(path)
    return path


#: Catalog tables over stage folders (``bucketed``).
_named: list[str] = []


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` once, bucketed and sorted by ``key``, for joins that need no shuffle.

    Tables bucketed alike by the join key are read side by side, bucket by bucket.
    The table is external, in the shared folder, and goes with the stage tables.
    """
    spark = df.sparkSession
    path, table = stage_path(spark, name), f"ledgerlens_{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    _named.append(table)
    return spark.table(table)


def release_stages(spark: SparkSession, keep: int = 0) -> None:
    """Delete the stage tables written after the first ``keep`` ones.

    Call it when no DataFrame that reads them is needed any more.
    """
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _named and not keep:
        spark.sql(f"DROP TABLE IF EXISTS {_named.pop()}")
    while len(_stages) > keep:
        path = jvm.org.apache.hadoop.fs.Path(_stages.pop())
        path.getFileSystem(hadoop).delete(path, True)


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Owner of the stage tables written inside the block: they are deleted at its end."""
    before = len(_stages)
    try:
        yield
    finally:
        release_stages(spark, before)
