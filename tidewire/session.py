"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def build_session(app_name: str = "tidewire", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Wall-clock functions read the session zone; every plan here assumes UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster; a temporary one only for local runs without a setting."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tidewire-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def spread(df: DataFrame) -> DataFrame:
    """For heavy work on a scan of few splits: one partition per core. Wide scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def small_batches(spark: SparkSession, max_bytes: int = 8 << 20) -> SparkSession:
    """Let batches that go to Python workers hold ``max_bytes`` at most; a session that asks for less keeps its setting."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > max_bytes:
        spark.conf.set(name, f"{max_bytes}b")
    return spark


def settle(df: DataFrame) -> DataFrame:
    """Compute once: write a table to the shared folder and read it back from there.

    The lineage ends at the table, so a lost executor costs only its own tasks, later plans prune
    the columns they need, and Spark knows the size of the data.
    """
    return df.sparkSession.read.schema(df.schema).parquet(settle_at(df))


_OPEN: list[list[str]] = []


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables that are settled inside are deleted at the end. No lazy result may leave the block."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN.remove(paths)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settle_at(df: DataFrame) -> str:
    """The path of the settled table. The folder belongs to the session, so it can go with it."""
    path = f"{shared_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return path
