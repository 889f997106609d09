"""Session helpers: a local builder and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "docloom", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docloom-"))
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("docloom.spread", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def durable_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    This is the cluster's ``spark.checkpoint.dir``.  A temporary folder is made
    only in local mode, where driver and executors are one process; anywhere
    else a missing setting is an error, because a machine-local folder would be
    lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="docloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; each call returns a new one.

    All paths of an application lie in one folder named after it, which can be
    deleted when the application has ended.
    """
    application = spark.sparkContext.applicationId
    return f"{durable_root(spark)}/docloom/{application}/{label}-{uuid.uuid4().hex}"


#: Spark's own switch: shuffle files go when the query that made them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffles below what is written go when it is written, not by the driver's garbage collection."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str, *, release: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (runs a job).

    Cuts the lineage like a checkpoint does, but computes the input once, keeps
    it columnar and survives the loss of any executor.  ``release`` frees the disk of the
    shuffles below when the table is written, for large ones that nothing else reads; else
    they stay until the driver's garbage collection.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with releasing_shuffles(spark) if release else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
