"""Session helpers: building a local session for tests/bench and locating the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CONF_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, *, app: str = "transitflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session with the settings the jobs are tuned for.

    On a cluster the session comes from the platform; call
    :func:`ensure_checkpoint_dir` on it instead of building one here.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "8g")
        # checkpoint files of materialised intermediates are removed once the
        # DataFrames that use them are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session, if any."""
    conf = spark.conf.get(_CONF_KEY, None)
    if conf:
        return conf
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.  A private one is made only for
    a local master (tests); elsewhere executors could not see it, so a session
    that names none is an error."""
    root = checkpoint_root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CONF_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="transitflow-ckpt-")
        spark.conf.set(_CONF_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root (never machine-local
    temp space) for stream checkpoints, landing files and staged tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/transitflow/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Cut lineage where a plan branches: a reliable checkpoint into the
    shared checkpoint folder (survives executor loss; never local).

    Sessions should set ``spark.cleaner.referenceTracking.cleanCheckpoints``
    (as :func:`build_session` does) so these files are deleted once no
    DataFrame refers to them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """A copy of ``df`` written as a table in the shared folder.  Unlike a
    checkpoint it has no partitioning, so a join with it shuffles both sides
    and Spark can split a hot key of the other one."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept_in_place(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a join on more columns than both its sides are partitioned
    by leaves them where they are; Spark would else shuffle them by all of them.
    Rows and results are the same either way."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scale_settings(input_bytes: int, *, target_partition_bytes: int = 512 << 20,
                   max_partitions: int = 100_000, max_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (shuffles carry only the projected columns, usually a fraction of
    that), capped at ``max_partitions`` because shuffle blocks grow as
    map tasks x reduce partitions; AQE then coalesces small partitions toward
    128 MB and splits skewed ones at run time.  Pass the result to
    ``SparkSession.builder.config(map=...)``."""
    parts = min(max_partitions, max(200, -(-int(input_bytes) // target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        # rows handed to Python at a time: long documents make large batches
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
