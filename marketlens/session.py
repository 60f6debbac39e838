"""Session helpers.

Library code never creates a session; it takes the caller's.  ``local_session``
is for tests and the benchmark only.  ``ensure_checkpoint_dir`` reads the
cluster's ``spark.checkpoint.dir`` and invents none.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "marketlens",
    driver_memory: str = "8g",
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Test/bench sessions only: a fresh scratch checkpoint folder per run.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="marketlens-ckpt-", dir="/tmp"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint directory named in ``spark.checkpoint.dir``.

    It must be storage that all executors share; none is invented here, as a
    machine-local folder would lose tables with the executor that wrote them."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for lineage-cutting tables written by the library: the
    checkpoint directory (shared storage on a cluster)."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def track_scratch(spark: SparkSession, path: str) -> str:
    """Remember a folder of intermediate tables for ``clear_scratch``."""
    spark.sparkContext.__dict__.setdefault("_marketlens_scratch", []).append(path)
    return path


def scratch_mark(spark: SparkSession) -> int:
    """How many intermediate folders there are by now."""
    return len(spark.sparkContext.__dict__.get("_marketlens_scratch", []))


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one folder of intermediate tables that nothing reads any more."""
    paths = spark.sparkContext.__dict__.get("_marketlens_scratch", [])
    if path in paths:
        paths.remove(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables written since a mark (or all); call it
    once no result that reads them is needed.  Returns how many folders went."""
    gone = spark.sparkContext.__dict__.get("_marketlens_scratch", [])[since:]
    for path in gone:
        drop_scratch(spark, path)
    return len(gone)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """The session with these settings (``__`` for a dot), and as before at the end."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_go(spark: SparkSession):
    """For writes: the shuffle files of a write go when it has ended.  Else they
    stay on the executors' disks until the driver collects its garbage, and one
    build holds those of all its tables at once."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of source data.

    Shuffle partitions are sized so the largest stage (the line-item fact,
    about the size of the input) lands near ``target_partition_bytes`` per
    partition; AQE then coalesces small partitions and splits skewed ones.
    The ranking range count follows the person/seller grain, which is a
    small fraction of the input.  A stored fact has one file a bucket and
    month: with buckets of 64 MB for each of a hundred months, files stay large
    enough at any size.  Apply with ``spark.conf.set`` or pass to
    the session builder; ``spark.checkpoint.dir`` must still name shared
    storage.
    """
    shuffle = max(200, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024**2),
        "marketlens.ranking.partitions": str(max(8, shuffle // 8)),
        "marketlens.store.buckets": str(max(8, int(input_bytes) // (100 * 64 * 1024**2))),
    }
