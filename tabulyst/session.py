"""Session helpers: a local test session and the shared staging folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabulyst")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def staging_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would not be readable by the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tabulyst-")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a table that costs a shuffle and is scanned many times afterwards. The
    written copy cuts the lineage, survives lost executors, and lets each later
    scan read only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _watched:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The paths staged within each open ``temporary_stages``.
_watched: list[list[str]] = []


@contextlib.contextmanager
def temporary_stages(spark: SparkSession):
    """Removes at its end what was staged within: results must have been written or collected
    by then. Without it, staged tables are left for the owner of the folder to expire."""
    paths: list[str] = []
    _watched.append(paths)
    try:
        yield
    finally:
        _watched.remove(paths)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
