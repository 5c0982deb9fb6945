"""Session defaults, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app_name: str = "paperweave", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is only ever used with a local master;
    a cluster session without the setting is an error, not a silent fallback.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not _is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="paperweave-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared folder for files written and read back."""
    return f"{shared_folder(spark)}/scratch/{name}-{uuid.uuid4().hex}"


SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package where neither PYTHONPATH nor the working folder has it.

    Only code travels this way, by Spark's own file server.
    """
    root = Path(__file__).resolve().parents[1]
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if context.applicationId in SHIPPED or not root.is_dir() or any(p and Path(p).resolve() == root for p in places):
        return
    SHIPPED.add(context.applicationId)
    context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/paperweave-code", "zip", root, "paperweave"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, keeps columns apart, and gives joins an exact size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``stored`` wrote for one job, once nothing reads them any more."""
    for table in tables:
        hadoop = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        hadoop.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


def keep(df: DataFrame) -> DataFrame:
    """Cache with spill to disk; lost blocks are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release_unused(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files and checkpoints that nothing refers to any more.

    It does so when the driver's garbage is collected, which in a driver with little to do may be long after a job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions for explicit layouts: the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def planned_shuffles(spark: SparkSession):
    """Run the enclosed actions with the layout's partition count and no re-planning.

    For loops whose tables are laid out for each other: there is nothing to
    coalesce or re-plan, and each round saves the per-stage planning.
    """
    fixed = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions(spark)),
    }
    before = {name: spark.conf.get(name) for name in fixed}
    for name, value in fixed.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
