"""Spark session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "foldframe") -> SparkSession:
    """Local/test session. On a cluster the session comes from spark-submit and
    only the SQL knobs below matter."""
    cpus = os.environ.get("BENCH_CPUS") or "8"
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FOLDFRAME_DRIVER_MEMORY", "16g"))
        .config("spark.sql.ansi.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    On a cluster the deployment sets it to storage that the driver and all
    executors share; without it a run on a cluster raises. Only a local master
    (one machine, as in tests) gets a scratch folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="foldframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def _scratch_root(spark: SparkSession) -> str:
    """This run's folder for scratch tables, under the shared checkpoint folder."""
    sc = spark.sparkContext
    if not hasattr(sc, "_foldframe_run"):
        sc._foldframe_run = uuid.uuid4().hex
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/foldframe-tables/run-{sc._foldframe_run}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder where Spark sees it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the scratch tables of this run. Frames that read them are of no use
    afterwards, so results are to be written first."""
    delete(spark, _scratch_root(spark))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors, and unlike a checkpointed RDD
    the reread table has a known size and prunes columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's code, once per session: functions sent
    to Python workers refer to it by name."""
    sc = spark.sparkContext
    if sc.master.split("[")[0] == "local" or getattr(sc, "_foldframe_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="foldframe-code-"), "foldframe.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("foldframe", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._foldframe_shipped = True
