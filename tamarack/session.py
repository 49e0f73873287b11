"""The Spark session of tests and local runs, and the places where work is written down between steps."""

from __future__ import annotations

import io
import os
import re
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Share of its limit from which the driver's heap is collected after a step, and how many times a collection's time passes until the next.
HEAP, PAUSE = 0.5, 8


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session on this machine; a cluster's own session is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tamarack")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TAMARACK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, once a session, by way of the checkpoint folder."""
    context = spark.sparkContext
    if getattr(context, "_tamarack_shipped", False):
        return
    here = Path(__file__).resolve().parent
    bundle = io.BytesIO()
    with zipfile.ZipFile(bundle, "w") as z:
        for file in sorted(here.rglob("*.py")):
            z.write(file, file.relative_to(here.parent))
    target = f"{ensure_checkpoint_dir(spark)}/tamarack-{uuid.uuid4().hex}.zip"
    where = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(bundle.getvalue()))
    out.close()
    context.addPyFile(target)
    context._tamarack_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder: what the cluster names in spark.checkpoint.dir; one of our own only where none is set, as in tests."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named is None and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("spark.checkpoint.dir names no shared folder")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tamarack-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def few_rows(df: DataFrame, most: int = 10_000) -> list:
    """The rows of a small fixed table; refuses a table that is no such thing rather than cutting it."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a fixed table has more than {most} rows")
    return rows


def tidy(spark: SparkSession) -> None:
    """Has the driver's JVM collect its garbage once its heap has grown: plans that are done with would else take it to its limit, and their shuffle files stay."""
    context, began = spark.sparkContext, time.monotonic()
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if began < getattr(context, "_tamarack_tidy_at", began) or heap.totalMemory() < HEAP * heap.maxMemory():
        return
    spark._jvm.System.gc()
    over = time.monotonic()
    context._tamarack_tidy_at = over + PAUSE * (over - began)


def settle(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder: lineage ends there and a lost executor costs nothing."""
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    path = f"{folder}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    tidy(spark)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._settled_path = path
    return kept


def release(*frames: DataFrame | None) -> None:
    """Deletes the files of settled frames that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_settled_path", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
            df._settled_path = None
