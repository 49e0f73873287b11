"""The same tables kept up by streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.upsert import latest, upsert


def first_deliveries(stream: DataFrame, keys: Sequence[str], time: str, lateness: str) -> DataFrame:
    """Each delivery once within the lateness: same keys and content are the same delivery; state older than that is dropped."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def requests_by_day(stream: DataFrame, time: str, api: str, lateness: str = "1 day") -> DataFrame:
    """Requests of each API by day, as a tumbling window; rows later than the lateness count for nothing."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, "1 day").alias("day"), api).agg(F.count("*").alias("requests")).select("day.start", api, "requests")


def sessions(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", lateness: str = "1 hour") -> DataFrame:
    """Stretches of a key's events with no gap longer than ``gap``."""
    return stream.withWatermark(time, lateness).groupBy(F.session_window(time, gap).alias("s"), key).agg(F.count("*").alias("events")).select(key, "s.start", "s.end", "events")


def _pointer(spark: SparkSession, path: str) -> tuple[int | None, int | None]:
    """(current batch, the one before it) of a kept table; None where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return None, None
    stream = fs.open(where)
    try:
        now, before = bytes(stream.readAllBytes()).decode().split(",")
    finally:
        stream.close()
    return int(now), int(before) if before else None


def _point(spark: SparkSession, path: str, now: int, before: int | None) -> None:
    """Replaces the pointer of a kept table: written beside it, then moved into its place."""
    jvm = spark._jvm
    new, old = jvm.org.apache.hadoop.fs.Path(f"{path}/_next"), jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(new, True)
    out.write(bytearray(f"{now},{'' if before is None else before}".encode()))
    out.close()
    fs.delete(old, False)
    fs.rename(new, old)


def current_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table that ``keep_table`` keeps, as of its last finished batch."""
    now, _ = _pointer(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/batch={now}") if now is not None else spark.createDataFrame([], schema)


def keep_table(stream: DataFrame, path: str, keys: Sequence[str], content: str, order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Takes a stream of deliveries into a table of Parquet files: each batch is settled by key and merged by content hash.

    A batch is written to a folder of its own, named by its number; the file that names the current folder is replaced
    last, so readers (``current_table``) see whole batches only.  A batch that is run again after a failure starts from
    the folder of the batch before it and gives the same result; older folders are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now, before = _pointer(spark, path)
        base = before if now == number else now
        table = spark.read.schema(batch.schema).parquet(f"{path}/batch={base}") if base is not None else spark.createDataFrame([], batch.schema)
        news = latest(batch, keys, [F.col(c) for c in order])
        upsert(table, news, keys, content).drop("change").write.mode("overwrite").parquet(f"{path}/batch={number}")
        _point(spark, path, number, base)
        if now != number and before is not None:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={before}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
