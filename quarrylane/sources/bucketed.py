"""Warehouse tables stored by day and by buckets of the block hash, so that their join moves no row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 64


def save_bucketed(df: DataFrame, table: str, path: str | None = None, buckets: int = BUCKETS, key: str = "block_hash", time: str = "block_timestamp") -> DataFrame:
    """Store rows as a catalog table by the day of `time` and, inside, in sorted buckets of `key`; returns it.

    A time filter leaves out days, and a join by the key of two tables with as many buckets needs no
    exchange: each task reads its bucket of both. Rows are dealt to buckets before the write, so
    that each bucket of a day is one file. time is a timestamp, or unix seconds.
    """
    stamp = F.col(time) if df.schema[time].dataType.simpleString().startswith("timestamp") else F.timestamp_seconds(time)
    dealt = df.withColumn("day", F.to_date(stamp)).repartition(buckets, key)
    writer = dealt.write.partitionBy("day").bucketBy(buckets, key).sortBy(key)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return df.sparkSession.table(table).select(*df.columns, "day")


def scan_days(df: DataFrame, start: int, end: int, time: str = "block_timestamp") -> DataFrame:
    """The rows of a stored table between two unix seconds: whole days are left out by their folders, the rest by the rows' own time."""
    day = lambda s: F.to_date(F.timestamp_seconds(F.lit(s)))
    stamp = df.schema[time].dataType.simpleString().startswith("timestamp")
    low, high = (F.timestamp_seconds(F.lit(s)) if stamp else F.lit(s) for s in (start, end))
    return df.where(F.col("day").between(day(start), day(end)) & F.col(time).between(low, high)).drop("day")
