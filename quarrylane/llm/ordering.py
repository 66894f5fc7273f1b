"""Neighbours in a global order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import durable

#: At most so many ranges: their edge rows are joined in one small task.
MAX_RANGES = 4096


def successors(keys: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """keys with `next`, a struct of `columns` of the row that follows in `order`.

    The last row's next is the first row (its own if it is alone). keys holds distinct, light rows:
    they are dealt to ranges, each range is sorted by a window of its own, and only the ranges'
    first rows meet in one place.
    """
    session = keys.sparkSession
    ranges = min(MAX_RANGES, int(session.conf.get("spark.sql.shuffle.partitions")))
    dealt = durable(keys.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()))
    row = F.struct(*columns)
    inside = Window.partitionBy("__range").orderBy(*order)
    led = dealt.withColumns({"__next": F.lead(row).over(inside), "__k": F.row_number().over(inside)})
    heads = led.where("__k = 1").select("__range", row.alias("__head"))
    edge = Window.partitionBy(F.lit(0)).orderBy("__range")
    heads = heads.select("__range", F.lead("__head").over(edge).alias("__after"), F.first("__head").over(edge).alias("__start"))
    joined = led.join(F.broadcast(heads), "__range")  # MAX_RANGES rows at most
    return joined.withColumn("next", F.coalesce("__next", "__after", "__start")).drop("__range", "__next", "__k", "__after", "__start")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with their place, from 1, in a global order, in the column `name`; no window sees more than one row per range.

    Rows are dealt to ranges and each range is sorted; a row's number inside its range comes with the
    stored table, and the ranges' sizes, added up, give the rest. Rows equal in `order` may take
    each other's places.
    """
    ranges = min(MAX_RANGES, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = durable(dealt.withColumn("__at", F.monotonically_increasing_id()))  # 33 bits of row number below the partition's
    part, at = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dealt.groupBy(part.alias("__range")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__range")) - F.col("__n")
    starts = sizes.select("__range", before.alias("__before"))
    joined = dealt.withColumn("__range", part).join(F.broadcast(starts), "__range")  # MAX_RANGES rows at most
    return joined.withColumn(name, F.col("__before") + at + 1).drop("__range", "__at", "__before")
