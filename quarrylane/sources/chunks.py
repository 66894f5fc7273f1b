"""Chunks of consecutive blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_SIZE = 1024


def with_chunk_id(df: DataFrame, first: int, size: int = CHUNK_SIZE) -> DataFrame:
    """df with chunk_id, the number of the chunk of `size` blocks counted from `first`."""
    return df.withColumn("chunk_id", F.floor((F.col("block_number") - first) / size).cast("bigint"))


def chunk_bounds(df: DataFrame, first: int, size: int = CHUNK_SIZE) -> DataFrame:
    """(chunk_id, from_block, to_block, row_count, distinct_blocks) of each chunk that has rows."""
    n = F.count(F.lit(1))
    return with_chunk_id(df, first, size).groupBy("chunk_id").agg(F.min("block_number").alias("from_block"), F.max("block_number").alias("to_block"), n.alias("row_count"), F.count_distinct("block_number").alias("distinct_blocks"))


def planned_chunks(spark, first: int, last: int, size: int = CHUNK_SIZE) -> DataFrame:
    """(chunk_id, from_block, to_block) of the chunks that a range should have."""
    ids = spark.range(0, (last - first) // size + 1).select(F.col("id").alias("chunk_id"))
    start = F.lit(first) + F.col("chunk_id") * size
    return ids.select("chunk_id", start.alias("from_block"), F.least(start + size - 1, F.lit(last)).alias("to_block"))
