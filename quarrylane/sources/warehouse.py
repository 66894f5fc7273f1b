"""Warehouse tables: their columns, and scans of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.catalog import DatasetError, Selection

# Column names and kinds of the public warehouse tables.
BLOCKS = {"block_number": T.IntegralType, "block_timestamp": T.TimestampType, "block_hash": T.StringType, "parent_hash": T.StringType, "base_fee_per_gas": T.IntegralType, "gas_used": T.IntegralType, "gas_limit": T.IntegralType}
TRANSACTIONS = {"block_hash": T.StringType, "block_timestamp": T.TimestampType}
RECEIPTS = {"block_hash": T.StringType, "block_timestamp": T.TimestampType, "transaction_index": T.IntegralType, "gas_used": T.IntegralType, "effective_gas_price": T.IntegralType}


def require_columns(df: DataFrame, kinds: dict[str, type[T.DataType]]) -> DataFrame:
    """The frame itself; raises if a needed column is missing, not scalar or of another type."""
    for name, kind in kinds.items():
        field = next((f for f in df.schema.fields if f.name == name), None)
        if field is None or not isinstance(field.dataType, kind):
            raise DatasetError("SOURCE_SCHEMA", f"{name} must be {kind.__name__}, is {field.dataType.simpleString() if field else 'missing'}")
    return df


def _ours(df: DataFrame, kinds: dict[str, type[T.DataType]]) -> DataFrame:
    """The needed columns only, whole numbers as bigint."""
    cast = {name: F.col(name).cast("bigint") if kind is T.IntegralType else F.col(name) for name, kind in kinds.items()}
    return require_columns(df, kinds).select(*(c.alias(n) for n, c in cast.items()))


def needed_blocks(plan: Selection) -> dict[str, type[T.DataType]]:
    """The columns of the blocks table that a selection needs: identity, links and time always, fees and gas if selected or implied."""
    needed = {"block_number", "block_timestamp", "block_hash", "parent_hash", *plan.names, *plan.hidden}
    return {name: kind for name, kind in BLOCKS.items() if name in needed}


def blocks_of(df: DataFrame, plan: Selection) -> DataFrame:
    """A warehouse's blocks under our names, as far as a selection needs them: timestamp in unix seconds; block_timestamp stays, for pruned scans."""
    return _ours(df, needed_blocks(plan)).withColumn("timestamp", F.unix_seconds("block_timestamp"))


def transactions_of(df: DataFrame) -> DataFrame:
    return _ours(df, TRANSACTIONS)


def receipts_of(df: DataFrame) -> DataFrame:
    return _ours(df, RECEIPTS)


def _within(df: DataFrame, column: str, start: int, end: int) -> Column:
    """A filter on the stored column itself, so that it reaches the scan whether times are seconds or timestamps."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.col(column).between(F.timestamp_seconds(F.lit(start)), F.timestamp_seconds(F.lit(end)))
    return F.col(column).between(start, end)


def scan_blocks(df: DataFrame, first: int, last: int, start: int, end: int) -> DataFrame:
    """Blocks by number and by time, so that a table partitioned by time is pruned too."""
    time = "block_timestamp" if "block_timestamp" in df.columns else "timestamp"
    return df.where(F.col("block_number").between(first, last) & _within(df, time, start, end))


def scan_by_time(df: DataFrame, start: int, end: int, column: str = "block_timestamp") -> DataFrame:
    """Transactions or receipts by the blocks' time."""
    return df.where(_within(df, column, start, end))
