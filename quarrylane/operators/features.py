"""Per-block features from warehouse tables: counts, exact gas-weighted fee percentiles, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import threshold
from ..plans.catalog import DatasetError, Selection
from ..sources import warehouse
from ..sources.warehouse import scan_by_time


def tx_counts(transactions: DataFrame) -> DataFrame:
    """(block_hash, tx_count)."""
    return transactions.groupBy("block_hash").agg(F.count(F.lit(1)).alias("tx_count"))


def receipts_of(blocks: DataFrame, receipts: DataFrame, hashed: bool = False) -> DataFrame:
    """Receipts of the given blocks, matched by hash so that forks drop out, with their priority fees; with hashed, their block_hash too."""
    own = blocks.select("block_number", "block_hash", "base_fee_per_gas", F.col("gas_used").alias("block_gas_used"))
    joined = receipts.select("block_hash", "transaction_index", "gas_used", "effective_gas_price").join(own, "block_hash")
    fee = (F.col("effective_gas_price") - F.col("base_fee_per_gas")).alias("priority_fee")
    return joined.select(*(["block_hash"] if hashed else []), "block_number", "transaction_index", "gas_used", fee, "block_gas_used")


def running_gas(receipts: DataFrame, by: str = "block_number") -> DataFrame:
    """receipts_of's rows with running_gas: the block's gas up to each, by fee and then place."""
    at = Window.partitionBy(by).orderBy("priority_fee", "transaction_index").rowsBetween(Window.unboundedPreceding, 0)
    return receipts.withColumn("running_gas", F.sum("gas_used").over(at))


def priority_fee_percentiles(running: DataFrame, percents: list[int] | tuple[int, ...], by: str = "block_number") -> DataFrame:
    """(block_number, p<percent>...): the least fee at which running gas reaches ceil(gas * percent / 100). by may be block_hash instead."""
    reached = {p: F.col("running_gas") >= threshold(F.col("block_gas_used"), p) for p in percents}
    return running.groupBy(by).agg(*(F.min(F.when(ok, F.col("priority_fee"))).alias(f"p{p}") for p, ok in reached.items()))


def build_block_features(blocks: DataFrame, transactions: DataFrame | None, receipts: DataFrame | None, names: list[str] | tuple[str, ...], first: int | None = None, last: int | None = None, times: tuple[int, int] | None = None) -> DataFrame:
    """One row per block of first..last (all by default): block_number and the named features.

    Blocks without transactions have counts and percentiles of 0. Tables that the selection does
    not need are not read. times are the first and the last block's unix seconds: with them, the
    tables that have block_timestamp are read only between these, which no block's rows lie
    outside. Rows are in no order; writing sorts them.
    """
    plan = Selection.of(names)
    made = blocks
    if times is not None:
        blocks, transactions, receipts = (scan_by_time(x, *times) if x is not None and "block_timestamp" in x.columns else x for x in (blocks, transactions, receipts))
        made = blocks
    if first is not None:
        made = made.where(F.col("block_number") >= first)
    if last is not None:
        made = made.where(F.col("block_number") <= last)
    bounded, zero = made, F.lit(0).cast("bigint")
    made = made.select("block_number", *(c for c in plan.names if c in blocks.columns and c != "tx_count"), *([] if "block_hash" in plan.names else ["block_hash"]))
    if "tx_count" in plan.names:
        made = made.join(tx_counts(transactions), "block_hash", "left").withColumn("tx_count", F.coalesce("tx_count", zero))
    if plan.percentiles:
        # By hash throughout: receipts lie by hash from their join, and move no second time.
        fees = priority_fee_percentiles(running_gas(receipts_of(bounded, receipts, hashed=True), "block_hash"), list(plan.percentiles.values()), "block_hash")
        made = made.join(fees, "block_hash", "left")
        made = made.withColumns({n: F.coalesce(f"p{p}", zero) for n, p in plan.percentiles.items()})
    return made.select(*plan.columns)


def features_from_warehouse(blocks: DataFrame, transactions: DataFrame | None, receipts: DataFrame | None, names: list[str] | tuple[str, ...], first: int, last: int) -> DataFrame:
    """The features of blocks first..last from a warehouse's own tables, with its names and types.

    The columns that the selection needs are checked before anything is read; others may be missing,
    and so may a table that it does not need. One scan of the blocks' numbers and times gives the
    time span by which the tables are then read.
    """
    plan = Selection.of(names)
    for table, asked, name in ((transactions, "tx_count" in plan.names, "transactions"), (receipts, plan.percentiles, "receipts")):
        if asked and table is None:
            raise DatasetError("SOURCE_SCHEMA", f"the {name} table is needed")
    blocks = warehouse.blocks_of(blocks, plan)
    transactions = warehouse.transactions_of(transactions) if "tx_count" in plan.names else None
    receipts = warehouse.receipts_of(receipts) if plan.percentiles else None
    span = blocks.where(F.col("block_number").between(first, last)).agg(F.min("timestamp"), F.max("timestamp")).first()
    return build_block_features(blocks, transactions, receipts, names, first, last, None if span[0] is None else tuple(span))


def receipt_gaps(blocks: DataFrame, receipts: DataFrame) -> DataFrame:
    """Blocks whose receipts do not add up, or whose gas is impossible: block_number, gas_used, receipt_gas, reason."""
    sums = receipts.groupBy("block_hash").agg(F.sum("gas_used").alias("receipt_gas"))
    joined = blocks.select("block_number", "block_hash", "gas_used", "gas_limit").join(sums, "block_hash", "left")
    gas = F.coalesce("receipt_gas", F.lit(0).cast("bigint"))
    reason = F.when(gas != F.col("gas_used"), "incomplete").when((F.col("gas_limit") <= 0) | (F.col("gas_used") > F.col("gas_limit")), "gas_domain")
    return joined.select("block_number", "gas_used", gas.alias("receipt_gas"), reason.alias("reason")).where("reason is not null")
