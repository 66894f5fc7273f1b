"""Block-shaped views over the general tables: events become blocks, line items become receipts."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import as_hash, to_quantity, unix_seconds_ntz, utc_text

BASE_FEE = 1_000_000_000
GAS_LIMIT = 30_000_000
FINALITY = 100


class Fixtures:
    """The views over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def events(self) -> DataFrame:
        """(n, timestamp): the number and time of each block."""
        return self.table("events").select(F.col("event_id").cast("bigint").alias("n"), unix_seconds_ntz(F.col("ts").cast("timestamp_ntz")).alias("timestamp"))

    def receipts(self, timed: bool = False) -> DataFrame:
        """block_hash, transaction_index, gas_used, effective_gas_price; a third belongs to no block. With timed, what timed() adds, found by the blocks' numbers: the rows lie by these."""
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
        at = Window.partitionBy("l_orderkey").orderBy(*order)
        price = F.lit(BASE_FEE).cast("bigint") + F.col("l_orderkey") + F.round(F.col("l_extendedprice") * 100).cast("bigint")
        rows = self.table("lineitem").select("l_orderkey", F.col("l_quantity").cast("bigint").alias("gas_used"), price.alias("effective_gas_price"), (F.row_number().over(at) - 1).cast("bigint").alias("transaction_index"))
        times = []
        if timed:
            last = self.events().agg(F.max("timestamp")).first()[0]
            rows = rows.join(self.events().withColumnRenamed("n", "l_orderkey"), "l_orderkey", "left")
            times = [F.coalesce("timestamp", F.lit(last)).alias("block_timestamp")]
        return rows.select(as_hash(F.col("l_orderkey")).alias("block_hash"), "transaction_index", "gas_used", "effective_gas_price", *times)

    def transactions(self) -> DataFrame:
        return self.table("lineitem").select(as_hash(F.col("l_orderkey")).alias("block_hash"))

    def timed(self, rows: DataFrame) -> DataFrame:
        """Receipts or transactions with block_timestamp: the block's, or the last block's for forks."""
        blocks = self.events().select(as_hash(F.col("n")).alias("block_hash"), F.col("timestamp").alias("block_timestamp"))
        last = self.events().agg(F.max("timestamp")).first()[0]
        return rows.join(blocks, "block_hash", "left").withColumn("block_timestamp", F.coalesce("block_timestamp", F.lit(last)))

    def headers(self) -> DataFrame:
        """Blocks as a warehouse has them: without transaction counts."""
        gas = self.table("lineitem").groupBy(F.col("l_orderkey").alias("n")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("gas_used"))
        return self.events().join(gas, "n", "left").select(*_header(), F.coalesce("gas_used", F.lit(0).cast("bigint")).alias("gas_used"), F.lit(GAS_LIMIT).cast("bigint").alias("gas_limit"))

    def blocks(self) -> DataFrame:
        """Decoded blocks with gas and transaction counts."""
        per_block = self.table("lineitem").groupBy(F.col("l_orderkey").alias("n")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("gas_used"), F.count(F.lit(1)).alias("tx_count"))
        zero = F.lit(0).cast("bigint")
        return self.events().join(per_block, "n", "left").select(*_header(), F.coalesce("gas_used", zero).alias("gas_used"), F.lit(GAS_LIMIT).cast("bigint").alias("gas_limit"), F.coalesce("tx_count", zero).alias("tx_count"))

    def warehouse(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(blocks, transactions, receipts) with a warehouse's names and types, and one column more than is needed."""
        dated = lambda rows, c: rows.withColumn("block_timestamp", F.timestamp_seconds(c)).withColumn("extra", F.lit("x"))
        blocks = dated(self.headers(), "timestamp").drop("timestamp")
        times = lambda rows: dated(self.timed(rows).withColumnRenamed("block_timestamp", "seconds"), "seconds").drop("seconds")
        return blocks, times(self.transactions()), times(self.receipts()).withColumn("transaction_index", F.col("transaction_index").cast("int"))

    def head(self) -> int:
        """The finalized head."""
        return self.table("events").agg(F.max("event_id").cast("bigint") - FINALITY).first()[0]

    def hash_at(self, number: int) -> str:
        """The hash of a block of the true chain."""
        return "0x" + hashlib.sha256(str(number).encode()).hexdigest()

    def forked(self, blocks: DataFrame | None = None) -> DataFrame:
        """blocks with losing branches of one to three blocks beside them, each grown on a block of the true chain."""
        blocks = self.blocks() if blocks is None else blocks
        return blocks.unionByName(self.losing(blocks))

    def losing(self, blocks: DataFrame) -> DataFrame:
        """The blocks of the losing branches alone."""
        n = F.col("block_number")
        depth = n % 97 - 40  # 1 to 3 on a branch: its first block has a parent of the true chain
        losing = lambda m: as_hash(F.concat(F.lit("fork"), m.cast("string")))
        return blocks.where((n > 100) & depth.between(1, n % 3 + 1)).withColumns({"block_hash": losing(n), "parent_hash": F.when(depth == 1, as_hash(n - 1)).otherwise(losing(n - 1)), "base_fee_per_gas": F.col("base_fee_per_gas") + 7})

    def raw_blocks(self, blocks: DataFrame | None = None, spoil: bool = True) -> DataFrame:
        """(requested, reply): block replies as JSON text; every 50th is spoilt in one of seven ways."""
        blocks = self.blocks() if blocks is None else blocks
        n = F.col("block_number")
        entries = F.transform(F.sequence(F.lit(1).cast("bigint"), F.greatest("tx_count", F.lit(1))), lambda i: i.cast("string"))
        entries = F.when(F.col("tx_count") > 0, entries).otherwise(F.array().cast("array<string>"))
        spoilt = lambda k: F.coalesce(n % 350 == 50 * k + 49, F.lit(False)) & F.lit(spoil)
        reply = F.struct(
            to_quantity(F.when(spoilt(0), n + 1).otherwise(n)).alias("number"),
            F.when(spoilt(1), F.upper("block_hash")).otherwise(F.col("block_hash")).alias("hash"),
            F.when(~spoilt(2), F.col("parent_hash")).alias("parentHash"),
            to_quantity(F.col("timestamp")).alias("timestamp"),
            F.when(spoilt(3), F.lit("0x0")).when(spoilt(4), F.lit("0x00ff")).otherwise(to_quantity(F.col("base_fee_per_gas"))).alias("baseFeePerGas"),
            to_quantity(F.when(spoilt(5), F.col("gas_limit") + 1).otherwise(F.col("gas_used"))).alias("gasUsed"),
            to_quantity(F.col("gas_limit")).alias("gasLimit"),
            F.when(~spoilt(6), entries).alias("transactions"),
        )
        return blocks.select(n.alias("requested"), F.to_json(reply).alias("reply"))

    def requests(self, size: int = 20) -> DataFrame:
        """(call_id, batch_id, block_number): one call per block, in batches."""
        return self.events().select(F.col("n").alias("call_id"), F.floor(F.col("n") / size).cast("bigint").alias("batch_id"), F.col("n").alias("block_number"))

    def replies(self) -> DataFrame:
        """Replies with calls left out, errors, repeats, unknown ids and other faults."""
        n = F.col("call_id")
        base = self.requests().where(n % 101 != 7).select("batch_id", n.alias("id"), F.when(n % 521 == 17, "1.0").otherwise("2.0").alias("jsonrpc"), F.when((n % 211 != 3) & (n % 223 != 4) & (n % 227 != 5) & (n % 229 != 6), F.concat(F.lit("r"), n.cast("string"))).alias("result"), F.when(n % 211 == 3, -32603).when(n % 223 == 4, -32005).when(n % 227 == 5, -32601).cast("bigint").alias("error_code"), F.when(n % 523 == 18, True).otherwise(n % 229 != 6).alias("has_result"))
        again = base.where(F.col("id") % 307 == 5)
        unknown = base.where(F.col("id") % 401 == 9).withColumn("id", F.col("id") + 10_000_000)
        return base.unionByName(again).unionByName(unknown)

    def landed_batches(self) -> DataFrame:
        """(batch_id, payload): the replies as JSON lists, in falling order of ids, with members and payloads of wrong shapes among them."""
        n = F.col("id")
        error = F.when(
            F.col("error_code").isNotNull(),
            F.concat(F.lit('"error":{"code":'), F.when(n % 211 == 3, F.when(n % 2 == 1, F.lit('"-32603"')).otherwise(F.lit("-32603"))).otherwise(F.col("error_code").cast("string")), F.when(n % 223 == 4, F.when(n % 3 == 1, F.lit("")).otherwise(F.lit(',"message":"slow"'))).otherwise(F.lit(',"message":"bad"')), F.lit("}")),
        )
        result = F.when(F.col("has_result"), F.concat(F.lit('"result":'), F.coalesce(F.concat(F.lit('{"number":"'), to_quantity(n), F.lit('"}')), F.lit("null")))).otherwise(F.lit(None))
        result = F.when(F.col("has_result") & F.col("result").isNull() & F.col("error_code").isNull(), F.lit('"result":null')).otherwise(F.when(F.col("result").isNotNull(), result))
        number = F.when(n % 541 == 11, F.concat(F.lit('"'), n.cast("string"), F.lit('"'))).when(n % 547 == 12, F.concat(n.cast("string"), F.lit(".5"))).otherwise(n.cast("string"))
        fields = F.concat_ws(",", F.concat(F.lit('"jsonrpc":"'), F.col("jsonrpc"), F.lit('"')), F.concat(F.lit('"id":'), number), result, error)
        member = F.when(n % 557 == 13, F.concat(F.lit('"'), n.cast("string"), F.lit('"'))).otherwise(F.concat(F.lit("{"), fields, F.lit("}")))
        lists = self.replies().select("batch_id", F.struct(n.alias("id"), member.alias("member")).alias("m")).groupBy("batch_id").agg(F.sort_array(F.collect_list("m"), asc=False).alias("ms"))  # 20 calls each
        text = F.concat(F.lit("["), F.array_join(F.transform("ms", lambda x: x["member"]), ","), F.lit("]"))
        b = F.col("batch_id")
        return lists.select("batch_id", F.when(b % 97 == 41, F.concat(F.lit('{"all":'), text, F.lit("}"))).when(b % 101 == 43, F.substring(text, 2, 1 << 20)).otherwise(text).alias("payload"))

    def verifier(self) -> DataFrame:
        """An independent copy that disagrees in some fees and parents and lacks some rows."""
        n = F.col("block_number")
        return self.blocks().where(n % 2003 != 29).withColumns({"base_fee_per_gas": F.when(n % 997 == 13, F.col("base_fee_per_gas") + 1).otherwise(F.col("base_fee_per_gas")), "parent_hash": F.when(n % 1009 == 17, as_hash(n - 2)).otherwise(F.col("parent_hash"))})

    def broken(self) -> DataFrame:
        """Blocks with impossible gas, null times, upper-case hashes and missing rows."""
        n = F.col("block_number")
        return self.blocks().where(n % 1013 != 31).withColumns({"gas_used": F.when(n % 499 == 11, F.col("gas_limit") + 1).otherwise(F.col("gas_used")), "timestamp": F.when(n % 701 != 19, F.col("timestamp")), "block_hash": F.when(n % 809 == 23, F.upper("block_hash")).otherwise(F.col("block_hash"))})

    def ranges(self) -> DataFrame:
        """(range_id, from_value, to_value): time ranges of all precisions taken from the events, some impossible."""
        n, t = F.col("n"), F.col("timestamp")
        text = lambda x: utc_text(x)
        later = t + 7200 + (n % 5) * 3600
        kind = n % 8
        cut = lambda x, k: F.substring(text(x), 1, k)
        start = F.when(kind == 0, cut(t, 10)).when(kind == 1, F.concat(cut(t, 13), F.lit("Z"))).when(kind == 2, F.concat(cut(t, 16), F.lit("+01:00"))).when(kind == 6, F.lit("1960-01-01")).otherwise(text(t))
        end = F.when(kind == 0, cut(t, 10)).when(kind == 1, F.concat(cut(later, 13), F.lit("Z"))).when(kind == 2, F.concat(cut(later + 3600, 16), F.lit("+01:00"))).when(kind == 3, F.lit("2999-01-01T00:00:00Z")).when(kind == 4, text(t - 5)).when(kind == 5, F.lit("soon")).when(kind == 6, text(t)).otherwise(text(later))
        return self.events().select(n.alias("range_id"), start.alias("from_value"), end.alias("to_value"))


def _header() -> list[Column]:
    n = F.col("n")
    return [n.alias("block_number"), F.col("timestamp"), as_hash(n).alias("block_hash"), as_hash(n - 1).alias("parent_hash"), (F.lit(BASE_FEE).cast("bigint") + n).alias("base_fee_per_gas")]
