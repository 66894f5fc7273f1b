"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import packed_hash, unpacked_hash
from ..operators.canonical import line_spans, off_line, rows_on
from ..operators.features import build_block_features, receipt_gaps
from ..plans.catalog import KEY, DatasetError, Selection
from ..sources.decode import decode_headers
from ..sources.scratch import stored

LANDED = "requested bigint, reply string"
RECEIPTS = "block_hash string, transaction_index bigint, gas_used bigint, effective_gas_price bigint"
#: Blocks below the finished ones among which receipts that land again are still recognised.
KEEP = 1024
#: Receipts land at most so many blocks before their own block is final.
LEAD = 100_000
#: The columns by which receipts are judged and fees counted.
JUDGES = ("gas_used", "gas_limit", "base_fee_per_gas")
#: Numbers of one of Spark's bitmaps, 2^15: a set of block numbers takes 4 KB for each.
SPAN = 32_768


def _has_rows(spark: SparkSession, out: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.exists(path) and any(str(f.getPath().getName()).startswith("part-") for f in fs.listStatus(path))


def _stored(spark: SparkSession, out: str, low: int, high: int, key: list[str]) -> DataFrame | None:
    """The keys from low to high that the sink has; None while it has no file."""
    return spark.read.parquet(out).where(F.col(KEY).between(low, high)).select(*key) if _has_rows(spark, out) else None


def _append_new(batch: DataFrame, out: str, key: list[str]) -> None:
    """Append the rows whose key is not stored yet; the sink is read only over the batch's range of numbers."""
    spark = batch.sparkSession
    once = batch.dropDuplicates(key).persist()
    try:
        low, high = once.agg(F.min(KEY), F.max(KEY)).first()
        if low is None:
            return
        there = _stored(spark, out, low, high, key)
        fresh = once if there is None else once.join(there, key, "left_anti")
        fresh.write.mode("append").parquet(out)
    finally:
        once.unpersist()


def stream_headers(spark: SparkSession, src: str, out: str, checkpoint: str) -> None:
    """Decode the landed replies (JSON lines of requested and reply) that are new; store each header once, by its hash.

    Files may be delivered again and the run may be restarted: headers already stored are left out,
    so a batch that is replayed after a crash changes nothing. Before a block is final the chain can
    replace it, so several headers of one number are kept; which one counts is decided on reading,
    by `finalized_view`. Rejected replies are not stored.
    """

    def ingest(batch: DataFrame, _: int) -> None:
        good = decode_headers(batch).where("reject_reason is null").drop("reject_reason")
        _append_new(good, out, [KEY, "block_hash"])

    landed = spark.readStream.schema(LANDED).json(src)
    landed.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def finalized_view(bronze: DataFrame, head: int, head_hash: str | None = None, first: int | None = None) -> DataFrame:
    """The stored headers on the line that ends at the finalized head: one per number, none of a losing branch.

    Without head_hash, there must be just one header at the head's height.
    The filter is applied on reading, so a late head needs no replay. With `first`, the line must
    reach down to that number; a header that is missing on the way is an error, not a shorter view.
    """
    if head_hash is None:
        tops = [r[0] for r in bronze.where(F.col(KEY) == head).select("block_hash").distinct().limit(2).collect()]
        if len(tops) != 1:
            raise DatasetError("CHAIN_HEAD", f"{'no' if not tops else 'more than one'} header is at {head}: name the final one")
        head_hash = tops[0]
    asked = bronze if first is None else bronze.where(F.col(KEY) >= first)
    spans = line_spans(asked, head, head_hash)
    if first is not None and spans.agg(F.min("low")).first()[0] != first:
        raise DatasetError("CHAIN_BROKEN", f"the line from {head} does not lead to {first}")
    return rows_on(asked, spans, head, head_hash)


def _state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A batch's state; empty if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    there = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def _forget(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def _bits(numbers: DataFrame) -> DataFrame:
    """(_span, _bits, _rows): a set of block numbers, one bit each, so that it can be sent to every task; _rows counts repeated ones too."""
    place = F.col(KEY).bitwiseAND(SPAN - 1)
    return numbers.groupBy(F.shiftright(KEY, 15).alias("_span")).agg(F.bitmap_construct_agg(place).alias("_bits"), F.count(F.lit(1)).alias("_rows"))


def _among(rows: DataFrame, bits: DataFrame, name: str) -> DataFrame:
    """rows with a column that says whether their block number is in a set; rows do not move."""
    place = F.col(KEY).bitwiseAND(SPAN - 1)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    found = F.coalesce(F.getbit(byte, place.bitwiseAND(7)) == 1, F.lit(False))
    near = rows.withColumn("_span", F.shiftright(KEY, 15)).join(F.broadcast(bits.select("_span", "_bits")), "_span", "left")
    return near.withColumn(name, found).drop("_span", "_bits")


def _unbroken(done: DataFrame, low: int, high: int) -> int:
    """The last number of which all from low on are in the set done, which has none outside low to high; low - 1 if low is not."""
    spark, start = done.sparkSession, F.col("_span") * SPAN
    size = F.least(F.lit(high), start + SPAN - 1) - F.greatest(F.lit(low), start) + 1
    spans = spark.range(low // SPAN, high // SPAN + 1).withColumnRenamed("id", "_span").join(done, "_span", "left")
    first = spans.where(F.coalesce(F.bitmap_count("_bits"), F.lit(0)) < size).agg(F.min("_span")).first()[0]
    if first is None:
        return high
    inside = spark.range(max(low, first * SPAN), min(high, first * SPAN + SPAN - 1) + 1).withColumnRenamed("id", KEY)
    return _among(inside, done, "there").where("not there").agg(F.min(KEY)).first()[0] - 1


def stream_features(
    spark: SparkSession, src: str, blocks: DataFrame | str, out: str, checkpoint: str, names: list[str], finalized: Callable[[], tuple[int, str] | None] | None = None, keep: int = KEEP, lead: int = LEAD
) -> None:
    """Store the features of each block once its receipts add up.

    src holds landed receipts as Parquet (block_hash, transaction_index, gas_used,
    effective_gas_price); blocks is a table of headers, or a path that is listed anew for each
    batch. finalized gives the number and hash of the finalized head, or None while there is none:
    then forks may be among the headers, and only blocks on the head's line are stored. Without
    it, all blocks are taken to be final and to have one header each.

    A block is complete when its receipts' gas is the block's; one without gas is complete at once,
    whenever its header lands. Where all blocks up to one are stored, a mark moves up to it, and no
    later batch reads headers or stored rows further than `keep` below the mark. Receipts of blocks
    that are not complete, or not known yet, are kept as state. Those of a losing branch go as soon
    as the head is past it, and those whose block is still unknown when the mark has moved `lead` on
    since they landed, as no block of theirs can come any more; so the state does not grow with what has passed. A
    replayed batch reads the same state and writes the same again. When all has been read, blocks
    that are complete without new receipts are stored as well, if there are other headers or another
    head than the last batch had. A header below one that is missing is not lost: it waits for that.

    Within a batch receipts move once, by block, and so do the columns of the headers that judge
    them (hash, number, gas, base fee); the others move for complete blocks only. Hashes move as 32 bytes.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan, judged = Selection.of(names), []  # judged: what the last batch of this call saw, the head and the headers' files

    def by_block(rows: DataFrame) -> DataFrame:
        hashes = {c: packed_hash(F.col(c)) for c in ("block_hash", "parent_hash") if c in rows.columns}
        return rows.withColumns(hashes).repartition(parts, "block_hash")

    def known() -> tuple[tuple[int, str] | None, list[str], DataFrame]:
        """(the head, the headers' files, headers)."""
        head = finalized() if finalized is not None else None
        rows = spark.read.parquet(blocks) if isinstance(blocks, str) else blocks
        return head, sorted(rows.inputFiles()), rows.where(F.col("block_hash").isNotNull())

    def window(mark: int | None, head: tuple[int, str] | None, rows: DataFrame) -> tuple[int, int, DataFrame, DataFrame] | None:
        """(mark, highest number, headers near and above the mark, what judges them: block_hash, block_number, JUDGES, lost, open); open ones are above the mark and on the line."""
        if finalized is not None and head is None:
            return None
        n = F.col(KEY)
        if mark is None:  # the first batch: the chain begins below its first header
            low = rows.where(n > -1).agg(F.min(KEY)).first()[0]
            if low is None:
                return None
            mark = low - 1
        near = rows.where(n > mark - keep)
        if head is None:
            low, high, lost = mark + 1, near.agg(F.max(KEY)).first()[0], F.lit(False)
        else:
            near, high = near.where(n <= head[0]), head[0]
            low, losers = off_line(near, *head) or (high + 1, None)
            lost = (n == high) & (F.col("block_hash") != packed_hash(F.lit(head[1]))) & F.lit(losers is not None)
        if high is None or high <= mark - keep:
            return None
        judges = by_block(near.select(KEY, "block_hash", *(c for c in JUDGES if c in near.columns))).dropDuplicates(["block_hash"])
        if head is not None and losers is not None:
            at = losers.withColumnRenamed("hash", "block_hash").repartition(parts, "block_hash").groupBy("block_hash").agg(F.collect_set(KEY).alias("at"))  # one height
            judges, lost = judges.join(at, "block_hash", "left"), lost | F.coalesce(F.array_contains("at", n), F.lit(False))
        judges = judges.withColumn("lost", lost).withColumn("open", ~F.col("lost") & (n >= low) & (n > mark)).drop("at")
        return mark, high, near, judges.persist()

    def emitted(found: tuple[int, int, DataFrame, DataFrame], landed: DataFrame) -> DataFrame:
        """Store what is complete; the numbers above the mark that are stored then, as a set."""
        mark, high, near, judges = found
        there = _stored(spark, out, mark + 1, high, [KEY])
        before = stored(_bits(spark.range(0).withColumnRenamed("id", KEY) if there is None else there))
        fresh = _among(judges.where("open"), before, "there").where("not there").drop("there", "lost", "open")
        complete = _among(fresh, _bits(receipt_gaps(fresh, landed)), "gap").where("not gap").drop("gap")
        now = stored(_bits(complete))
        rows, blocks_now = now.agg(F.sum("_rows"), F.sum(F.bitmap_count("_bits"))).first()
        if rows is None:
            return before
        counted = ["block_hash", *(c for c in plan.names if c == "tx_count" or c in plan.percentiles)]
        ready = _among(judges.where("open"), now, "now").where("now").drop("now", "lost", "open")
        ready = build_block_features(ready, landed.select("block_hash"), landed, counted).drop(KEY)
        whole = by_block(_among(near.select(KEY, "block_hash", *(c for c in plan.names if c not in counted)), now, "now").where("now").drop("now"))
        made = whole.dropDuplicates(["block_hash"]).join(ready, "block_hash").select(*plan.columns)
        made = made if rows == blocks_now else made.dropDuplicates([KEY])  # two headers of one number, though all are taken to be final
        made.withColumns({c: unpacked_hash(F.col(c)) for c in ("block_hash", "parent_hash") if c in plan.names}).write.mode("append").option("compression", "zstd").parquet(out)
        return stored(before.unionByName(now).groupBy("_span").agg(F.bitmap_or_agg("_bits").alias("_bits")))

    def ingest(batch: DataFrame, number: int) -> None:
        old = _state(spark, f"{checkpoint}/mark/{number - 1}", "mark bigint").agg(F.max("mark")).first()[0]
        held = _state(spark, f"{checkpoint}/pending/{number - 1}", f"{RECEIPTS}, since bigint")
        new = batch.select("block_hash", "transaction_index", "gas_used", "effective_gas_price", F.lit(-1 if old is None else old).cast("bigint").alias("since"))
        # Dealt out by block once: what follows counts, joins and sorts by block_hash, and moves no receipt for that. Of one that lands twice, the first one's time counts.
        landed = by_block(new.unionByName(held)).groupBy("block_hash", "transaction_index").agg(F.min(F.struct("since", "gas_used", "effective_gas_price")).alias("x"))
        landed = landed.select("block_hash", "transaction_index", "x.gas_used", "x.effective_gas_price", "x.since").persist()
        head, files, rows = known()
        mark, left, found = old, landed, window(old, head, rows)
        try:
            if found is not None:
                passed, high, _, judges = found
                done = emitted(found, landed)
                mark = _unbroken(done, passed + 1, high) if high > passed else passed
                # Kept: the receipts of blocks that are not stored yet, and of unknown blocks for a while.
                status = _among(judges, done, "done").select("block_hash", (F.col("lost") | F.col("done") | (F.col(KEY) <= passed)).alias("gone"))
                young = F.coalesce(F.col("since") + lead > F.lit(mark), F.lit(True))
                left = landed.join(status, "block_hash", "left").where(F.coalesce(~F.col("gone"), young)).drop("gone")
            left.withColumn("block_hash", unpacked_hash(F.col("block_hash"))).write.mode("overwrite").option("compression", "zstd").parquet(f"{checkpoint}/pending/{number}")
        finally:
            landed.unpersist()
            if found is not None:
                found[3].unpersist()
        spark.createDataFrame([(mark,)], "mark bigint").write.mode("overwrite").parquet(f"{checkpoint}/mark/{number}")
        judged[:] = [(head, files)]
        for kind in ("pending", "mark"):  # the batch before may still be asked for
            _forget(spark, f"{checkpoint}/{kind}/{number - 2}")

    stream = spark.readStream.schema(RECEIPTS).parquet(src)
    query = stream.writeStream.foreachBatch(ingest).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start()
    query.awaitTermination()
    head, files, rows = known()
    if files and judged == [(head, files)]:
        return
    last = _last_batch(spark, f"{checkpoint}/mark")
    mark = None if last is None else _state(spark, f"{checkpoint}/mark/{last}", "mark bigint").agg(F.max("mark")).first()[0]
    found = window(mark, head, rows)
    if found is not None:
        held = spark.createDataFrame([], f"{RECEIPTS}, since bigint") if last is None else _state(spark, f"{checkpoint}/pending/{last}", f"{RECEIPTS}, since bigint")
        landed = by_block(held).persist()
        try:
            emitted(found, landed)
        finally:
            landed.unpersist()
            found[3].unpersist()


def _last_batch(spark: SparkSession, path: str) -> int | None:
    """The highest batch that has written its state."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = [int(f.getPath().getName()) for f in fs.listStatus(at)] if fs.exists(at) else []
    return max(found, default=None)
