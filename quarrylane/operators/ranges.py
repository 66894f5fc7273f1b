"""Time and block ranges: normalising, checking, resolving and proving them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import INT64_MAX, time_bound
from ..sources.scratch import stored

HOUR = 3_600
DAY = 24 * HOUR


def normalize_bounds(requests: DataFrame) -> DataFrame:
    """requests (range_id, from_value, to_value) with start and end in unix seconds and code.

    code is RANGE_INVALID if a bound is none, or the start exceeds the end; else null.
    """
    bounds = F.struct(time_bound(F.col("from_value"), end=False).alias("start"), time_bound(F.col("to_value"), end=True).alias("end"))
    # Exploding one struct keeps the optimizer from writing the long expressions out at each use.
    made = requests.select("*", F.explode(F.array(bounds)).alias("_bounds")).select(*requests.columns, "_bounds.*")
    bad = F.col("start").isNull() | F.col("end").isNull() | (F.col("start") > F.col("end"))
    return made.withColumn("code", F.when(bad, "RANGE_INVALID"))


def check_requests(requests: DataFrame) -> DataFrame:
    """requests (range_id, from_block, to_block, from_time, to_time) with code.

    Exactly one form may be given, and completely; block bounds are nonnegative 64-bit integers in
    order; time bounds are as in normalize_bounds.
    """
    given = lambda *names: [F.col(n).isNotNull() for n in names]
    (b0, b1), (t0, t1) = given("from_block", "to_block"), given("from_time", "to_time")
    low, high = F.col("from_block"), F.col("to_block")
    fits = (low >= 0) & (high >= 0) & (low <= INT64_MAX) & (high <= INT64_MAX) & (low <= high)
    start, end = time_bound(F.col("from_time"), end=False), time_bound(F.col("to_time"), end=True)
    good = F.when((b0 | b1) & (t0 | t1), F.lit(False)).when(b0 & b1, fits).when(t0 & t1, F.coalesce(start <= end, F.lit(False))).otherwise(F.lit(False))
    return requests.withColumn("code", F.when(~good, "RANGE_INVALID"))


def finalized_head(heads: DataFrame) -> DataFrame:
    """One row: the lowest of the sources' finalized heads."""
    return heads.agg(F.min("block_number").alias("block_number"))


def _edge(found: DataFrame, dated: DataFrame, calendar: DataFrame, bucket: int, side: str) -> DataFrame:
    """(at, <side>_block, <side>_timestamp): the first (or last) block of each moment in found.

    First means the first block not before the moment, last the last one not after it. Moments and
    blocks of one bucket are sorted together by their seconds, one row for each, and the block is
    carried along: the work is that of the sort, however many blocks and moments a bucket has.
    Where no block of the bucket will do, the calendar has the next bucket's first or the previous
    one's last block.
    """
    pick, block, order = (F.min, "low", F.col("at").desc()) if side == "first" else (F.max, "high", F.col("at"))
    moments = found.select(F.floor(F.col("at") / bucket).cast("bigint").alias("bucket"), "at", F.lit(1).alias("asked"), F.lit(None).cast("bigint").alias("block"))
    both = moments.unionByName(dated.select("bucket", F.col("block_timestamp").alias("at"), F.lit(0).alias("asked"), F.col(block).alias("block")))
    seconds = both.groupBy("bucket", "at").agg(F.max("asked").alias("asked"), pick("block").alias("block"))
    so_far = Window.partitionBy("bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("block").isNotNull(), F.struct("block", F.col("at").alias("block_timestamp")))
    inside = seconds.withColumn("own", pick(own).over(so_far)).where("asked = 1")
    met = F.coalesce("own", "other")
    joined = inside.join(calendar.select("bucket", F.col(side).alias("other")), "bucket", "left")
    return joined.select("at", met.getField("block").alias(f"{side}_block"), met.getField("block_timestamp").alias(f"{side}_timestamp"))


def _calendar(dated: DataFrame, bucket: int, low: int, high: int) -> DataFrame:
    """(bucket, first, last) for every bucket from low to high: the next later bucket's first block, the nearest earlier one's last.

    One row for each hour (or day) of the chain's life: its windows sort a table that time bounds.
    """
    low_row, high_row = (F.struct(F.col(c).alias("block"), "block_timestamp") for c in ("low", "high"))
    totals = dated.groupBy("bucket").agg(F.min(low_row).alias("low"), F.max(high_row).alias("high"))
    every = dated.sparkSession.range(low // bucket, high // bucket + 1).select(F.col("id").alias("bucket")).join(totals, "bucket", "left")
    # Frames that grow from one end cost one step a row; a shrinking frame would be summed up anew for each.
    every_one = Window.partitionBy(F.lit(0))
    before = lambda order: every_one.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    later = F.last("low", ignorenulls=True).over(before(F.col("bucket").desc()))
    earlier = F.last("high", ignorenulls=True).over(before(F.col("bucket")))
    return every.select("bucket", later.alias("first"), earlier.alias("last"))


def resolve_time_ranges(requests: DataFrame, blocks: DataFrame, head: int, bucket: int = HOUR) -> DataFrame:
    """(range_id, first_block, last_block, first_timestamp, last_timestamp, code) for each request.

    requests has range_id, start and end. The first block is the first not before the start, the
    last the last not after the end; times never fall from block to block. A start before block 0 is
    RANGE_PRE_GENESIS, an end after the finalized head's time RANGE_UNFINALIZED, no block between
    them RANGE_EMPTY; nothing is clipped. Requests with a code are set aside first. For the others
    only the two edges are looked up, each among the seconds of its own hour (bucket, in seconds):
    the work depends neither on how long a range is nor on how many blocks an hour has.
    """
    final = blocks.where(F.col("block_number") <= head).select("block_number", "timestamp")
    limits = final.agg(F.min_by("timestamp", "block_number").alias("genesis"), F.max_by("timestamp", "block_number").alias("latest")).first()
    code = (
        F.when(F.col("start").isNull() | F.col("end").isNull() | (F.col("start") > F.col("end")), "RANGE_INVALID")
        .when(F.col("start") < F.lit(limits["genesis"]), "RANGE_PRE_GENESIS")
        .when(F.col("end") > F.lit(limits["latest"]), "RANGE_UNFINALIZED")
    )
    wanted = requests.select("range_id", "start", "end", code.alias("code"))
    names = ("first_block", "last_block", "first_timestamp", "last_timestamp")
    if limits["genesis"] is None:  # no blocks
        empty = F.coalesce("code", F.lit("RANGE_EMPTY")).alias("code")
        return wanted.select("range_id", *(F.lit(None).cast("bigint").alias(c) for c in names), empty)
    # The lowest and the highest block of each second: a table that time bounds.
    seconds = final.groupBy(F.col("timestamp").alias("block_timestamp")).agg(F.min("block_number").alias("low"), F.max("block_number").alias("high"))
    dated = seconds.where("block_timestamp is not null").select(F.floor(F.col("block_timestamp") / bucket).cast("bigint").alias("bucket"), "low", "high", "block_timestamp")
    calendar = _calendar(dated, bucket, limits["genesis"], limits["latest"])
    wanted = stored(wanted)  # read four times; the bounds are parsed once
    good = wanted.where("code is null")
    first = _edge(good.select(F.col("start").alias("at")), dated, calendar, bucket, "first").withColumnRenamed("at", "start")
    last = _edge(good.select(F.col("end").alias("at")), dated, calendar, bucket, "last").withColumnRenamed("at", "end")
    joined = good.join(first, "start", "left").join(last, "end", "left")
    empty = F.coalesce(F.col("first_block") > F.col("last_block"), F.lit(True))
    coded = joined.withColumn("code", F.when(empty, "RANGE_EMPTY"))
    met = coded.select("range_id", *(F.when(F.col("code").isNull(), F.col(c)).alias(c) for c in names), "code")
    # The others join nothing: many share a bound, or have none.
    return met.unionByName(wanted.where("code is not null").select("range_id", *(F.lit(None).cast("bigint").alias(c) for c in names), "code"))


def resolve_block_ranges(requests: DataFrame, blocks: DataFrame, head: int) -> DataFrame:
    """(range_id, first_block, last_block, first_timestamp, last_timestamp, code) for block requests.

    requests has range_id, from_block and to_block. Past the finalized head is RANGE_UNFINALIZED; a
    bound that is no block is RANGE_EMPTY.
    """
    at = blocks.select(F.col("block_number"), F.col("timestamp"))
    first = at.select(F.col("block_number").alias("from_block"), F.col("timestamp").alias("first_timestamp"))
    last = at.select(F.col("block_number").alias("to_block"), F.col("timestamp").alias("last_timestamp"))
    joined = requests.select("range_id", "from_block", "to_block").join(first, "from_block", "left").join(last, "to_block", "left")
    low, high = F.col("from_block"), F.col("to_block")
    bad = low.isNull() | high.isNull() | (low < 0) | (low > high)
    code = F.when(bad, "RANGE_INVALID").when(high > head, "RANGE_UNFINALIZED").when(F.col("first_timestamp").isNull() | F.col("last_timestamp").isNull(), "RANGE_EMPTY")
    good = joined.withColumn("code", code)
    kept = {"first_block": "from_block", "last_block": "to_block", "first_timestamp": "first_timestamp", "last_timestamp": "last_timestamp"}
    return good.select("range_id", *(F.when(F.col("code").isNull(), F.col(c)).alias(n) for n, c in kept.items()), "code")


def verify_edges(resolved: DataFrame, requests: DataFrame, primary: DataFrame, verifier: DataFrame, head: int) -> DataFrame:
    """(range_id, proved): whether the verifier proves the edges of each resolved time range.

    Both copies must agree on the first and the last block; those lie within the request; the block
    before the first is earlier than the start, and the one after the last, if final, is later than
    the end.
    """
    core = ("block_hash", "parent_hash", "timestamp")
    edges = resolved.where("code is null").join(requests.select("range_id", "start", "end"), "range_id")
    first, last = (F.col(f"{side}_block") for side in ("first", "last"))
    # What each point's time is compared with; a first or last block outside the request is compared with none.
    inside = {"first": F.when(F.col("first_timestamp") >= F.col("start"), F.col("first_timestamp")), "last": F.when(F.col("last_timestamp") <= F.col("end"), F.col("last_timestamp"))}
    points = (("before", first - 1, F.col("start")), ("first", first, inside["first"]), ("last", last, inside["last"]), ("after", last + 1, F.col("end")))
    points = F.array(*(F.struct(F.lit(role).alias("role"), at.alias("block_number"), limit.alias("limit")) for role, at, limit in points))
    wanted = edges.select("range_id", F.explode(points).alias("p")).select("range_id", "p.*")
    # The copies meet by 32 bytes for a block, not by its two hashes in text.
    theirs = verifier.select("block_number", F.col("timestamp").alias("time"), _digest(core).alias("theirs"))
    ours = primary.select("block_number", _digest(core).alias("ours"))
    met = wanted.join(theirs, "block_number", "left").join(ours, "block_number", "left")
    time, role, limit = F.col("time"), F.col("role"), F.col("limit")
    ok = (
        F.when(role == "before", (F.col("block_number") < 0) | (time < limit))
        .when(role == "after", (F.col("block_number") > head) | (time > limit))
        .otherwise((F.col("ours") == F.col("theirs")) & (time == limit))
    )
    return met.groupBy("range_id").agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("proved"))


def _digest(names: tuple[str, ...]) -> Column:
    """The SHA-256 of some columns' texts, each with its length before it; a null has none."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(n).cast("string")).cast("string"), F.lit(":"), F.col(n).cast("string")), F.lit("-")) for n in names]
    return F.unhex(F.sha2(F.concat(*parts), 256))
