from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarrylane.functions import columns
from quarrylane.operators import ranges
from quarrylane.plans import catalog


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text,value",
    [("0x0", 0), ("0xff", 255), ("0x7fffffffffffffff", 2**63 - 1), ("0x8000000000000000", None), ("0x10000000000000000", None), ("0x00", None), ("0xFF", None), ("ff", None), ("0x", None), ("0x1\n", None), ("", None), (None, None)],
)
def test_quantity(spark, text, value):
    assert one(spark, text, columns.quantity) == value


@pytest.mark.parametrize("text,value", [("0x" + "ab" * 32, True), ("0x" + "AB" * 32, False), ("0x" + "ab" * 31, False), ("0x" + "ab" * 32 + "\n", False), (None, False)])
def test_hash(spark, text, value):
    assert one(spark, text, columns.is_hash) is value


@pytest.mark.parametrize("text", ["0x" + "ab" * 32, "0x" + "AB" * 32, "x" * 32, "f0x" + "00" * 32, "é\n", "", None])
def test_packed_hashes_are_told_apart_and_unpacked(spark, text):
    packed = one(spark, text, columns.packed_hash)
    assert one(spark, text, lambda c: columns.unpacked_hash(columns.packed_hash(c))) == text
    assert text is None or (len(packed) == 32) == (text == "0x" + "ab" * 32)


def at(text):
    return int(datetime.fromisoformat(text + "+00:00").timestamp())


@pytest.mark.parametrize(
    "text,start,end",
    [
        ("2026-01-02", at("2026-01-02T00:00:00"), at("2026-01-02T23:59:59")),
        ("2026-01-02T03Z", at("2026-01-02T03:00:00"), at("2026-01-02T03:59:59")),
        ("2026-01-02T03:04Z", at("2026-01-02T03:04:00"), at("2026-01-02T03:04:59")),
        ("2026-01-02T03:04:05Z", at("2026-01-02T03:04:05"), at("2026-01-02T03:04:05")),
        ("2026-01-02T03+01:00", at("2026-01-02T02:00:00"), at("2026-01-02T02:59:59")),
        ("2026-01-02T03:04-05:30", at("2026-01-02T08:34:00"), at("2026-01-02T08:34:59")),
        ("2026-01-02T03:04+20:00", at("2026-01-01T07:04:00"), at("2026-01-01T07:04:59")),
        ("1970-01-01", 0, 86399),
    ],
)
def test_time_bounds(spark, text, start, end):
    assert one(spark, text, lambda c: columns.time_bound(c, False)) == start
    assert one(spark, text, lambda c: columns.time_bound(c, True)) == end


@pytest.mark.parametrize("text", ["1969-12-31", "2026-02-30", "2026-01-02T03", "2026-01-02T24Z", "2026-1-2", "2026-01-02T03:04+24:00", "2026-01-02T03:04+01:60", "2026-01-02Z", "soon", "", None, "2026-01-02\n"])
def test_bad_time_bounds(spark, text):
    assert one(spark, text, lambda c: columns.time_bound(c, False)) is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_bounds_do_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, "2026-01-02T03:04Z", lambda c: columns.time_bound(c, False)) == at("2026-01-02T03:04:00")
        assert spark.range(1).select(columns.utc_text(F.lit(0).cast("bigint"))).first()[0] == "1970-01-01T00:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def chain(spark, times):
    return spark.createDataFrame(list(enumerate(times)), "block_number bigint, timestamp bigint")


@pytest.mark.parametrize("bucket", [7, ranges.HOUR, ranges.DAY])
def test_resolve_time_ranges(spark, bucket):
    blocks = chain(spark, [100 + 40_000 * k for k in range(30)])
    asked = spark.createDataFrame([(1, 100, 200_000), (2, 99, 200), (3, 101, 300), (4, 100, 10_000_000), (5, 200, 100), (6, None, 5), (7, 40_100, 40_100), (8, 90_000, 1_000_000)], "range_id bigint, start bigint, end bigint")
    found = {r.range_id: (r.first_block, r.last_block, r.code) for r in ranges.resolve_time_ranges(asked, blocks, 27, bucket).collect()}
    assert found == {
        1: (0, 4, None), 2: (None, None, "RANGE_PRE_GENESIS"), 3: (None, None, "RANGE_EMPTY"), 4: (None, None, "RANGE_UNFINALIZED"), 5: (None, None, "RANGE_INVALID"), 6: (None, None, "RANGE_INVALID"), 7: (1, 1, None), 8: (3, 24, None)
    }


def test_resolving_joins_by_equality_only(spark):
    asked = spark.createDataFrame([(1, 100, 200_000)], "range_id bigint, start bigint, end bigint")
    plan = ranges.resolve_time_ranges(asked, chain(spark, [100, 200]), 1)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ranges.resolve_time_ranges(asked, chain(spark, [100]).limit(0), 5).first().code == "RANGE_EMPTY"


def test_check_requests(spark):
    rows = [(1, 0, 5, None, None), (2, 5, 0, None, None), (3, None, 5, None, None), (4, 0, 5, "2026-01-01", None), (5, None, None, "2026-01-01", "2026-01-02"), (6, None, None, "2026-01-02", "2026-01-01"), (7, None, None, None, None), (8, -1, 5, None, None)]
    found = ranges.check_requests(spark.createDataFrame(rows, "range_id bigint, from_block bigint, to_block bigint, from_time string, to_time string"))
    assert {r.range_id for r in found.collect() if r.code is None} == {1, 5}


def test_catalog_order_and_closure():
    plan = catalog.Selection.of(["gas_used", "timestamp", "effective_priority_fee_per_gas_p90"])
    assert plan.columns == ("block_number", "timestamp", "gas_used", "effective_priority_fee_per_gas_p90")
    assert plan.hidden == ("block_hash", "parent_hash", "base_fee_per_gas", "gas_limit")
    for bad in (["timestamp", "timestamp"], ["block_number"], ["nothing"], []):
        with pytest.raises(catalog.DatasetError):
            catalog.Selection.of(bad)


@pytest.mark.parametrize("bucket", [ranges.HOUR, ranges.DAY])
def test_dense_buckets_take_no_product(spark, bucket):
    """A day with 400,000 blocks and with a request for every other second: compared in pairs, these would be 17 thousand million."""
    import time

    blocks = spark.range(400_000).select(F.col("id").alias("block_number"), F.floor(F.col("id") * 86_399 / 399_999).cast("bigint").alias("timestamp"))
    asked = spark.range(43_000).select(F.col("id").alias("range_id"), (F.col("id") * 2).alias("start"), (F.col("id") * 2 + 60).alias("end"))
    began = time.monotonic()
    found = ranges.resolve_time_ranges(asked, blocks, 399_999, bucket)
    got = found.agg(F.count(F.lit(1)), F.count_if(F.col("code").isNotNull()), F.sum("first_block"), F.sum("last_block")).first()
    assert time.monotonic() - began < 60
    at = [n * 86_399 // 399_999 for n in range(400_000)]
    import bisect

    good = [k for k in range(43_000) if 2 * k + 60 <= at[-1]]
    assert tuple(got) == (43_000, 43_000 - len(good), sum(bisect.bisect_left(at, 2 * k) for k in good), sum(bisect.bisect_right(at, 2 * k + 60) - 1 for k in good))
