import json
import random

import pytest
from pyspark.sql import functions as F

from quarrylane.operators import agree, checks, features
from quarrylane.plans import catalog
from quarrylane.plans.catalog import CATALOG, DatasetError
from quarrylane.sources import decode

H = lambda n: f"0x{n:064x}"


def reply(n, **changes):
    made = {"number": hex(n), "hash": H(n + 1), "parentHash": H(n), "timestamp": hex(1_700_000_000 + n), "baseFeePerGas": hex(10**9 + n), "gasUsed": hex(15_000_000 + n), "gasLimit": hex(30_000_000), "transactions": ["0x1", {"hash": "0x2"}][: n % 3]}
    return json.dumps({k: v for k, v in (made | changes).items() if v is not ...})


CASES = [
    ({}, None), ({"number": hex(8)}, "other_block"), ({"number": "0x07"}, "number"), ({"hash": H(3).upper()}, "block_hash"), ({"parentHash": ...}, "parent_hash"), ({"timestamp": "7"}, "timestamp"),
    ({"baseFeePerGas": "0x0"}, "base_fee_per_gas"), ({"gasLimit": "0x0"}, "gas_limit"), ({"gasUsed": hex(30_000_001)}, "gas_used"), ({"transactions": None}, "tx_count"), ({"transactions": "text"}, "tx_count"), ({"transactions": ...}, "tx_count"),
]


@pytest.mark.parametrize("changes,reason", CASES)
def test_decode_headers(spark, changes, reason):
    (r,) = decode.decode_headers(spark.createDataFrame([(7, reply(7, **changes))], "requested bigint, reply string")).collect()
    assert r.reject_reason == reason
    assert (r.tx_count, r.gas_used) == ((1, 15_000_007) if reason is None else (None, None))


def test_decode_headers_of_nothing(spark):
    rows = [(1, "nonsense"), (2, None), (3, "{}"), (4, "[]")]
    assert [r.reject_reason for r in decode.decode_headers(spark.createDataFrame(rows, "requested bigint, reply string")).collect()] == ["number"] * 4


def test_fee_history(spark):
    good = json.dumps({"oldestBlock": "0xa", "reward": [[hex(n * 50), hex(n * 90)] for n in range(10, 15)]})
    rows = [(10, 5, good), (11, 5, good), (10, 4, good), (20, 1, json.dumps({"oldestBlock": "0x14", "reward": [["0x1"]]})), (30, 1, json.dumps({"oldestBlock": "0x1e", "reward": [["0x1", "0x01"]]})), (40, 1, "x")]
    found = decode.decode_fee_history(spark.createDataFrame(rows, "start_block bigint, block_count bigint, reply string"), [50, 90]).collect()
    assert sorted((r.block_number, r.p50) for r in found if r.reject_reason is None) == [(n, n * 50) for n in range(10, 15)]
    assert sorted(r.reject_reason for r in found if r.reject_reason) == ["block_count", "oldest_block", "oldest_block", "percentile_count", "quantity"]


def test_percentiles_equal_plain_python(spark):
    rng = random.Random(6)
    blocks, receipts, want = [], [], {}
    for n in range(40):
        rows = [(rng.randrange(1, 9), rng.randrange(1, 50)) for _ in range(rng.randrange(0, 8))]
        gas = sum(g for _, g in rows)
        blocks.append((n, H(n), H(n - 1) if n else H(10**6), 1000 + n, 100, gas, 10**6, None))
        receipts += [(H(n), i, g, 100 + f) for i, (f, g) in enumerate(rows)] + [(H(n + 500), 0, 5, 200)]
        for p in (50, 90):
            total, answer = 0, 0
            for f, g in sorted(rows, key=lambda x: x[0]):
                total += g
                if total * 100 >= gas * p:
                    answer = f
                    break
            want[n, p] = answer
    b = spark.createDataFrame(blocks, "block_number bigint, block_hash string, parent_hash string, timestamp bigint, base_fee_per_gas bigint, gas_used bigint, gas_limit bigint, x string")
    r = spark.createDataFrame(receipts, "block_hash string, transaction_index bigint, gas_used bigint, effective_gas_price bigint")
    out = features.build_block_features(b, r.select("block_hash"), r, [f.name for f in catalog.CATALOG])
    assert out.columns == ["block_number", *(f.name for f in catalog.CATALOG)]
    for row in out.collect():
        assert row.effective_priority_fee_per_gas_p50 == want[row.block_number, 50] and row.effective_priority_fee_per_gas_p90 == want[row.block_number, 90]
    assert features.receipt_gaps(b, r).count() == 0
    assert features.receipt_gaps(b.withColumn("gas_used", F.col("gas_used") + 1), r).count() == 40


def test_unused_tables_are_not_read(spark):
    b = spark.createDataFrame([(1, H(1), 5)], "block_number bigint, block_hash string, timestamp bigint")
    out = features.build_block_features(b, None, None, ["timestamp", "block_hash"])
    assert out.columns == ["block_number", "timestamp", "block_hash"] and out.count() == 1


def chain(spark, n=3000, **changes):
    rows = [(i, 1000 + i, H(i + 1), H(i), 5, 1, 10, 0) for i in range(n)]
    df = spark.createDataFrame(rows, "block_number bigint, timestamp bigint, block_hash string, parent_hash string, base_fee_per_gas bigint, gas_used bigint, gas_limit bigint, tx_count bigint")
    return df.withColumns(changes) if changes else df


@pytest.mark.parametrize("size", [checks.LINK_SLICE, 1024, 7])
def test_link_violations(spark, size):
    n = F.col("block_number")
    broken = chain(spark).where(n != 1500).withColumn("parent_hash", F.when(n == 1024, F.lit(H(9))).otherwise(F.col("parent_hash"))).withColumn("timestamp", F.when(n == 2048, 5).otherwise(F.col("timestamp")))
    found = {(r.block_number, r.reason) for r in checks.link_violations(broken, size).collect()}
    assert found == {(1024, "parent"), (1501, "gap"), (2048, "time")}
    assert checks.link_violations(chain(spark), size).count() == 0
    plan = checks.link_violations(broken, size)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_only_slices_meet(spark):
    """What goes beyond a slice is one row for each, and the summary reads the table once."""
    rows = checks.slice_summaries(chain(spark), 100)
    assert rows.count() == -(-chain(spark).count() // 100)
    plan = checks.dataset_summary(chain(spark), 0, 2999)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_repeats_and_rows_without_a_number(spark):
    twice = chain(spark, 30).unionByName(chain(spark, 30).where("block_number in (7, 8)"))
    assert {(r.block_number, r.reason) for r in checks.link_violations(twice, 8).collect()} == {(7, "repeat"), (8, "repeat")}
    lost = chain(spark, 30).withColumn("block_number", F.when(F.col("block_number") != 3, F.col("block_number")))
    row = checks.dataset_summary(lost, 0, 29).first()
    assert (row.row_count, row.null_values, row.exact, row.link_faults) == (30, 1, 0, 1)
    assert checks.dataset_summary(lost.limit(0), 0, 29).first().asDict() == {"row_count": 0, "domain_faults": 0, "null_values": 0, "exact": 0, "target_ok": 1, "times_ok": 1, "link_faults": 0}


def test_summary_and_codes(spark):
    n = F.col("block_number")
    good = chain(spark, 50)
    checks.assert_clean(checks.dataset_summary(good, 0, 49, H(50)))
    faults = {
        "DATASET_NULLS": good.withColumn("timestamp", F.when(n != 7, F.col("timestamp"))), "DATASET_DOMAIN": good.withColumn("gas_used", F.when(n == 3, 11).otherwise(1).cast("bigint")),
        "DATASET_RANGE": good.where(n != 49), "DATASET_LINKS": good.withColumn("parent_hash", F.when(n == 5, F.lit(H(1))).otherwise(F.col("parent_hash"))), "DATASET_TARGET": good,
    }
    for code, df in faults.items():
        with pytest.raises(catalog.DatasetError) as e:
            checks.assert_clean(checks.dataset_summary(df, 0, 49, H(50) if code != "DATASET_TARGET" else H(1)))
        assert e.value.code == code


def test_agreement(spark):
    n = F.col("block_number")
    a = chain(spark, 40)
    b = a.where(n != 12).withColumn("base_fee_per_gas", F.when(n == 20, 6).otherwise(F.col("base_fee_per_gas")).cast("bigint"))
    assert {(r.block_number, r.reason) for r in agree.compare_full(a, b, 0, 39).collect()} == {(12, "missing_there"), (20, "base_fee_per_gas"), (13, "verifier_gap")}
    sample = spark.createDataFrame([(12,), (20,), (99,)], "block_number bigint")
    assert {(r.block_number, r.reason) for r in agree.compare_sample(a, b, sample).collect()} == {(12, "missing_there"), (20, "base_fee_per_gas"), (99, "missing_there")}
    assert agree.ancestry_breaks(a, 5, H(6), 30, H(31)).count() == 0
    assert {r.reason for r in agree.ancestry_breaks(b, 5, H(1), 30, H(2)).collect()} == {"gap", "coverage", "anchor", "target"}
    assert agree.refresh_anchor(a, 5, H(6), 20, H(21), 30).first().refreshed == 1
    assert agree.refresh_anchor(a, 5, H(6), 20, H(21), 10).first().refreshed == 0


def test_sample_numbers_equal_plain_python(spark):
    import hashlib
    import uuid

    ids = ["6f1c1c1e-0b0a-4a4a-8a8a-00000000000f", "00000000-0000-4000-8000-000000000000"]
    for i in ids:
        for first, last in ((10, 10), (10, 11), (10, 12), (10, 500)):
            seed = int.from_bytes(hashlib.sha256(uuid.UUID(i).bytes).digest()[:8], "big")
            width = last - first - 1
            want = {first, last} | {first + 1 + (seed + k) % width for k in range(min(3, max(width, 0)))}
            got = agree.sample_numbers(spark.createDataFrame([(i, first, last)], "dataset_id string, first_block bigint, last_block bigint"))
            assert {r.block_number for r in got.collect()} == want


def test_reconcile(spark):
    calls = spark.createDataFrame([(0, i) for i in range(9)], "batch_id bigint, call_id bigint")
    rows = [(0, 0, "2.0", True, "x", None), (0, 1, "2.0", True, None, None), (0, 2, "2.0", False, None, -32005), (0, 3, "2.0", False, None, -32601), (0, 4, "2.0", False, None, -1), (0, 5, "1.0", True, "x", None), (0, 6, "2.0", True, "x", -1), (0, 7, "2.0", True, "x", None), (0, 7, "2.0", True, "x", None), (0, 99, "2.0", True, "x", None)]
    replies = spark.createDataFrame(rows, "batch_id bigint, id bigint, jsonrpc string, has_result boolean, result string, error_code bigint")
    out = decode.reconcile_replies(calls, replies)
    assert {r.id: r.outcome for r in out.collect()} == {0: "accepted", 1: "retry", 2: "limit", 3: "fatal", 4: "retry", 5: "protocol", 6: "protocol", 7: "protocol", 8: "retry", 99: "protocol"}
    assert [r.id for r in decode.retries(out).collect()] == [1, 2, 4, 8]


def test_landed_batches(spark):
    """Values are judged by their JSON types, members and payloads by their shapes."""
    ok = '{"jsonrpc":"2.0","id":%s,"result":{"n":1}}'
    members = [ok % 0, '{"jsonrpc":"2.0","id":1,"result":null}', '{"jsonrpc":"2.0","id":2,"error":{"code":-32005,"message":"m"}}', '{"jsonrpc":"2.0","id":3,"error":{"code":-32601,"message":"m"}}', '{"jsonrpc":"2.0","id":4,"error":{"code":-1,"message":"m"}}', ok % '"5"', '{"jsonrpc":"2.0","id":6,"error":{"code":-1}}', '{"jsonrpc":"2.0","id":7,"error":{"code":"-1","message":"m"}}', '{"jsonrpc":2.0,"id":8,"result":1}', '{"jsonrpc":"2.0","id":9}', '{"jsonrpc":"2.0","id":10,"result":1,"error":null}', ok % 11, ok % 11, ok % 99, ok % "12.5", "13", "null"]
    calls = spark.createDataFrame([(b, i) for b in range(4) for i in range(15)], "batch_id bigint, call_id bigint")
    landed = spark.createDataFrame([(0, f"[{','.join(members)}]"), (1, "{" + ok % 1 + "}"), (2, ok % 1), (3, None)], "batch_id bigint, payload string")
    found = {(r.batch_id, r.id): r.outcome for r in decode.reconcile_batches(calls, landed).collect()}
    want = {0: "accepted", 1: "retry", 2: "limit", 3: "fatal", 4: "retry", 5: "retry", 6: "protocol", 7: "protocol", 8: "protocol", 9: "protocol", 10: "protocol", 11: "protocol", 99: "protocol", 12: "retry", 13: "retry", 14: "retry", None: "protocol"}
    assert {i: o for (b, i), o in found.items() if b == 0} == want
    assert all(o == ("protocol" if i is None else "retry") for (b, i), o in found.items() if b) and sum(i is None for b, i in found if b) == 3
    first = decode.batch_members(landed).where("batch_id = 0 and id = 0").first()
    assert (first.place, first.result, first.odd) == (0, '{"n":1}', False)


def test_warehouse_tables_need_the_selected_columns_only(spark):
    from datetime import datetime

    blocks = spark.createDataFrame([(n, datetime(2026, 1, 1, 0, n), H(n + 1), H(n)) for n in range(9)], "block_number int, block_timestamp timestamp, block_hash string, parent_hash string")
    transactions = spark.createDataFrame([(H(3), datetime(2026, 1, 1, 0, 2))] * 4, "block_hash string, block_timestamp timestamp")
    built = features.features_from_warehouse(blocks, transactions, None, ["tx_count"], 0, 8)
    assert {r.block_number: r.tx_count for r in built.collect()} == {n: 4 * (n == 2) for n in range(9)}
    for names, tables in ((["base_fee_per_gas"], (None, None)), (["tx_count"], (None, None)), ([CATALOG[-1].name], (None, None)), (["gas_limit"], (None, None))):
        with pytest.raises(DatasetError) as e:
            features.features_from_warehouse(blocks, *tables, names, 0, 8)
        assert e.value.code == "SOURCE_SCHEMA"


def test_warehouse_scans_are_pruned_by_time(spark, tmp_path):
    """The time span of the range reaches the scans of all three tables, and their columns are checked first."""
    from datetime import datetime, timedelta

    t = lambda n: datetime(2026, 1, 1) + timedelta(minutes=n)
    tables = {
        "blocks": spark.createDataFrame([(n, t(n), H(n + 1), H(n), 5, 2, 9) for n in range(50)], "block_number int, block_timestamp timestamp, block_hash string, parent_hash string, base_fee_per_gas bigint, gas_used int, gas_limit bigint"),
        "transactions": spark.createDataFrame([(H(n + 1), t(n)) for n in range(50)], "block_hash string, block_timestamp timestamp"),
        "receipts": spark.createDataFrame([(H(n + 1), t(n), 0, 2, 8) for n in range(50)], "block_hash string, block_timestamp timestamp, transaction_index int, gas_used bigint, effective_gas_price bigint"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
    read = [spark.read.parquet(f"{tmp_path}/{name}") for name in tables]
    built = features.features_from_warehouse(*read, [f.name for f in CATALOG], 10, 19)
    rows = built.orderBy("block_number").collect()
    assert [r.block_number for r in rows] == list(range(10, 20)) and {(r.tx_count, r.effective_priority_fee_per_gas_p50, r.timestamp - rows[0].timestamp) for r in rows} == {(1, 3, 60 * k) for k in range(10)}
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        built = features.features_from_warehouse(*read, [f.name for f in CATALOG], 10, 19)
        plan = built._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) >= 3 and all("GreaterThanOrEqual(block_timestamp" in line and "LessThanOrEqual(block_timestamp" in line for line in scans)
    checks.assert_coverage(built, 10, 19)
    for wrong, code in ((built.where("block_number <> 15"), "DATASET_RANGE"), (built.unionByName(built.where("block_number = 15")), "DATASET_RANGE"), (built.withColumn("tx_count", F.lit(-1).cast("bigint")), "DATASET_DOMAIN")):
        with pytest.raises(DatasetError) as e:
            checks.assert_coverage(wrong, 10, 19)
        assert e.value.code == code
    with pytest.raises(DatasetError) as e:
        features.features_from_warehouse(read[0].drop("gas_used"), *read[1:], ["gas_limit"], 0, 1)
    assert e.value.code == "SOURCE_SCHEMA"


def test_a_reply_is_parsed_once(spark):
    """However many columns and checks read it, and whatever is filtered after."""
    good = decode.decode_headers(spark.createDataFrame([(1, reply(1))], "requested bigint, reply string")).where("reject_reason is null")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("conv(") == 10  # a quantity names it twice
    assert good.count() == 1


def test_receipts_move_once(spark):
    """By hash alone, from their join on; so two headers of one number have percentiles of their own receipts."""
    blocks = spark.createDataFrame([(1, 5, h, "p", 1, 10, 100) for h in "ab"], "block_number bigint, timestamp bigint, block_hash string, parent_hash string, base_fee_per_gas bigint, gas_used bigint, gas_limit bigint")
    receipts = spark.createDataFrame([("a", 0, 10, 6), ("b", 0, 10, 9)], "block_hash string, transaction_index bigint, gas_used bigint, effective_gas_price bigint")
    made = features.build_block_features(blocks, None, receipts, ["block_hash", "effective_priority_fee_per_gas_p50"])
    assert "hashpartitioning(block_number" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.block_hash, r.effective_priority_fee_per_gas_p50) for r in made.collect()) == [("a", 5), ("b", 8)]


def test_a_sample_is_looked_up_once_in_each_copy(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "block_number bigint, x bigint")
    asked = spark.createDataFrame([(n,) for n in (1, 2, 2, 3, 4, 5, None)], "block_number bigint")
    found = agree.compare_sample(rows((1, 1), (2, 2), (3, 3), (6, 6)), rows((1, 1), (2, 9), (4, None), (4, None), (6, 7)), asked)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    assert sorted((r.block_number or 0, r.reason) for r in found.collect()) == [(0, "missing_there"), (2, "x"), (3, "missing_there"), (4, "missing_here"), (4, "missing_here"), (5, "missing_there")]
