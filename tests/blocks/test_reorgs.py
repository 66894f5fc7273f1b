"""Forks, reorganisations and what streams make of them."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_decode_features_checks import H, chain, reply

from quarrylane.operators import agree, canonical
from quarrylane.operators.canonical import canonical_chain
from quarrylane.plans.catalog import DatasetError
from quarrylane.streaming import stream

HEADER = "block_number bigint, block_hash string, parent_hash string, timestamp bigint"


def walked(rows, anchor, anchor_hash):
    """The line from the anchor down, by following parents one by one."""
    by_key = {(n, h): p for n, h, p, _ in rows}
    line, n, h = set(), anchor, anchor_hash
    while (n, h) in by_key:
        line.add((n, h))
        n, h = n - 1, by_key[n, h]
    return line


def random_tree(rng, count):
    """Headers that grow on random earlier ones, mostly on the longest branch."""
    rows, tips = [(0, "g", "none", 0)], [(0, "g")]
    for k in range(count):
        n, h = max(tips) if rng.random() < 0.8 else rng.choice(tips[-12:])
        tips.append((n + 1, f"h{k}"))
        rows.append((n + 1, f"h{k}", h, n + 1))
    return rows


@pytest.mark.parametrize("seed", [1])
def test_line_equals_a_walk(spark, seed):
    rng = random.Random(seed)
    rows = random_tree(rng, 120)
    lost = [r for r in rows if rng.random() > 0.02]
    for part, at in ((rows, max(rows)), (rows, rng.choice(rows)), (lost, max(lost))):
        found = canonical_chain(spark.createDataFrame(part, HEADER), at[0], at[1]).collect()
        assert sorted((r.block_number, r.block_hash) for r in found) == sorted(walked(part, at[0], at[1]))


def test_long_stretches_and_absent_anchors(spark):
    rows = chain(spark, 3000).select("block_number", "block_hash", "parent_hash", "timestamp", F.lit("x").alias("node"), F.lit(1).alias("hash"))
    fork = rows.where("block_number between 2000 and 2004").withColumns({"parent_hash": F.when(F.col("block_number") == 2000, F.col("parent_hash")).otherwise(F.concat(F.lit("f"), F.col("parent_hash"))), "block_hash": F.concat(F.lit("f"), F.col("block_hash"))})
    line = canonical_chain(rows.unionByName(fork), 2900, H(2901))
    assert line.columns == rows.columns and line.count() == 2901 and line.where(F.col("block_hash").startswith("f")).isEmpty()
    assert canonical_chain(rows.unionByName(fork), 2004, "f" + H(2005)).where(F.col("block_hash").startswith("f")).count() == 5
    assert canonical_chain(rows, 2900, H(1)).count() == 0 and canonical_chain(rows.limit(0), 5, H(6)).count() == 0


def test_ancestry_and_anchors_among_forks(spark):
    a = chain(spark, 40)
    fork = a.where("block_number between 20 and 22").withColumns({"parent_hash": F.when(F.col("block_number") == 20, F.col("parent_hash")).otherwise(F.concat(F.lit("f"), F.col("parent_hash"))), "block_hash": F.concat(F.lit("f"), F.col("block_hash"))})
    both = a.unionByName(fork)
    assert agree.ancestry_breaks(both, 5, H(6), 30, H(31)).count() == 0
    assert {r.reason for r in agree.ancestry_breaks(both.where("block_number <> 25"), 5, H(6), 30, H(31)).collect()} == {"gap", "coverage"}
    assert agree.refresh_anchor(both, 5, H(6), 20, H(21), 30).first().refreshed == 1
    assert agree.refresh_anchor(both, 5, H(6), 10, H(11), 22).first().refreshed == 0  # two headers there
    assert agree.refresh_anchor(both, 5, H(6), 10, H(11), 22, H(23)).first().refreshed == 1
    assert agree.refresh_anchor(both, 5, H(6), 20, "f" + H(21), 30).first().refreshed == 0


def test_a_replaced_block_is_not_readable(spark, tmp_path):
    """Block 5 is replaced before it is final, and 6 builds on the new one."""
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    land = lambda rows: spark.createDataFrame(rows, stream.LANDED).coalesce(1).write.mode("append").json(src)
    land([(n, reply(n)) for n in range(5)] + [(5, reply(5, hash=H(905)))])
    stream.stream_headers(spark, src, out, check)
    land([(5, reply(5)), (5, reply(5)), (6, reply(6)), (5, reply(5, hash=H(905)))])
    stream.stream_headers(spark, src, out, check)
    bronze = spark.read.parquet(out)
    assert bronze.count() == 8
    view = {r.block_number: (r.block_hash, r.parent_hash) for r in stream.finalized_view(bronze, 6, H(7), 0).collect()}
    assert view[5] == (H(6), H(5)) and view[6][1] == view[5][0] and len(view) == 7
    with pytest.raises(DatasetError) as e:
        stream.finalized_view(bronze, 5)
    assert e.value.code == "CHAIN_HEAD"
    with pytest.raises(DatasetError) as e:
        stream.finalized_view(bronze.where("block_number <> 2"), 6, H(7), 0)
    assert e.value.code == "CHAIN_BROKEN"


BLOCKS = "block_number bigint, block_hash string, parent_hash string, timestamp bigint, base_fee_per_gas bigint, gas_used bigint, gas_limit bigint"


def test_features_of_the_final_line(spark, tmp_path):
    """Losing branches leave neither features nor state behind; a block without gas that lands late appears without new receipts."""
    src, out, check, table = (str(tmp_path / x) for x in ("src", "out", "check", "blocks"))
    block = lambda n, h=None, p=None, gas=10: (n, h or H(n + 1), p or H(n), n, 1, gas, 100)
    add = lambda rows: spark.createDataFrame(rows, BLOCKS).coalesce(1).write.mode("append").parquet(table)
    receipt = lambda h, i: (h, i, 5, 7 + i)
    land = lambda rows: spark.createDataFrame(rows, stream.RECEIPTS).coalesce(1).write.mode("append").parquet(src)
    head = [None]
    run = lambda: stream.stream_features(spark, src, table, out, check, ["timestamp", "tx_count"], lambda: head[0], keep=2, lead=3)
    stored = lambda: sorted((r.block_number, r.tx_count) for r in spark.read.parquet(out).collect())
    state = lambda kind: spark.read.parquet(f"{check}/{kind}/{max(os.listdir(f'{check}/{kind}'), key=int)}").collect()
    add([block(n) for n in range(4)] + [block(3, H(903), H(3)), block(4, H(904), H(903))])
    land([receipt(h, i) for h in (H(1), H(2), H(903), H(904), H(777)) for i in (0, 1)] + [receipt(H(4), 0)])
    run()  # nothing is final yet
    assert not os.path.exists(out) and state("mark")[0].mark is None
    head[0] = (1, H(2))
    run()
    assert stored() == [(0, 2), (1, 2)]
    head[0] = (4, H(5))
    add([block(4)])
    land([receipt(H(4), 1), receipt(H(3), 0)])
    run()
    assert stored() == [(0, 2), (1, 2), (3, 2)] and state("mark")[0].mark == 1
    assert {r.block_hash for r in state("pending")} == {H(3), H(777)}
    land([receipt(H(3), 1), receipt(H(5), 0), receipt(H(5), 1)])
    run()
    assert [n for n, _ in stored()] == [0, 1, 2, 3, 4] and state("mark")[0].mark == 4 and not state("pending")  # 777 landed more than 3 blocks ago
    add([block(5, gas=0), block(6, gas=0)])
    head[0] = (6, H(7))
    run()  # no receipts landed
    assert stored()[-2:] == [(5, 0), (6, 0)]


def test_a_batch_reads_no_old_block(spark, tmp_path, monkeypatch):
    src, out, check, table = (str(tmp_path / x) for x in ("src", "out", "check", "blocks"))
    block = lambda n: (n, H(n + 1), H(n), n, 1, 10, 100)
    land = lambda numbers: spark.createDataFrame([(H(n + 1), 0, 10, 9) for n in numbers], stream.RECEIPTS).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([block(n) for n in range(50)], BLOCKS).write.parquet(table)
    land(range(50))
    seen, gaps = [], stream.receipt_gaps
    monkeypatch.setattr(stream, "receipt_gaps", lambda fresh, landed: (seen.append(sorted(r[0] for r in fresh.select("block_number").collect())), gaps(fresh, landed))[1])
    run = lambda: stream.stream_features(spark, src, table, out, check, ["tx_count"], keep=5)
    run()
    for f in os.listdir(table):  # whatever is further back than `keep` is gone, and not missed
        os.remove(f"{table}/{f}")
    spark.createDataFrame([block(n) for n in range(45, 60)], BLOCKS).coalesce(1).write.mode("append").parquet(table)
    land(range(48, 58))
    run()
    assert seen[0] == list(range(50)) and all(min(x, default=50) >= 50 for x in seen[1:])
    assert sorted(r.block_number for r in spark.read.parquet(out).collect()) == list(range(58))


def test_faults_above_contested_heights_hide_no_block(spark):
    """Block 23 names a wrong parent, or is not there: the heights below it, with two headers each, are on the line still."""
    a = chain(spark, 40)
    n = F.col("block_number")
    fork = a.where("block_number between 20 and 22").withColumns({"parent_hash": F.when(n == 20, F.col("parent_hash")).otherwise(F.concat(F.lit("f"), F.col("parent_hash"))), "block_hash": F.concat(F.lit("f"), F.col("block_hash"))})
    wrong = a.withColumn("parent_hash", F.when(n == 23, F.lit(H(7777))).otherwise(F.col("parent_hash")))
    faults = lambda rows, at=30: sorted((r.block_number, r.reason) for r in agree.ancestry_breaks(rows, 5, H(6), at, H(at + 1)).collect())
    assert faults(wrong.unionByName(fork)) == faults(wrong) == [(23, "parent")]
    for gone in ("block_number <> 23", "block_number not in (21, 23)"):
        assert faults(a.where(gone).unionByName(fork.where("block_number <> 21"))) == faults(a.where(gone))
    line = canonical_chain(wrong.unionByName(fork), 30, H(31), uncontested=True)
    assert line.count() == line.select("block_number").distinct().count() == 31


def test_headers_inside_a_stretch_are_not_kept(spark, monkeypatch):
    """Of a chain with one fork, over the edge of two slices, only the ends of stretches and the fork are written on the way."""
    a, n = chain(spark, 9000), F.col("block_number")
    edge = canonical.SLICE - 1
    fork = a.where(n.between(edge, edge + 2)).withColumns({"parent_hash": F.when(n == edge, F.col("parent_hash")).otherwise(F.concat(F.lit("f"), F.col("parent_hash"))), "block_hash": F.concat(F.lit("f"), F.col("block_hash"))})
    rows, keep = [], canonical.stored
    monkeypatch.setattr(canonical, "stored", lambda df: (kept := keep(df), rows.append(kept.count()))[0])
    line = canonical_chain(a.unionByName(fork), 8900, H(8901))
    assert line.count() == 8901 and line.where(F.col("block_hash").startswith("f")).isEmpty()
    assert sum(rows) < 200


def test_losers_and_the_lowest_height_give_the_line(spark):
    """All headers from low to the anchor but the losers are the line that canonical_chain gives, also where headers are missing."""
    rng = random.Random(3)
    rows = random_tree(rng, 80)
    for part in (rows, [r for r in rows if r[0] != 9]):
        n, h, *_ = max(part)
        headers = spark.createDataFrame(part, HEADER)
        low, lost = canonical.off_line(headers, n, h)
        gone = {(r.block_number, unpacked(r.hash)) for r in lost.collect()}
        left = {(a, b) for a, b, *_ in part if low <= a < n and (a, b) not in gone} | {(n, h)}
        assert left == walked(part, n, h) and gone <= {r[:2] for r in part}
    assert canonical.off_line(headers, 2, "none") is None


def unpacked(packed):
    """The text of a packed hash that is none of 32 bytes."""
    assert len(packed) > 32 and packed[:33] == b"\xff" * 33
    return packed[33:].decode()


def test_blocks_below_a_missing_header_wait_for_it(spark, tmp_path, monkeypatch):
    """Block 3 lands last: the receipts of 0 to 2 are not taken for those of a losing branch. A batch is judged once, not again when all has been read."""
    src, out, check, table = (str(tmp_path / x) for x in ("src", "out", "check", "blocks"))
    add = lambda rows: spark.createDataFrame(rows, BLOCKS).coalesce(1).write.mode("append").parquet(table)
    block = lambda n, gas=10: (n, H(n + 1), H(n), n, 1, gas, 100)
    judged, gaps = [], stream.receipt_gaps
    monkeypatch.setattr(stream, "receipt_gaps", lambda fresh, landed: (judged.append(1), gaps(fresh, landed))[1])
    run = lambda: stream.stream_features(spark, src, table, out, check, ["tx_count"], lambda: (5, H(6)))
    stored = lambda: sorted((r.block_number, r.tx_count) for r in spark.read.parquet(out).collect())
    add([block(n) for n in (0, 1, 2, 4, 5)])
    spark.createDataFrame([(H(n + 1), i, 5, 9) for n in (0, 1, 2, 4, 5) for i in (0, 1)], stream.RECEIPTS).write.parquet(src)
    run()
    assert stored() == [(4, 2), (5, 2)] and len(judged) == 1
    add([block(3, 0)])
    run()
    assert stored() == [(0, 2), (1, 2), (2, 2), (3, 0), (4, 2), (5, 2)]


def test_a_number_is_stored_once(spark, tmp_path):
    """Headers that land twice, and two of one number though all are taken to be final."""
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    rows = [(n, H(n + 1), H(n), n, 1, 10, 100) for n in range(6)]
    blocks = spark.createDataFrame([*rows, *rows[:3], (4, H(904), H(4), 4, 1, 10, 100)], BLOCKS)
    spark.createDataFrame([(r[1], 0, 10, 9) for r in rows] + [(H(904), 0, 10, 9)], stream.RECEIPTS).write.parquet(src)
    stream.stream_features(spark, src, blocks, out, check, ["block_hash", "tx_count"])
    found = spark.read.parquet(out).collect()
    assert sorted(r.block_number for r in found) == list(range(6)) and {r.block_hash for r in found} <= {r[1] for r in rows} | {H(904)}


def test_sets_of_numbers(spark):
    """Over the edges of bitmaps: what is in the set, and up to where all are."""
    numbers = lambda *x: spark.createDataFrame([(n,) for n in x], "block_number bigint")
    asked = [0, 1, 7, 8, 32766, 32767, 32768, 65535, 65536, 98304]
    some = [1, 8, 32767, 32768, 65536]
    bits = stream._bits(numbers(*some, 8))
    assert sorted(r.block_number for r in stream._among(numbers(*asked), bits, "found").where("found").collect()) == some
    run = stream._bits(spark.range(5, 70_000).withColumnRenamed("id", "block_number").where("block_number <> 40000"))
    assert [stream._unbroken(run, 5, 69_999), stream._unbroken(run, 4, 69_999), stream._unbroken(run.where("_span = 0"), 5, 32_767)] == [39_999, 3, 32_767]
