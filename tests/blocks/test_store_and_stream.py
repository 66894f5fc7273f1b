import json
import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_decode_features_checks import H, chain, reply

from quarrylane.plans.catalog import DatasetError, Selection, with_proofs
from quarrylane.sources import store
from quarrylane.streaming import stream

NAMES = ["timestamp", "block_hash", "parent_hash", "base_fee_per_gas", "gas_used", "gas_limit", "tx_count"]
ANCHOR = {"block_number": 500, "block_hash": H(501), "tag": "finalized"}
CHAIN, SOURCE = {"name": "test", "chain_id": 7}, {"kind": "tables", "place": "here"}


def published(df, root, names=NAMES, **more):
    return store.publish(df, str(root), names, ANCHOR, df, CHAIN, SOURCE, **more)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_publish_and_open(spark, tmp_path, fmt):
    path = published(chain(spark, 300), tmp_path, fmt=fmt)
    opened = store.open_dataset(spark, path)
    assert opened.manifest["row_count"] == 300 and opened.df.columns == ["block_number", *NAMES]
    assert [r.block_number for r in opened.df.orderBy("block_number").collect()] == list(range(300))
    with pytest.raises(DatasetError) as e:
        published(chain(spark, 300), tmp_path, fmt=fmt, dataset_id=opened.manifest["dataset_id"])
    assert e.value.code == "OUTPUT_EXISTS"


def test_manifest_facts(spark, tmp_path):
    requested = {"kind": "time", "from": "1960-01-01", "to": "2100-01-01", "normalized_from_utc": "1960-01-01T00:00:00Z", "normalized_to_utc": "2100-01-01T23:59:59Z"}
    m = store.open_dataset(spark, published(chain(spark, 50), tmp_path, requested=requested)).manifest
    assert m["chain"] == CHAIN and m["source"] == SOURCE and m["requested_range"] == requested
    assert m["completed_at"] > "2026" and len(m["verification"]["sampled_blocks"]) == 5 and m["verification"]["sampled_blocks"][0] == 0


def test_publishing_compares_with_the_verifier(spark, tmp_path):
    df = chain(spark, 10)
    other = df.withColumn("gas_used", F.col("gas_used") + F.when(F.col("block_number") == 9, 1).otherwise(0))
    with pytest.raises(DatasetError) as e:
        store.publish(df, str(tmp_path), NAMES, ANCHOR, other, CHAIN, SOURCE)
    assert e.value.code == "VERIFICATION_FAILED"


def test_partial_selections_are_validated(spark, tmp_path):
    """Without hash, parent and time the rows are still counted, ranged and held to their domains."""
    df = chain(spark, 9)
    good = published(df, tmp_path, ["tx_count"])
    assert store.open_dataset(spark, good).df.count() == 9
    spoilt = [df.withColumn("tx_count", F.lit(-5).cast("bigint")), df.withColumn("block_number", F.col("block_number") * 3), df.where("block_number > 0"), df.withColumn("tx_count", F.lit(None).cast("bigint"))]
    codes = []
    for k, rows in enumerate(spoilt):
        path = published(df, tmp_path / str(k), ["tx_count"])
        spark.createDataFrame(rows.select("block_number", "tx_count").collect(), "block_number bigint, tx_count bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
        files = [r.asDict() for r in store.file_digests(spark, f"{path}/data").orderBy("name").collect()]
        rewrite(path, lambda m: m["output"].update(files=files))
        with pytest.raises(DatasetError) as e:
            store.open_dataset(spark, path)
        codes.append(e.value.code)
    assert codes == ["DATASET_DOMAIN", "DATASET_RANGE", "DATASET_RANGE", "DATASET_NULLS"]


def test_csv_tokens_are_checked_on_opening(spark, tmp_path):
    path = published(chain(spark, 5), tmp_path, ["tx_count"], fmt="csv")
    for f in os.listdir(f"{path}/data"):
        os.remove(f"{path}/data/{f}")
    open(f"{path}/data/part-0.csv", "w").write("block_number,tx_count\n" + "".join(f"{n},0{n}\n" for n in range(5)))
    files = [r.asDict() for r in store.file_digests(spark, f"{path}/data").collect()]
    rewrite(path, lambda m: m["output"].update(files=files))
    with pytest.raises(DatasetError) as e:
        store.open_dataset(spark, path)
    assert e.value.code == "DATASET_TOKENS"


@pytest.mark.parametrize("full", [False, True])
def test_verify(spark, tmp_path, full):
    ds = store.open_dataset(spark, store.publish(chain(spark, 300), str(tmp_path), NAMES, {**ANCHOR, "block_number": 400, "block_hash": H(401)}, chain(spark, 600), CHAIN, SOURCE))
    found = store.verify(ds, chain(spark, 600), 550, full)
    assert found["compared_blocks"] == (300 if full else 5) and found["finalized_anchor"]["block_number"] == 550
    changed = lambda c, at: chain(spark, 600).withColumn(c, F.when(F.col("block_number") == at, F.lit(H(9999))).otherwise(F.col(c)))
    for other, head, code in ((changed("parent_hash", 500), 550, "VERIFICATION_ANCHOR"), (changed("block_hash", 400), 550, "VERIFICATION_ANCHOR"), (changed("block_hash", 299), 550, "VERIFICATION_FAILED"), (chain(spark, 600), 350, "VERIFICATION_ANCHOR")):
        with pytest.raises(DatasetError) as e:
            store.verify(ds, other, head, full)
        assert e.value.code == code


def rewrite(path, change):
    name = f"{path}/manifest.json"
    value = json.loads(open(name).read())
    change(value)
    open(name, "w").write(store.canonical_json(value))
    crc = f"{path}/.manifest.json.crc"
    if os.path.exists(crc):
        os.remove(crc)


CORRUPT = {
    "unit": lambda m: m["schema"][1].update(unit="year"),
    "to_block": lambda m: m["resolved_range"].update(to_block=m["resolved_range"]["to_block"] + 1),
    "extra_key": lambda m: m.update(more=1),
    "target": lambda m: m.update(target_hash=H(7)),
    "anchor": lambda m: m["finalized_anchor"].update(block_number=3),
    "samples": lambda m: m["verification"].update(sampled_blocks=[5]),
    "uuid": lambda m: m.update(dataset_id="x"),
}


@pytest.mark.parametrize("what", [*CORRUPT, "json", "bytes", "extra_file", "manifest_missing"])
def test_corruption_is_found(spark, tmp_path, what):
    path = published(chain(spark, 40), tmp_path)
    part = next(f for f in os.listdir(f"{path}/data") if f.startswith("part-"))
    if what in CORRUPT:
        rewrite(path, CORRUPT[what])
    elif what == "json":
        rewrite(path, lambda m: None)
        open(f"{path}/manifest.json", "a").write("}")
    elif what == "bytes":
        open(f"{path}/data/{part}", "ab").write(b"x")
        os.remove(f"{path}/data/.{part}.crc")
    elif what == "extra_file":
        open(f"{path}/data/more.parquet", "wb").write(b"x")
    else:
        os.remove(f"{path}/manifest.json")
    with pytest.raises(DatasetError):
        store.open_dataset(spark, path)


def test_audit(spark, tmp_path):
    good = published(chain(spark, 20), tmp_path)
    bad = published(chain(spark, 20), tmp_path)
    rewrite(bad, lambda m: (m.update(row_count=3), m["resolved_range"].update(from_timestamp=-1)))
    found = {r.dataset_id: r.faults for r in store.audit_manifests(spark, str(tmp_path)).collect()}
    assert found[os.path.basename(good)] == "" and set(found[os.path.basename(bad)].split(",")) == {"resolved_range", "row_count"}


def test_csv_tokens_and_order(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "part-0.csv").write_text("block_number,timestamp,tx_count\n1,5,0\n02,5,0\n3,+5,0\n4,5\n5,5,0,9\n6,,0\n")
    found = [r.reason for r in store.csv_violations(spark, str(tmp_path / "c"), Selection.of(["timestamp", "tx_count"])).collect()]
    assert sorted(found) == ["block_number", "columns", "columns", "timestamp", "timestamp"]
    assert store.csv_header_ok(spark, str(tmp_path / "c"), Selection.of(["timestamp", "tx_count"]))
    assert not store.csv_header_ok(spark, str(tmp_path / "c"), Selection.of(["timestamp", "block_hash"]))
    store.write_dataset(chain(spark, 500), str(tmp_path / "o"))
    assert store.order_violations(spark, str(tmp_path / "o")).count() == 0
    chain(spark, 500).coalesce(1).orderBy(F.col("block_number").desc()).write.parquet(str(tmp_path / "p"))
    assert {r.reason for r in store.order_violations(spark, str(tmp_path / "p")).collect()} >= {"inside"}


def test_staging_and_resume(spark, tmp_path):
    df = with_proofs(chain(spark, 100), NAMES)
    n = F.col("block_number")
    store.stage_chunks(df.where((n < 40) | (n >= 60)), str(tmp_path / "s"), 0, 20)
    staged = store.staged_rows(spark, str(tmp_path / "s"))
    missing = store.missing_chunks(staged, 0, 99, 20)
    assert [tuple(r) for r in missing.collect()] == [(2, 40, 59)] and store.usable_prefix(missing, 5) == 2
    store.stage_chunks(df.where(n.between(40, 59)), str(tmp_path / "s"), 0, 20)
    staged = store.staged_rows(spark, str(tmp_path / "s"))
    assert store.missing_chunks(staged, 0, 99, 20).count() == 0
    assert [r.block_number for r in store.assemble(staged, Selection.of(NAMES)).collect()] == list(range(100))
    assert store.run_receipt(staged, 0, 99, 2, 20).first().reused_rows == 40
    store.stage_chunks(df.where(n.between(20, 59)), str(tmp_path / "s"), 0, 20)  # again: nothing is there twice
    staged = store.staged_rows(spark, str(tmp_path / "s"))
    assert staged.count() == 100 and store.missing_chunks(staged, 0, 99, 20).count() == 0
    forked = df.where(n.between(40, 59)).withColumn("_proof_parent_hash", F.when(n == 40, F.lit(H(7777))).otherwise(F.col("_proof_parent_hash")))
    for wrong in (forked, df.where(n.between(40, 59)).withColumn("_proof_hash", F.when(n == 59, F.lit(H(7777))).otherwise(F.col("_proof_hash")))):
        with pytest.raises(DatasetError) as e:
            store.stage_chunks(wrong, str(tmp_path / "s"), 0, 20)
        assert e.value.code == "CHUNK_LINK"


def test_staging_costs_the_new_chunks_alone(spark, tmp_path):
    """What is staged already may be gone: only the log's neighbours are read. Many chunks share a file."""
    df, where = with_proofs(chain(spark, 400), NAMES), str(tmp_path / "s")
    n = F.col("block_number")
    store.stage_chunks(df.where(n < 200), where, 0, 20)
    assert len([f for _, _, fs in os.walk(f"{where}/data") for f in fs if f.endswith(".parquet")]) == 1
    shutil.rmtree(f"{where}/data")
    store.stage_chunks(df.where(n >= 200), where, 0, 20)
    states = store.chunk_states(spark, where, 0, 399, 20)
    assert {r.state: r["count"] for r in states.groupBy("state").count().collect()} == {"changed": 10, "complete": 10}
    assert states.where("usable = 1").count() == 0
    with pytest.raises(DatasetError) as e:
        store.stage_chunks(df.drop("_proof_hash"), where, 0, 20)
    assert e.value.code == "CHUNK_PROOFS"


def test_changed_bytes_and_broken_links_are_found_on_resume(spark, tmp_path):
    df, where = with_proofs(chain(spark, 100), NAMES), str(tmp_path / "s")
    n = F.col("block_number")
    wrong = df.withColumn("_proof_parent_hash", F.when(n.isin(50, 80), F.lit(H(7777))).otherwise(F.col("_proof_parent_hash")))
    store.stage_chunks(wrong.where("block_number <> 33"), where, 0, 10, per_file=2)
    states = lambda: [(r.state, r.usable) for r in store.chunk_states(spark, where, 0, 119, 10).orderBy("chunk_id").collect()]
    assert [s for s, _ in states()] == ["complete"] * 3 + ["incomplete", "complete", "broken", "complete", "complete", "broken", "complete", "absent", "absent"]
    store.stage_chunks(df, where, 0, 10, per_file=2)
    assert states() == [("complete", 1)] * 10 + [("absent", 0)] * 2
    batch, file = store.chunk_log(spark, where, 4, 4).select("batch", "file").first()
    name = f"{where}/data/batch={batch}/{file}"
    data = bytearray(open(name, "rb").read())
    data[len(data) // 2] ^= 1
    open(name, "wb").write(data)
    os.remove(f"{os.path.dirname(name)}/.{os.path.basename(name)}.crc")
    assert states() == [("complete", 1)] * 4 + [("changed", 0)] * 2 + [("complete", 0)] * 4 + [("absent", 0)] * 2
    assert store.staged_rows(spark, where).where("block_number < 40").count() == 40


def test_publishing_evaluates_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = chain(spark, 500)
    store.publish(df.mapInArrow(count, df.schema), str(tmp_path), NAMES, ANCHOR, df, CHAIN, SOURCE)
    assert seen.value == 500


def test_results_that_do_not_cover_what_was_asked_are_refused(spark, tmp_path):
    """Before anything is published, by what the write itself has seen."""
    n, asked = F.col("block_number"), {"kind": "block", "from": 0, "to": 49}
    wrong = {
        "DATASET_RANGE": chain(spark, 50).where(n != 17), "DATASET_NULLS": chain(spark, 50).withColumn("gas_limit", F.when(n != 3, F.col("gas_limit"))), "DATASET_DOMAIN": chain(spark, 50).withColumn("base_fee_per_gas", F.lit(0).cast("bigint")),
        "DATASET_LINKS": chain(spark, 50).withColumn("parent_hash", F.when(n == 9, F.lit(H(1))).otherwise(F.col("parent_hash"))),
    }
    for code, df in {**wrong, "DATASET_RANGE ": chain(spark, 49), " DATASET_RANGE": chain(spark, 50).limit(0)}.items():
        with pytest.raises(DatasetError) as e:
            published(df, tmp_path, ["gas_used", "base_fee_per_gas"], requested=asked)
        assert e.value.code == code.strip()
    assert os.listdir(tmp_path) == []


def test_canonical_text_equals_sorted_json(spark):
    values = [{"b": [1, {"z": None, "a": "x\ny\"\\é🙂/"}], "a": {"d": -5, "c": True}, "": 9007199254740993}, [], {}, {"k": ""}]
    rows = spark.createDataFrame([(json.dumps(v, indent=1, ensure_ascii=k % 2 == 0),) for k, v in enumerate(values)] + [("{",), (None,)], "v string")
    assert [r[0] for r in rows.select(store.canonical_text(F.col("v"))).collect()] == [store.canonical_json(v) for v in values] + [None, None]


AUDITED = {
    "acquisition_plan": lambda m: m["acquisition_plan"].update(features=["gas_limit"], hidden=[]),
    "acquisition_plan ": lambda m: m["acquisition_plan"].update(more=[]),
    "source": lambda m: m.update(source={}),
    "chain,verification": lambda m: m["chain"].update(chain_id=0),
    "verification": lambda m: m["verification"].update(target_agreement=False),
    "verification ": lambda m: m["verification"].update(verifier_chain_id=8),
    "samples": lambda m: m["verification"].update(sampled_blocks=[0, 19]),
    "schema": lambda m: m["schema"][1].update(type="UTF-8"),
    "requested_range": lambda m: m["requested_range"].update(more=1),
    " acquisition_plan": lambda m: m["schema"].pop(),
    "schema ": lambda m: m["schema"].reverse(),
}


def test_rules_that_follow_from_the_selection(spark, tmp_path):
    """A plan over another selection, sources, verification: all in one scan of the manifests."""
    names = {}
    for what, change in AUDITED.items():
        path = published(chain(spark, 20), tmp_path, ["gas_used", "tx_count"])
        rewrite(path, change)
        names[os.path.basename(path)] = what.strip()
    loose = published(chain(spark, 20), tmp_path, ["gas_used"])
    open(f"{loose}/manifest.json", "a").write(" ")
    os.remove(f"{loose}/.manifest.json.crc")
    found = {r.dataset_id: r.faults for r in store.audit_manifests(spark, str(tmp_path)).collect()}
    assert found == names | {os.path.basename(loose): "canonical"}


def test_staging_belongs_to_one_request(spark, tmp_path):
    where = str(tmp_path / "s")
    store.bind_staging(spark, where, {"from": 0, "to": 99, "features": NAMES})
    store.bind_staging(spark, where, {"from": 0, "to": 99, "features": NAMES})
    with pytest.raises(DatasetError) as e:
        store.bind_staging(spark, where, {"from": 0, "to": 98, "features": NAMES})
    assert e.value.code == "RESUME_MISMATCH"


def test_stream_stores_each_block_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    raw = spark.createDataFrame([(n, reply(n)) for n in range(200)] + [(500, "bad")], stream.LANDED)
    raw.repartition(4).write.json(src)
    stream.stream_headers(spark, src, out, check)
    raw.where("requested < 150").coalesce(1).write.mode("append").json(src)
    spark.createDataFrame([(n, reply(n)) for n in range(190, 230)], stream.LANDED).coalesce(1).write.mode("append").json(src)
    stream.stream_headers(spark, src, out, check)
    stream.stream_headers(spark, src, out, check)
    found = [r.block_number for r in spark.read.parquet(out).collect()]
    assert sorted(found) == list(range(230))
    stream.stream_headers(spark, src, out, str(tmp_path / "fresh"))  # as after a lost checkpoint
    assert spark.read.parquet(out).count() == 230
    assert stream.finalized_view(spark.read.parquet(out), 100).count() == 101


def test_stream_features_keeps_incomplete_blocks(spark, tmp_path):
    """Receipts in three deliveries, one of them repeated; blocks without gas appear with later batches too."""
    src, out, check, table = (str(tmp_path / x) for x in ("src", "out", "check", "blocks"))
    gas = lambda n: 0 if n % 4 == 3 else 10
    blocks = lambda low, high: spark.createDataFrame([(n, H(n + 1), H(n), n, 1, gas(n), 100) for n in range(low, high)], "block_number bigint, block_hash string, parent_hash string, timestamp bigint, base_fee_per_gas bigint, gas_used bigint, gas_limit bigint")
    receipt = lambda n, i: (H(n + 1), i, 5, 7 + i)
    land = lambda rows: spark.createDataFrame(rows, stream.RECEIPTS).coalesce(1).write.mode("append").parquet(src)
    run = lambda: stream.stream_features(spark, src, table, out, check, NAMES[3:])
    stored = lambda: sorted(r.block_number for r in spark.read.parquet(out).collect())
    blocks(0, 8).write.parquet(table)
    land([receipt(n, 0) for n in (0, 1, 2, 4)] + [receipt(0, 1), receipt(900, 0)])
    run()
    assert stored() == [0, 3, 7]
    blocks(8, 12).write.mode("append").parquet(table)
    land([receipt(1, 1), receipt(1, 1), receipt(0, 0), receipt(8, 0), receipt(8, 1)])
    run()
    assert stored() == [0, 1, 3, 7, 8, 11]
    land([receipt(2, 1), receipt(4, 1)])
    run()
    assert stored() == [0, 1, 2, 3, 4, 7, 8, 11]
    pending = max(os.listdir(f"{check}/pending"), key=int)
    assert [r.block_hash for r in spark.read.parquet(f"{check}/pending/{pending}").collect()] == [H(901)]


def test_chunks_with_logged_breaks_are_staged_again(spark, tmp_path):
    """Block 40 names a wrong parent: chunk 2 is staged again as it was, but not with another wrong edge."""
    n, path = F.col("block_number"), str(tmp_path / "s")
    df = with_proofs(chain(spark, 100), NAMES)
    wrong = lambda h: df.withColumn("_proof_parent_hash", F.when(n == 40, F.lit(h)).otherwise(F.col("_proof_parent_hash")))
    store.stage_chunks(wrong(H(7777)), path, 0, 20)
    for again in ("block_number between 40 and 59", "block_number between 20 and 39"):
        store.stage_chunks(wrong(H(7777)).where(again), path, 0, 20)
    staged = store.staged_rows(spark, path)
    assert staged.count() == 100 and store.missing_chunks(staged, 0, 99, 20).count() == 0
    assert [r.chunk_id for r in store.chunk_states(spark, path, 0, 99, 20).where("state = 'broken'").collect()] == [2]
    with pytest.raises(DatasetError) as e:
        store.stage_chunks(wrong(H(8888)).where(n.between(40, 59)), path, 0, 20)
    assert e.value.code == "CHUNK_LINK"
