"""Registered queries of the block-feature operators, over block-shaped views of the general tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.columns import as_hash, to_quantity
from .operators import agree, canonical, checks, features, ranges
from .oracle import ORACLE_SQL, SAMPLE_IDS
from .plans import catalog
from .sources import bucketed, chunks, decode, store, warehouse
from .sources.fixtures import Fixtures
from .sources.scratch import scratch_dir, stored
from .streaming import stream

NINE = [f.name for f in catalog.CATALOG]
QUERIES: dict = {}


def _query(f):
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Fixtures(spark, sf_dir))
    return f


def _full(fx: Fixtures) -> DataFrame:
    return features.build_block_features(fx.headers(), fx.transactions(), fx.receipts(), NINE)


# Building features


@_query
def tx_counts(fx: Fixtures) -> DataFrame:
    return features.tx_counts(fx.transactions())


@_query
def receipt_join(fx: Fixtures) -> DataFrame:
    return features.receipts_of(fx.headers(), fx.receipts())


@_query
def bucketed_receipt_join(fx: Fixtures) -> DataFrame:
    """The join over tables stored by day and buckets of the hash, for the second half of the time."""
    low, high = fx.events().agg(F.min("timestamp"), F.max("timestamp")).first()
    blocks = fx.headers().withColumn("block_timestamp", F.timestamp_seconds("timestamp"))
    receipts = fx.receipts(timed=True).withColumn("block_timestamp", F.timestamp_seconds("block_timestamp"))
    kept = []
    for rows in (blocks, receipts):
        path = scratch_dir(fx.spark)
        kept.append(bucketed.scan_days(bucketed.save_bucketed(rows, f"t{path.rpartition('-')[2]}", path, 8), low + (high - low) // 2, high))
    return features.receipts_of(*kept)


@_query
def running_gas(fx: Fixtures) -> DataFrame:
    return features.running_gas(features.receipts_of(fx.headers(), fx.receipts())).drop("block_gas_used")


@_query
def priority_fee_percentiles(fx: Fixtures) -> DataFrame:
    return features.priority_fee_percentiles(features.running_gas(features.receipts_of(fx.headers(), fx.receipts())), (50, 90))


@_query
def build_block_features(fx: Fixtures) -> DataFrame:
    return _full(fx)


@_query
def receipt_gaps(fx: Fixtures) -> DataFrame:
    kept = fx.receipts().where(~((F.col("transaction_index") == 0) & (F.col("effective_gas_price") % 97 == 5)))
    return features.receipt_gaps(fx.headers(), kept)


@_query
def select_features(fx: Fixtures) -> DataFrame:
    return catalog.select_features(fx.blocks(), ["gas_used", "timestamp", "base_fee_per_gas"], hidden=True)


@_query
def proof_columns(fx: Fixtures) -> DataFrame:
    return catalog.with_proofs(fx.blocks(), ["gas_used", "timestamp"])


@_query
def warehouse_features(fx: Fixtures) -> DataFrame:
    """All features of the finalized blocks, from tables as a warehouse has them."""
    return features.features_from_warehouse(*fx.warehouse(), NINE, 0, fx.head())


@_query
def warehouse_counts(fx: Fixtures) -> DataFrame:
    """Transaction counts of a chain whose warehouse has no fees, no gas and no receipts."""
    blocks, transactions, _ = fx.warehouse()
    return features.features_from_warehouse(blocks.drop("base_fee_per_gas", "gas_used", "gas_limit"), transactions, None, ["tx_count", "timestamp"], 0, fx.head())


@_query
def receipt_proofs(fx: Fixtures) -> DataFrame:
    """Blocks whose fee percentiles are not proved, as some receipts are missing."""
    kept = fx.receipts().where(~((F.col("transaction_index") == 0) & (F.col("effective_gas_price") % 97 == 5)))
    built = fx.headers().join(_full(fx).select("block_number", NINE[-1]), "block_number")
    return checks.proof_mismatches(catalog.with_proofs(built, ["timestamp", NINE[-1]], kept))


@_query
def scan_blocks(fx: Fixtures) -> DataFrame:
    head, (low, high) = fx.head(), fx.events().agg(F.min("timestamp"), F.max("timestamp")).first()
    return warehouse.scan_blocks(fx.blocks(), head // 4, head // 2, low + (high - low) // 5, high)


@_query
def scan_by_time(fx: Fixtures) -> DataFrame:
    low, high = fx.events().agg(F.min("timestamp"), F.max("timestamp")).first()
    return warehouse.scan_by_time(fx.timed(fx.receipts()), low + (high - low) // 4, low + (high - low) // 2)


# Decoding


@_query
def decode_headers(fx: Fixtures) -> DataFrame:
    return decode.decode_headers(fx.raw_blocks())


def _fee_replies(fx: Fixtures) -> DataFrame:
    """One reply per 1,024 blocks, from the computed percentiles."""
    rows = chunks.with_chunk_id(_full(fx), 0)
    entry = F.struct("block_number", F.array(to_quantity(F.col(NINE[-2])), to_quantity(F.col(NINE[-1]))).alias("row"))
    grouped = rows.groupBy("chunk_id").agg(F.min("block_number").alias("start_block"), F.count(F.lit(1)).alias("block_count"), F.array_sort(F.collect_list(entry)).alias("x"))  # 1,024 rows each
    reply = F.to_json(F.struct(to_quantity(F.col("start_block")).alias("oldestBlock"), F.transform("x", lambda e: e.getField("row")).alias("reward")))
    return grouped.select("start_block", "block_count", reply.alias("reply"))


@_query
def decode_fee_history(fx: Fixtures) -> DataFrame:
    fees = decode.decode_fee_history(_fee_replies(fx), [50, 90])
    return decode.with_fees(fx.blocks().select("block_number", "block_hash"), fees)


@_query
def reconcile_replies(fx: Fixtures) -> DataFrame:
    return decode.reconcile_replies(fx.requests(), fx.replies())


@_query
def reconcile_batches(fx: Fixtures) -> DataFrame:
    """The same from the JSON text that came back, with members and payloads of wrong shapes."""
    return decode.reconcile_batches(fx.requests(), fx.landed_batches())


@_query
def retry_calls(fx: Fixtures) -> DataFrame:
    return decode.retries(decode.reconcile_replies(fx.requests(), fx.replies())).select("batch_id", "id")


# Ranges


@_query
def normalize_bounds(fx: Fixtures) -> DataFrame:
    return ranges.normalize_bounds(fx.ranges())


def _block_requests(fx: Fixtures) -> DataFrame:
    n = F.col("n")
    return fx.events().select(n.alias("range_id"), F.when(n % 60 == 7, n + 9).otherwise(n).alias("from_block"), F.when(n % 80 != 27, n + 5 + (n % 3) * 60).alias("to_block"))


@_query
def check_requests(fx: Fixtures) -> DataFrame:
    times = fx.ranges().select("range_id", F.lit(None).cast("bigint").alias("from_block"), F.lit(None).cast("bigint").alias("to_block"), F.col("from_value").alias("from_time"), F.col("to_value").alias("to_time"))
    n = F.col("range_id")
    blocks = _block_requests(fx).select("range_id", (F.col("from_block") - F.when(n % 100 == 67, 1_000_000_000).otherwise(0)).alias("from_block"), "to_block", F.when(n % 140 == 47, "2026-01-01").alias("from_time"), F.lit(None).cast("string").alias("to_time"))
    return ranges.check_requests(times.unionByName(blocks)).select("range_id", "from_block", "to_block", "from_time", "to_time", "code")


@_query
def finalized_head(fx: Fixtures) -> DataFrame:
    heads = fx.events().agg(F.max("n").alias("m")).select(F.explode(F.array(F.col("m") - 100, F.col("m") - 64)).alias("block_number"))
    return ranges.finalized_head(heads)


def _resolved(fx: Fixtures, bucket: int = ranges.HOUR) -> DataFrame:
    return ranges.resolve_time_ranges(ranges.normalize_bounds(fx.ranges()), fx.events().withColumnRenamed("n", "block_number"), fx.head(), bucket)


@_query
def resolve_time_ranges(fx: Fixtures) -> DataFrame:
    return _resolved(fx)


@_query
def resolve_time_ranges_by_day(fx: Fixtures) -> DataFrame:
    return _resolved(fx, ranges.DAY)


@_query
def resolve_block_ranges(fx: Fixtures) -> DataFrame:
    return ranges.resolve_block_ranges(_block_requests(fx), fx.events().withColumnRenamed("n", "block_number"), fx.head())


@_query
def verify_edges(fx: Fixtures) -> DataFrame:
    bounds = stored(ranges.normalize_bounds(fx.ranges()).select("range_id", "start", "end", "code"))  # parsed once, read for the edges and for the proof
    resolved = ranges.resolve_time_ranges(bounds, fx.events().withColumnRenamed("n", "block_number"), fx.head())
    proved = ranges.verify_edges(resolved, bounds, fx.blocks(), fx.verifier(), fx.head())
    return proved.select("range_id", F.col("proved").cast("bigint").alias("proved"))


# Checks


@_query
def domain_violations(fx: Fixtures) -> DataFrame:
    return checks.domain_violations(fx.broken())


@_query
def null_counts(fx: Fixtures) -> DataFrame:
    return checks.null_counts(fx.broken())


@_query
def contiguity(fx: Fixtures) -> DataFrame:
    last = fx.head() + 100
    good = checks.contiguity(fx.blocks(), 0, last).withColumn("of", F.lit("blocks"))
    return good.unionByName(checks.contiguity(fx.broken(), 0, last).withColumn("of", F.lit("broken")))


@_query
def time_violations(fx: Fixtures) -> DataFrame:
    n = F.col("block_number")
    return checks.time_violations(fx.blocks().withColumn("timestamp", F.when(n % 601 == 21, F.col("timestamp") - 100_000).otherwise(F.col("timestamp"))), 0, None)


@_query
def link_violations(fx: Fixtures) -> DataFrame:
    return checks.link_violations(fx.broken())


@_query
def link_violations_by_chunk(fx: Fixtures) -> DataFrame:
    return checks.link_violations(fx.broken(), size=chunks.CHUNK_SIZE)


@_query
def dataset_summary(fx: Fixtures) -> DataFrame:
    last = fx.head() + 100
    target = fx.blocks().where(F.col("block_number") == last).first()["block_hash"]
    times = tuple(fx.events().agg(F.min("timestamp"), F.max("timestamp")).first())
    good = checks.dataset_summary(fx.blocks(), 0, last, target, times).withColumn("of", F.lit("blocks"))
    return good.unionByName(checks.dataset_summary(fx.broken(), 0, last, target, times).withColumn("of", F.lit("broken")))


@_query
def proof_mismatches(fx: Fixtures) -> DataFrame:
    n = F.col("block_number")
    staged = catalog.with_proofs(fx.blocks(), NINE[:7]).withColumns({"timestamp": F.when(n % 701 == 19, F.col("timestamp") + 1).otherwise(F.col("timestamp")), "_proof_hash": F.when(n % 809 != 23, F.col("_proof_hash"))})
    return checks.proof_mismatches(staged)


# Agreement


@_query
def sample_numbers(fx: Fixtures) -> DataFrame:
    ids = fx.spark.createDataFrame([(k, i) for k, (i, _) in enumerate(SAMPLE_IDS)], "k bigint, dataset_id string")
    n = F.col("n")
    spans = fx.events().select((n % len(SAMPLE_IDS)).alias("k"), n.alias("first_block"), (n + (n % 7)).alias("last_block"))
    rows = spans.join(F.broadcast(ids), "k")  # a handful of fixed ids
    return agree.sample_numbers(rows).groupBy("dataset_id", "block_number").agg(F.count(F.lit(1)).alias("times"))


def _asked(fx: Fixtures) -> DataFrame:
    return fx.events().select(F.col("n").alias("block_number"))


@_query
def rows_at(fx: Fixtures) -> DataFrame:
    return agree.rows_at(fx.verifier(), _asked(fx))


@_query
def missing_at(fx: Fixtures) -> DataFrame:
    return agree.missing_at(fx.verifier(), _asked(fx))


@_query
def compare_sample(fx: Fixtures) -> DataFrame:
    return agree.compare_sample(fx.blocks(), fx.verifier(), _asked(fx))


@_query
def compare_full(fx: Fixtures) -> DataFrame:
    """Both copies also lack the first and the last block."""
    last = fx.head() + 100
    inner = F.col("block_number").between(1, last - 1)
    return agree.compare_full(fx.blocks().where(inner), fx.verifier().where(inner), 0, last)


@_query
def core_mismatches(fx: Fixtures) -> DataFrame:
    return agree.core_mismatches(fx.blocks(), fx.verifier())


def _span(fx: Fixtures) -> tuple[int, str, int, str]:
    head = fx.head()
    rows = {r.block_number: r.block_hash for r in fx.blocks().where(F.col("block_number").isin(head // 2, head - 50)).collect()}
    return head // 2, rows[head // 2], head - 50, rows[head - 50]


@_query
def canonical_chain(fx: Fixtures) -> DataFrame:
    """The line to the finalized head among headers of losing branches."""
    head = fx.head()
    return canonical.canonical_chain(fx.forked(), head, fx.hash_at(head))


@_query
def ancestry_breaks_forked(fx: Fixtures) -> DataFrame:
    """The same faults as without forks: losing branches are no faults, and hide none."""
    return agree.ancestry_breaks(fx.forked(fx.verifier()), *_span(fx))


@_query
def ancestry_breaks(fx: Fixtures) -> DataFrame:
    return agree.ancestry_breaks(fx.verifier(), *_span(fx))


@_query
def refresh_anchor(fx: Fixtures) -> DataFrame:
    good = agree.refresh_anchor(fx.blocks(), *_span(fx), fx.head()).withColumn("of", F.lit("blocks"))
    return good.unionByName(agree.refresh_anchor(fx.verifier(), *_span(fx), fx.head()).withColumn("of", F.lit("verifier")))


# Storage


@_query
def write_parquet(fx: Fixtures) -> DataFrame:
    path = scratch_dir(fx.spark)
    store.write_dataset(fx.blocks().select("block_number", *NINE[:7]), path)
    return store.read_dataset(fx.spark, path, catalog.Selection.of(NINE[:7]))


@_query
def write_csv(fx: Fixtures) -> DataFrame:
    path = scratch_dir(fx.spark)
    store.write_dataset(fx.blocks().select("block_number", *NINE[:7]), path, "csv")
    return store.read_dataset(fx.spark, path, catalog.Selection.of(NINE[:7]), "csv")


@_query
def read_parquet(fx: Fixtures) -> DataFrame:
    path = scratch_dir(fx.spark)
    store.write_dataset(fx.blocks().select("block_number", "timestamp", "tx_count"), path)
    return store.read_dataset(fx.spark, path, catalog.Selection.of(["timestamp", "tx_count"]))


@_query
def read_csv(fx: Fixtures) -> DataFrame:
    path = scratch_dir(fx.spark)
    store.write_dataset(fx.blocks().select("block_number", "timestamp", "block_hash"), path, "csv")
    return store.read_dataset(fx.spark, path, catalog.Selection.of(["block_hash", "timestamp"]), "csv")


@_query
def chunk_bounds(fx: Fixtures) -> DataFrame:
    return chunks.chunk_bounds(fx.broken(), 0)


def _staged(fx: Fixtures, size: int = 1024, blocks: DataFrame | None = None) -> DataFrame:
    """All blocks' rows staged by chunks; every fourth chunk is staged again, and is not there twice."""
    path = scratch_dir(fx.spark)
    rows = catalog.with_proofs(fx.blocks() if blocks is None else blocks, NINE[:7])
    store.bind_staging(fx.spark, path, {"first": 0, "size": size})
    store.stage_chunks(rows, path, 0, size)
    store.stage_chunks(rows.where(F.floor(F.col("block_number") / size) % 4 == 1), path, 0, size)
    return store.staged_rows(fx.spark, path)


@_query
def chunk_states(fx: Fixtures) -> DataFrame:
    """Chunks of a copy with gaps and wrong parents; the file of the second eight is spoilt after staging."""
    path, spark = scratch_dir(fx.spark), fx.spark
    store.stage_chunks(catalog.with_proofs(fx.verifier(), NINE[:7]), path, 0, 256, per_file=8)
    spoilt = store.chunk_log(spark, path).where("chunk_id = 8").select("batch", "file").collect()
    for batch, file in spoilt:
        fs, at = store._fs(spark, f"{path}/data/batch={batch}/{file}")
        out = fs.create(at, True)
        out.write(bytearray(b"no longer what was staged"))
        out.close()
    return store.chunk_states(spark, path, 0, fx.head() + 400, 256)


@_query
def stage_chunks(fx: Fixtures) -> DataFrame:
    return _staged(fx)


@_query
def missing_chunks(fx: Fixtures) -> DataFrame:
    """Of blocks with gaps, many chunks are not complete."""
    return store.missing_chunks(_staged(fx, 256, fx.verifier()), 0, fx.head() + 200, 256)


@_query
def assemble(fx: Fixtures) -> DataFrame:
    return store.assemble(_staged(fx), catalog.Selection.of(NINE[:7]))


@_query
def run_receipt(fx: Fixtures) -> DataFrame:
    return store.run_receipt(_staged(fx), 0, fx.head() + 100, 1)


@_query
def manifest_facts(fx: Fixtures) -> DataFrame:
    return store.manifest_facts(fx.blocks())


#: Rows of a file where the queries on digests need many files.
ROWS_PER_FILE = 1024


def _numbered_files(found: DataFrame) -> DataFrame:
    """With part and file, the two numbers in the names that Spark gives to a dataset's files."""
    number = lambda pattern: F.regexp_extract("name", pattern, 1).cast("bigint")
    return found.withColumns({"part": number(r"part-(\d+)-"), "file": number(r"-c(\d+)\.")})


def _digests(fx: Fixtures) -> tuple[str, DataFrame]:
    """The path of a CSV dataset of many files, and the files' digests."""
    path = scratch_dir(fx.spark)
    span = tuple(fx.events().agg(F.min("n"), F.max("n")).first())
    store.write_dataset(fx.blocks().select("block_number", "timestamp"), path, "csv", span, ROWS_PER_FILE)
    return path, _numbered_files(store.file_digests(fx.spark, path))


@_query
def file_digests(fx: Fixtures) -> DataFrame:
    return _digests(fx)[1].select("part", "file", "bytes", "sha256")


@_query
def changed_files(fx: Fixtures) -> DataFrame:
    """Of each four files the first was not recorded, the second with another digest, the third under another name."""
    path, now = _digests(fx)
    kind = F.col("file") % 4
    recorded = now.where(kind > 0).select(
        F.when(kind == 2, F.concat(F.lit("old-"), F.col("name"))).otherwise(F.col("name")).alias("name"), "bytes", F.when(kind == 1, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256")
    )
    return _numbered_files(store.changed_files(fx.spark, path, recorded)).select("part", "file", "reason")


@_query
def csv_violations(fx: Fixtures) -> DataFrame:
    path, n = scratch_dir(fx.spark), F.col("block_number")
    spoilt = {
        "block_number": F.when(n % 401 == 3, F.concat(F.lit("0"), n.cast("string"))).otherwise(n.cast("string")),
        "timestamp": F.when(n % 409 != 5, F.col("timestamp").cast("string")),
        "tx_count": F.when(n % 419 == 7, F.lit("+1")).otherwise(F.col("tx_count").cast("string")),
    }
    fx.blocks().select(*(c.alias(k) for k, c in spoilt.items())).write.csv(path, header=True)
    found = store.csv_violations(fx.spark, path, catalog.Selection.of(["timestamp", "tx_count"]))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@_query
def order_violations(fx: Fixtures) -> DataFrame:
    path = scratch_dir(fx.spark)
    rows = fx.blocks().select("block_number", "timestamp")
    rows.repartitionById(4, (F.col("block_number") % 4).cast("int")).sortWithinPartitions(F.col("block_number").desc()).write.parquet(path)
    found = store.order_violations(fx.spark, path)
    return found.select("reason", F.regexp_extract("file", r"^part-(\d+)", 1).cast("bigint").alias("part"))


@_query
def audit_manifests(fx: Fixtures) -> DataFrame:
    root, last, rows = scratch_dir(fx.spark), fx.head() + 100, fx.blocks()
    anchor = {"block_number": last, "block_hash": rows.where(F.col("block_number") == last).first()["block_hash"], "tag": "finalized"}
    cuts = [0, last // 3, 2 * last // 3, last + 1]
    for low, high, facts in zip(cuts[:3], cuts[1:], (None, {"target_hash": "0x"}, {"row_count": 1}), strict=True):
        third = rows.where(F.col("block_number").between(low, high - 1))
        store.publish(third, root, NINE[:7], anchor, rows, {"name": "events", "chain_id": 1}, {"kind": "tables"}, facts=facts)
    return store.audit_manifests(fx.spark, root).groupBy("faults").agg(F.count(F.lit(1)).alias("datasets"))


# Streams


@_query
def stream_headers(fx: Fixtures) -> DataFrame:
    base = scratch_dir(fx.spark)
    raw = fx.raw_blocks()
    raw.write.json(f"{base}/src")
    stream.stream_headers(fx.spark, f"{base}/src", f"{base}/out", f"{base}/checkpoint")
    raw.where("requested % 3 = 0").write.mode("append").json(f"{base}/src")  # delivered again
    stream.stream_headers(fx.spark, f"{base}/src", f"{base}/out", f"{base}/checkpoint")
    return fx.spark.read.parquet(f"{base}/out")


@_query
def finalized_view(fx: Fixtures) -> DataFrame:
    head = fx.head()
    return stream.finalized_view(fx.blocks(), head, fx.hash_at(head), 0)


@_query
def stream_reorgs(fx: Fixtures) -> DataFrame:
    """Losing branches land before the blocks that replace them; what is read is the finalized line."""
    base, head = scratch_dir(fx.spark), fx.head()
    fx.raw_blocks(fx.losing(fx.blocks()).unionByName(fx.blocks().where("block_number % 3 = 0")), spoil=False).write.json(f"{base}/src")
    run = lambda: stream.stream_headers(fx.spark, f"{base}/src", f"{base}/out", f"{base}/checkpoint")
    run()
    fx.raw_blocks(spoil=False).write.mode("append").json(f"{base}/src")
    run()
    return stream.finalized_view(fx.spark.read.parquet(f"{base}/out"), head, fx.hash_at(head), 0)


def _deliveries(fx: Fixtures, base: str, late_too) -> list[str]:
    """Receipts in two folders, from one pass: those at even places, and those at odd ones for which late_too holds."""
    odd = F.col("transaction_index") % 2
    rows = fx.receipts().withColumn("late", odd.cast("int")).where((odd == 0) | late_too)
    rows.write.partitionBy("late").option("compression", "zstd").parquet(f"{base}/made")
    return [f"{base}/made/late=0", f"{base}/made/late=1"]


def _deliver(fx: Fixtures, folder: str, src: str) -> None:
    """Put a folder where the stream looks for new files."""
    (fs, at), (_, to) = store._fs(fx.spark, folder), store._fs(fx.spark, src)
    fs.mkdirs(to)
    if fs.exists(at):  # without rows there is none
        fs.rename(at, store._fs(fx.spark, f"{src}/{at.getName()}")[1])


@_query
def stream_features(fx: Fixtures) -> DataFrame:
    base = scratch_dir(fx.spark)
    early, late = _deliveries(fx, base, F.col("block_hash") != as_hash(F.lit(33)))
    run = lambda: stream.stream_features(fx.spark, f"{base}/src", blocks, f"{base}/out", f"{base}/checkpoint", NINE)
    fx.headers().write.option("compression", "zstd").parquet(f"{base}/blocks")
    blocks = fx.spark.read.parquet(f"{base}/blocks")
    _deliver(fx, early, f"{base}/src")
    run()
    _deliver(fx, late, f"{base}/src")
    run()
    return fx.spark.read.parquet(f"{base}/out")


@_query
def stream_final_features(fx: Fixtures) -> DataFrame:
    """The features of the finalized line alone: headers of losing branches, and their receipts, are there too."""
    base, head = scratch_dir(fx.spark), fx.head()
    fx.forked(fx.headers()).write.option("compression", "zstd").parquet(f"{base}/blocks")
    early, late = _deliveries(fx, base, F.lit(True))
    run = lambda to: stream.stream_features(fx.spark, f"{base}/src", f"{base}/blocks", f"{base}/out", f"{base}/checkpoint", NINE, lambda: (to, fx.hash_at(to)))
    _deliver(fx, early, f"{base}/src")
    run(head // 2)
    _deliver(fx, late, f"{base}/src")
    run(head)
    return fx.spark.read.parquet(f"{base}/out")
