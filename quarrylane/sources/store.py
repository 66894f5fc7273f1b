"""Datasets on storage: ordered Parquet or CSV parts, a manifest written last, staging by chunks."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import HASH, UUID4
from ..operators import agree
from ..operators.checks import assert_clean, assert_observed, dataset_summary, observed_facts
from ..plans.catalog import ALWAYS, CATALOG, KEY, DatasetError, Selection, without_proofs
from .chunks import CHUNK_SIZE, chunk_bounds, planned_chunks, with_chunk_id
from .scratch import stored

MAX_RECORDS_PER_FILE = 4_000_000
#: Smaller datasets have a file for so many rows.
RECORDS_PER_PART = 1 << 16
#: Chunks that are stored in one file of a staging folder.
CHUNKS_PER_FILE = 64
# The keys of a manifest, sorted as they are written.
MANIFEST_KEYS = ("acquisition_plan", "chain", "completed_at", "dataset_id", "finalized_anchor", "output", "requested_range", "resolved_range", "row_count", "schema", "source", "target_hash", "tool_version", "verification")


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path: any store that Spark reads."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", span: tuple[int, int] | None = None, records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Write a dataset in block order, across its files too; an existing one is never overwritten.

    The order across files is that of their names. One exchange, then each file is sorted. If the
    first and last number are known (span), rows are dealt by their number; else Spark samples the
    rows to find the ranges, which computes them twice. A file has records_per_file rows at most.
    """
    if fmt not in ("parquet", "csv"):
        raise DatasetError("OUTPUT_FORMAT", fmt)
    if span is None:
        dealt = df.repartitionByRange(KEY)
    else:
        first, blocks = span[0], span[1] - span[0] + 1
        parts = max(1, min(-(-blocks // RECORDS_PER_PART), max(blocks // MAX_RECORDS_PER_FILE, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
        part = F.floor((F.col(KEY) - first) * parts / blocks)
        dealt = df.repartitionById(parts, F.greatest(F.lit(0), F.least(part, F.lit(parts - 1))).cast("int"))
    writer = dealt.sortWithinPartitions(KEY).write.mode("errorifexists").option("maxRecordsPerFile", records_per_file)
    if fmt == "parquet":
        writer.option("compression", "zstd").parquet(path)
    else:
        writer.option("header", True).csv(path)


def read_dataset(spark: SparkSession, path: str, plan: Selection, fmt: str = "parquet") -> DataFrame:
    """Read a dataset with exactly the plan's schema."""
    if fmt == "parquet":
        found = spark.read.parquet(path).schema
        if [(f.name, f.dataType) for f in found] != [(f.name, f.dataType) for f in plan.schema]:
            raise DatasetError("DATASET_SCHEMA", f"expected {plan.schema.simpleString()}, found {found.simpleString()}")
        return spark.read.schema(plan.schema).parquet(path)
    return spark.read.schema(plan.schema).option("mode", "FAILFAST").csv(path, header=True, enforceSchema=False)


def csv_violations(spark: SparkSession, path: str, plan: Selection) -> DataFrame:
    """(line, reason) of rows that are no canonical tokens: columns (too few or many) or the integer column's name."""
    names = [f.name for f in plan.schema]
    schema = ", ".join([f"{n} string" for n in names] + ["_bad string"])
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_bad").csv(path, header=True, enforceSchema=True)
    integers = [f.name for f in plan.schema if f.dataType.simpleString() == "bigint"]
    reason = F.coalesce(F.when(F.col("_bad").isNotNull(), F.lit("columns")), *(F.when(~F.coalesce(F.col(c).rlike(r"^(?:0|[1-9][0-9]*)\z"), F.lit(False)), F.lit(c)) for c in integers))
    return rows.select(F.coalesce("_bad", F.concat_ws(",", *names)).alias("line"), reason.alias("reason")).where("reason is not null")


def csv_header_ok(spark: SparkSession, path: str, plan: Selection) -> bool:
    """Whether every file begins with exactly the plan's header."""
    want = ",".join(plan.columns)
    first = spark.read.format("text").option("wholetext", False).load(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"))
    heads = first.where(F.col("s") == 0).where(F.col("value").startswith(KEY)).groupBy("f").agg(F.count_if(F.col("value") == want).alias("n"))
    files = first.select("f").distinct().count()
    return heads.where("n = 1").count() == files


def order_violations(spark: SparkSession, path: str) -> DataFrame:
    """(file, reason): Parquet files whose rows do not ascend (inside), or do not follow the file before (across)."""
    from pyspark.sql import Window

    rows = spark.read.parquet(path).select(KEY, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("i"))
    at = Window.partitionBy("file").orderBy("i")
    inside = rows.withColumn("previous", F.lag(KEY).over(at)).where(F.col(KEY) <= F.col("previous")).select("file").distinct().select("file", F.lit("inside").alias("reason"))
    files = rows.groupBy("file").agg(F.min(KEY).alias("low"), F.max(KEY).alias("high"))
    across = files.withColumn("before", F.lag("high").over(Window.partitionBy(F.lit(0)).orderBy("file"))).where("low <= before")  # one row per file
    return inside.unionByName(across.select("file", F.lit("across").alias("reason")))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, sha256) of every data file of a dataset."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return named.where(~F.col("name").startswith("_") & ~F.col("name").startswith(".") & (F.col("name") != "manifest.json"))


def changed_files(spark: SparkSession, path: str, recorded: DataFrame) -> DataFrame:
    """(name, reason): files added, removed or changed since their digests were recorded."""
    now = file_digests(spark, path).select("name", F.struct("bytes", "sha256").alias("now"))
    then = recorded.select("name", F.struct("bytes", "sha256").alias("then"))
    reason = F.when(F.col("now").isNull(), "removed").when(F.col("then").isNull(), "added").when(F.col("now") != F.col("then"), "changed")
    return now.join(then, "name", "full_outer").select("name", reason.alias("reason")).where("reason is not null")


def manifest_facts(df: DataFrame) -> DataFrame:
    """One row of what a manifest records of the rows: count, range, times and the last block's hash."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.min(KEY).alias("from_block"), F.max(KEY).alias("to_block"), F.min_by("timestamp", KEY).alias("from_timestamp"), F.max_by("timestamp", KEY).alias("to_timestamp"), F.max_by("block_hash", KEY).alias("target_hash")
    )


def canonical_json(value: object) -> str:
    """Sorted keys, no spaces, a line feed at the end."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def publish(df: DataFrame, root: str, names: list[str], anchor: dict, verifier: DataFrame, chain: dict, source: dict, fmt: str = "parquet", dataset_id: str | None = None, requested: dict | None = None, facts: dict | None = None) -> str:
    """Validate, write, verify and publish the named features of a block table; returns the dataset's path.

    df has the features and what their checks need besides (`Selection.hidden`). It is evaluated
    once: its rows go to a folder beside the dataset's, and the counts, edges and faults of all of
    them are observed in that very job, so that a result with gaps, nulls or impossible values is refused
    before anything is published. Links are judged on what was stored, in one exchange; the data is
    written from there to data/ under a fresh path, read back, validated once more and compared
    with the verifier, an independent copy, at the blocks of `sample_numbers`. The manifest records
    these and the moment, is written last, and readers require it. A dataset that exists is left
    alone.

    chain is {name, chain_id}, source says where the rows are from (kind, and further texts), and
    requested is the range that was asked for: a block range, which the rows must cover exactly (by
    default their own), or a time range, with its kind. facts overwrite single keys of the manifest.
    """
    spark, plan = df.sparkSession, Selection.of(names)
    dataset_id = dataset_id or str(uuid.uuid4())
    path, staging = f"{root}/{dataset_id}", f"{root}/.{dataset_id}.rows"
    if _exists(spark, path):
        raise DatasetError("OUTPUT_EXISTS", path)
    needed = df.select(*plan.columns, *plan.hidden)
    watched, observed = observed_facts(needed)
    try:
        watched.write.mode("overwrite").parquet(staging)
        row = observed.get
        first, last, times = row["from_block"], row["to_block"], (row["from_timestamp"], row["to_timestamp"])
        asked = (requested["from"], requested["to"]) if requested is not None and requested["kind"] == "block" else None
        assert_observed(row, asked)
        rows = spark.read.schema(needed.schema).parquet(staging)
        assert_clean(dataset_summary(rows, first, last, row["target_hash"], times))
        write_dataset(rows.select(*plan.columns), f"{path}/data", fmt, (first, last))
    finally:
        _delete(spark, staging)
    back = read_dataset(spark, f"{path}/data", plan, fmt)
    assert_clean(dataset_summary(back, first, last, row["target_hash"], times))
    sampled = _sampled(spark, dataset_id, first, last)
    if agree.compare_sample(back, verifier, sampled).count():
        raise DatasetError("VERIFICATION_FAILED", "the independent copy differs at sampled blocks")
    digests = [r.asDict() for r in file_digests(spark, f"{path}/data").orderBy("name").collect()]  # one row per file
    manifest = {
        "tool_version": "1", "dataset_id": dataset_id, "completed_at": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "chain": chain, "source": source,
        "requested_range": requested or {"kind": "block", "from": first, "to": last}, "resolved_range": {"from_block": first, "to_block": last, "from_timestamp": times[0], "to_timestamp": times[1]},
        "row_count": row["row_count"], "target_hash": row["target_hash"], "finalized_anchor": anchor,
        "schema": [{"name": f.name, "type": "Int64" if f.dataType.simpleString() == "bigint" else "UTF-8", "unit": f.metadata["unit"]} for f in plan.schema], "acquisition_plan": {"features": list(plan.names), "hidden": list(plan.hidden)},
        "output": {"format": fmt, "files": digests}, "verification": {"sampled_blocks": sorted(r[KEY] for r in sampled.collect()), "target_agreement": True, "verifier_chain_id": chain["chain_id"]},  # five at most
    }
    manifest |= {k: v for k, v in (facts or {}).items() if k in MANIFEST_KEYS}
    fs, at = _fs(spark, f"{path}/manifest.json")
    out = fs.create(at, False)
    out.write(bytearray(canonical_json(manifest).encode("utf-8")))
    out.close()
    return path


def _sampled(spark: SparkSession, dataset_id: str, first: int, last: int) -> DataFrame:
    """The block numbers at which a dataset is compared."""
    one = spark.createDataFrame([(dataset_id, first, last)], "dataset_id string, first_block bigint, last_block bigint")
    return agree.sample_numbers(one).select(KEY)


@dataclass(frozen=True)
class Dataset:
    """A validated dataset."""

    path: str
    manifest: dict
    df: DataFrame


def open_dataset(spark: SparkSession, path: str) -> Dataset:
    """Read and validate a dataset: canonical manifest, schema, digests, tokens (CSV), rows.

    The rows are checked as far as the columns there are allow: count, range, nulls and domains
    always; links, target and times where their columns are.
    """
    if not _exists(spark, f"{path}/manifest.json"):
        raise DatasetError("MANIFEST_MISSING", path)
    text = spark.read.text(f"{path}/manifest.json", wholetext=True).first()[0]
    try:
        manifest = json.loads(text)
    except ValueError:
        raise DatasetError("MANIFEST_INVALID", "not JSON") from None
    if text != canonical_json(manifest):
        raise DatasetError("MANIFEST_INVALID", "not canonical")
    if audit_manifests(spark, path, depth="").where("faults <> ''").count():
        raise DatasetError("MANIFEST_INVALID", "see audit_manifests")
    plan = Selection.of([c["name"] for c in manifest["schema"]][1:])
    recorded = spark.createDataFrame([(f["name"], f["bytes"], f["sha256"]) for f in manifest["output"]["files"]], "name string, bytes bigint, sha256 string")
    if changed_files(spark, f"{path}/data", recorded).count():
        raise DatasetError("DATASET_DIGEST", "files are not those of the manifest")
    fmt = manifest["output"]["format"]
    if fmt == "csv" and (not csv_header_ok(spark, f"{path}/data", plan) or not csv_violations(spark, f"{path}/data", plan).isEmpty()):
        raise DatasetError("DATASET_TOKENS", "the CSV files are not canonical")
    df = read_dataset(spark, f"{path}/data", plan, fmt)
    span = manifest["resolved_range"]
    assert_clean(dataset_summary(df, span["from_block"], span["to_block"], manifest["target_hash"], (span["from_timestamp"], span["to_timestamp"])))
    return Dataset(path, manifest, df)


def verify(dataset: Dataset, verifier: DataFrame, head: int, full: bool = False) -> dict:
    """Compare an opened dataset with an independent copy of the chain up to its finalized head; returns what was found.

    Every block (full) or the sampled ones are compared, the manifest's anchor is followed to the
    head, and the files are digested once more at the end, so that what was compared is what is
    there. Raises on a difference.
    """
    spark, m = dataset.df.sparkSession, dataset.manifest
    first, last = m["resolved_range"]["from_block"], m["resolved_range"]["to_block"]
    sampled = _sampled(spark, m["dataset_id"], first, last)
    differences = agree.compare_full(dataset.df, verifier, first, last) if full else agree.compare_sample(dataset.df, verifier, sampled)
    if n := differences.count():
        raise DatasetError("VERIFICATION_FAILED", f"{n} differences")
    anchor = m["finalized_anchor"]
    new = agree.refresh_anchor(verifier, last, m["target_hash"], anchor["block_number"], anchor["block_hash"], head).first()
    if new is None or not new["refreshed"]:
        raise DatasetError("VERIFICATION_ANCHOR", "the chain does not lead from the dataset over its anchor to the head")
    recorded = spark.createDataFrame([(f["name"], f["bytes"], f["sha256"]) for f in m["output"]["files"]], "name string, bytes bigint, sha256 string")
    if changed_files(spark, f"{dataset.path}/data", recorded).count():
        raise DatasetError("DATASET_DIGEST", "files changed meanwhile")
    compared = last - first + 1 if full else sampled.count()
    return {"compared_blocks": compared, "finalized_anchor": {**anchor, "block_number": new[KEY], "block_hash": new["block_hash"]}}


MANIFEST = (
    "acquisition_plan struct<features:array<string>,hidden:array<string>>, tool_version string, dataset_id string, completed_at string, chain struct<name:string,chain_id:bigint>, requested_range struct<kind:string,from:string,to:string,normalized_from_utc:string,normalized_to_utc:string>, "
    "resolved_range struct<from_block:bigint,to_block:bigint,from_timestamp:bigint,to_timestamp:bigint>, schema array<struct<name:string,type:string,unit:string>>, source map<string,string>, row_count bigint, "
    "output struct<format:string,files:array<struct<name:string,bytes:bigint,sha256:string>>>, target_hash string, finalized_anchor struct<block_number:bigint,block_hash:string,tag:string>, verification struct<sampled_blocks:array<bigint>,target_agreement:boolean,verifier_chain_id:bigint>"
)
# The keys of a manifest's parts.
PART_KEYS = {
    "acquisition_plan": ("features", "hidden"), "chain": ("chain_id", "name"), "finalized_anchor": ("block_hash", "block_number", "tag"), "output": ("files", "format"),
    "resolved_range": ("from_block", "from_timestamp", "to_block", "to_timestamp"), "verification": ("sampled_blocks", "target_agreement", "verifier_chain_id"),
}
NAME = r"^[A-Za-z0-9][A-Za-z0-9_.-]*\z"


def canonical_text(value: Column) -> Column:
    """JSON text in canonical form, keys sorted at every depth, no spaces, a line feed at the end; null if it is no JSON.

    A variant keeps the fields of each object in the order of their names.
    """
    return F.concat(F.to_json(F.try_parse_json(value)), F.lit("\n"))


def _expected_plan(names: Column) -> tuple[Column, Column]:
    """The columns that a selection has in catalog order, and those that its checks need besides: the catalog's closure."""
    chosen = lambda c: F.array_contains(names, c)
    features = F.array_compact(F.array(*(F.when(chosen(f.name), F.lit(f.name)) for f in CATALOG)))
    implied = lambda c: F.lit(c in ALWAYS) | F.arrays_overlap(names, F.array(*(F.lit(f.name) for f in CATALOG if c in f.implies)).cast("array<string>"))
    hidden = F.array_compact(F.array(*(F.when(implied(f.name) & ~chosen(f.name), F.lit(f.name)) for f in CATALOG)))
    return features, hidden


def audit_manifests(spark: SparkSession, root: str, depth: str = "/*") -> DataFrame:
    """(dataset_id, faults) for every manifest under root: the names of the rules it breaks, comma-separated.

    All rules are column expressions over one scan of the manifests: canonical bytes, keys at both
    depths, types and values, the schema and the plan that follow from the selection, and the blocks that
    must have been sampled for the id.
    """
    raw = spark.read.text(f"{root}{depth}/manifest.json", wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    part = lambda k: F.sort_array(F.json_object_keys(F.get_json_object("value", f"$.{k}")))
    parts = {k: part(k) == F.array(*(F.lit(x) for x in keys)) for k, keys in PART_KEYS.items()}
    asked = part("requested_range")
    rows = raw.select(
        "file", F.sort_array(F.json_object_keys("value")).alias("keys"), F.from_json("value", MANIFEST).alias("m"), (canonical_text(F.col("value")) == F.col("value")).alias("canonical"), asked.alias("asked"), F.struct(*(c.alias(k) for k, c in parts.items())).alias("part")
    )
    r, req, a, v = F.col("m.resolved_range"), F.col("m.requested_range"), F.col("m.finalized_anchor"), F.col("m.verification")
    names = F.transform("m.schema", lambda c: c.getField("name"))
    features, hidden = _expected_plan(names)
    described = {KEY: ("Int64", "block")} | {f.name: (f.kind, f.unit) for f in CATALOG}
    known = F.create_map(*(x for n, (kind, unit) in described.items() for x in (F.lit(n), F.struct(F.lit(n).alias("name"), F.lit(kind).alias("type"), F.lit(unit).alias("unit")))))
    columns = F.transform(F.concat(F.array(F.lit(KEY)), features), lambda n: F.element_at(known, n))
    utc = lambda c: F.unix_seconds(F.try_to_timestamp(F.replace(c, F.lit("Z"), F.lit("+00:00")), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))
    low, high = r.getField("from_block"), r.getField("to_block")
    t0, t1 = r.getField("from_timestamp"), r.getField("to_timestamp")
    block = (req.getField("from").cast("string") == low.cast("string")) & (req.getField("to").cast("string") == high.cast("string"))
    time = (utc(req.getField("normalized_from_utc")) <= t0) & (t1 <= utc(req.getField("normalized_to_utc")))
    of_kind = lambda keys: F.col("asked") == F.array(*(F.lit(k) for k in keys))
    rules = {
        "canonical": F.col("canonical"),
        "keys": F.col("keys") == F.array(*(F.lit(k) for k in MANIFEST_KEYS)),
        "dataset_id": F.col("m.dataset_id").rlike(UUID4) & F.col("file").contains(F.col("m.dataset_id")),
        "tool_version": F.length("m.tool_version") > 0,
        "chain": F.col("part.chain") & F.col("m.chain.name").rlike(NAME) & (F.col("m.chain.chain_id") > 0),
        "source": F.element_at("m.source", "kind").rlike(NAME) & F.forall(F.map_values("m.source"), lambda x: F.length(x) > 0),
        "resolved_range": F.col("part.resolved_range") & (low >= 0) & (low <= high) & (t0 >= 0) & (t0 <= t1),
        "requested_range": F.when(req.getField("kind") == "block", of_kind(("from", "kind", "to")) & block).when(req.getField("kind") == "time", of_kind(("from", "kind", "normalized_from_utc", "normalized_to_utc", "to")) & time).otherwise(F.lit(False)),
        "row_count": F.col("m.row_count") == high - low + 1,
        "schema": (F.size(features) > 0) & (F.col("m.schema") == columns),
        "acquisition_plan": F.col("part.acquisition_plan") & (F.col("m.acquisition_plan.features") == features) & (F.col("m.acquisition_plan.hidden") == hidden),
        "output": F.col("part.output") & F.col("m.output.format").isin("parquet", "csv") & F.forall("m.output.files", lambda f: (F.length(f.getField("name")) > 0) & f.getField("sha256").rlike(r"^[0-9a-f]{64}\z") & (f.getField("bytes") >= 0)),
        "target_hash": F.col("m.target_hash").rlike(HASH),
        "anchor": F.col("part.finalized_anchor") & (a.getField("block_number") >= high) & a.getField("block_hash").rlike(HASH) & a.getField("tag").isin("finalized", "safe"),
        "completed_at": F.col("m.completed_at").endswith("Z") & utc(F.col("m.completed_at")).isNotNull(),
        "samples": (v.getField("sampled_blocks") == F.array_sort(agree.sampled(F.col("m.dataset_id"), low, high))),
        "verification": F.col("part.verification") & v.getField("target_agreement") & (v.getField("verifier_chain_id") == F.col("m.chain.chain_id")),
    }
    sound = (low >= 0) & (low <= high) & F.col("m.dataset_id").rlike(UUID4)  # without these no sample can be told
    rules["samples"] = F.when(F.coalesce(sound, F.lit(False)), rules["samples"])
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    named = F.coalesce("m.dataset_id", F.element_at(F.split("file", "/"), -2))
    return rows.select(named.alias("dataset_id"), F.when(F.col("keys").isNull(), "json").otherwise(F.array_join(F.array_compact(F.array(*broken)), ",")).alias("faults"))


def bind_staging(spark: SparkSession, path: str, request: dict) -> None:
    """Tie a staging folder to one request (range, features, source and so on).

    The first call writes it down beside the folder; later ones raise if the request is another, so
    that chunks of different requests never mix.
    """
    fs, at = _fs(spark, f"{path.rstrip('/')}.binding.json")
    text = canonical_json(request)
    if fs.exists(at):
        if spark.read.text(str(at), wholetext=True).first()[0] != text:
            raise DatasetError("RESUME_MISMATCH", "the staging folder belongs to another request")
        return
    out = fs.create(at, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


LOG = "batch string, chunk_id bigint, from_block bigint, to_block bigint, row_count bigint, repeats bigint, link_faults bigint, first_parent string, first_timestamp bigint, last_hash string, last_timestamp bigint, file string, bytes bigint, sha256 string, seq int"


def chunk_log(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The last entry of each staged chunk (of those from low to high): bounds, counts, edges, and the file that holds it with its size and digest."""
    if not _exists(spark, f"{path}/log"):
        return spark.createDataFrame([], LOG)
    entries = spark.read.schema(LOG).parquet(f"{path}/log")
    if low is not None:
        entries = entries.where(F.col("chunk_id").between(low, high))
    last = F.max_by(F.struct(*(c for c in entries.columns if c != "chunk_id")), "seq")
    return entries.groupBy("chunk_id").agg(last.alias("x")).select("chunk_id", "x.*")


def staged_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all staged chunks, each as it was staged last."""
    data = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data").drop("pack")
    return data.join(chunk_log(spark, path).select("chunk_id", "batch"), ["chunk_id", "batch"], "left_semi").drop("chunk_id", "batch")


def stage_chunks(df: DataFrame, path: str, first: int, size: int = CHUNK_SIZE, per_file: int = CHUNKS_PER_FILE) -> None:
    """Stage rows (with proofs) by chunks, many chunks to a file, and enter each chunk in the log.

    The log is append-only: an entry has the chunk's bounds and counts, the hashes at its edges, and
    the file with its digest. A chunk that is staged again gets a new entry, and its former rows are
    passed over from then on. Chunks must link to the neighbours that the log has already, else
    nothing is entered; only the entries of these neighbours are read, never staged rows, so the
    cost is that of the new chunks. An edge that a chunk had before is not judged again: a break
    that the log has already is no fault of the call, and `chunk_states` tells of it.
    """
    if not {"_proof_hash", "_proof_parent_hash", "_proof_timestamp"} <= set(df.columns):
        raise DatasetError("CHUNK_PROOFS", "chunks are staged with their proof columns")
    spark = df.sparkSession
    fs, at = _fs(spark, f"{path}/log")
    seq = 1 + max((int(f.getPath().getName().removeprefix("seq=")) for f in fs.listStatus(at) if f.getPath().getName().startswith("seq=")), default=-1) if fs.exists(at) else 0
    batch = f"{seq}-{uuid.uuid4().hex}"
    chunked = with_chunk_id(df, first, size).withColumn("pack", F.floor(F.col("chunk_id") / per_file).cast("bigint"))
    chunked.repartition("pack").sortWithinPartitions("pack", KEY).write.partitionBy("pack").parquet(f"{path}/data/batch={batch}")
    back = spark.read.schema(chunked.schema).parquet(f"{path}/data/batch={batch}").select("chunk_id", KEY, "_proof_hash", "_proof_parent_hash", "_proof_timestamp", F.regexp_extract("_metadata.file_path", r"(pack=-?\d+/[^/]+)\z", 1).alias("file"))
    entries = stored(_entries(back).join(_named_digests(spark, f"{path}/data/batch={batch}"), "file").withColumn("batch", F.lit(batch)))
    edges = entries.agg(F.min("chunk_id"), F.max("chunk_id")).first()
    if edges[0] is None:
        _delete(spark, f"{path}/data/batch={batch}")
        return
    logged = chunk_log(spark, path, edges[0] - 1, edges[1] + 1)
    near = logged.join(entries, "chunk_id", "left_anti")
    below, above = (_changed(entries, logged, edge) for edge in (("from_block", "first_parent", "first_timestamp"), ("to_block", "last_hash", "last_timestamp")))
    if not _unlinked(below, near).unionByName(_unlinked(near, above)).isEmpty():
        _delete(spark, f"{path}/data/batch={batch}")
        raise DatasetError("CHUNK_LINK", "a chunk does not follow the one staged before it")
    entries.coalesce(1).write.parquet(f"{path}/log/seq={seq}")  # one row per chunk


def _entries(rows: DataFrame) -> DataFrame:
    """One row per chunk: what the log has of it but for the file's digest."""
    from pyspark.sql import Window

    before = F.lag(F.struct(KEY, "_proof_hash", "_proof_timestamp")).over(Window.partitionBy("chunk_id").orderBy(KEY))
    number, hash_, time = (F.col(f"before.{c}") for c in (KEY, "_proof_hash", "_proof_timestamp"))
    faulty = (number == F.col(KEY) - 1) & (~F.col("_proof_parent_hash").eqNullSafe(hash_) | (F.col("_proof_timestamp") < time))
    return rows.withColumn("before", before).groupBy("chunk_id").agg(
        F.min(KEY).alias("from_block"), F.max(KEY).alias("to_block"), F.count(F.lit(1)).alias("row_count"), F.count_if(number == F.col(KEY)).alias("repeats"), F.count_if(faulty).alias("link_faults"),
        F.min_by("_proof_parent_hash", KEY).alias("first_parent"), F.min_by("_proof_timestamp", KEY).alias("first_timestamp"), F.max_by("_proof_hash", KEY).alias("last_hash"), F.max_by("_proof_timestamp", KEY).alias("last_timestamp"), F.first("file").alias("file"),
    )


def _named_digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) of the data files below a folder, by their names from there."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.regexp_extract("path", r"(pack=-?\d+/[^/]+)\z", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def _changed(entries: DataFrame, logged: DataFrame, edge: tuple[str, ...]) -> DataFrame:
    """entries but for those that the log has with the same edge."""
    former = logged.select("chunk_id", F.struct(*edge).alias("former"))
    return entries.join(former, "chunk_id", "left").where(~F.struct(*edge).eqNullSafe(F.col("former"))).drop("former")


def _unlinked(chunks: DataFrame, others: DataFrame) -> DataFrame:
    """chunks whose first block has the number after the last one of the chunk before, among others, and does not follow it."""
    before = others.select((F.col("chunk_id") + 1).alias("chunk_id"), F.col("to_block").alias("end"), F.col("last_hash").alias("end_hash"), F.col("last_timestamp").alias("end_timestamp"))
    met = chunks.join(before, "chunk_id").where("from_block = end + 1")
    return met.where("not (first_parent <=> end_hash) or first_timestamp < end_timestamp").select("chunk_id")


def chunk_states(spark: SparkSession, path: str, first: int, last: int, size: int = CHUNK_SIZE) -> DataFrame:
    """(chunk_id, from_block, to_block, state, usable) of every planned chunk, to resume from.

    state is absent, changed (its file is gone, or has other bytes than when it was staged),
    incomplete (rows are missing, repeated or outside), broken (a link inside it or to the chunk
    before it does not hold) or complete. usable is 1 for complete chunks with only complete ones
    before them. The log and the files' digests are read, no row is.
    """
    log = chunk_log(spark, path)
    now = spark.createDataFrame([], "batch string, file string, now_bytes bigint, now_sha256 string")
    if _exists(spark, f"{path}/data"):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{path}/data")
        now = files.select(F.regexp_extract("path", r"batch=([^/]+)/", 1).alias("batch"), F.regexp_extract("path", r"(pack=-?\d+/[^/]+)\z", 1).alias("file"), F.col("length").alias("now_bytes"), F.sha2("content", 256).alias("now_sha256"))
    unlinked = _unlinked(log, log).withColumn("unlinked", F.lit(True))
    judged = log.join(now, ["batch", "file"], "left").join(unlinked, "chunk_id", "left")
    plan = planned_chunks(spark, first, last, size).join(judged.withColumnsRenamed({"from_block": "low", "to_block": "high"}), "chunk_id", "left")
    same = F.coalesce((F.col("bytes") == F.col("now_bytes")) & (F.col("sha256") == F.col("now_sha256")), F.lit(False))
    whole = (F.col("low") == F.col("from_block")) & (F.col("high") == F.col("to_block")) & (F.col("repeats") == 0) & (F.col("row_count") == F.col("to_block") - F.col("from_block") + 1)
    state = F.when(F.col("batch").isNull(), "absent").when(~same, "changed").when(~whole, "incomplete").when((F.col("link_faults") > 0) | F.col("unlinked").isNotNull(), "broken").otherwise("complete")
    states = stored(plan.select("chunk_id", "from_block", "to_block", state.alias("state")))
    stop = states.where("state <> 'complete'").agg(F.min("chunk_id")).first()[0]
    return states.withColumn("usable", (F.lit(True) if stop is None else F.col("chunk_id") < stop).cast("bigint"))


def missing_chunks(staged: DataFrame, first: int, last: int, size: int = CHUNK_SIZE) -> DataFrame:
    """Planned chunks that are not staged complete: chunk_id, from_block, to_block. See usable_prefix."""
    have = chunk_bounds(staged, first, size).where("row_count = distinct_blocks and row_count = to_block - from_block + 1")
    plan = planned_chunks(staged.sparkSession, first, last, size)
    gone = plan.join(have.select("chunk_id", "from_block", "to_block"), ["chunk_id", "from_block", "to_block"], "left_anti")
    return gone.select("chunk_id", "from_block", "to_block")


def usable_prefix(missing: DataFrame, chunks: int) -> int:
    """How many chunks from the start are complete."""
    least = missing.agg(F.min("chunk_id")).first()[0]
    return chunks if least is None else least


def assemble(staged: DataFrame, plan: Selection) -> DataFrame:
    """Staged chunks as one dataset in block order, without proofs."""
    return without_proofs(staged).select(*plan.columns).orderBy(KEY)


def run_receipt(staged: DataFrame, first: int, last: int, reused_chunks: int, size: int = CHUNK_SIZE) -> DataFrame:
    """One row: row_count, reused_rows, acquired_rows, first and last hash of the range."""
    at = with_chunk_id(staged.where(F.col(KEY).between(first, last)), first, size)
    reused = F.count_if(F.col("chunk_id") < reused_chunks)
    n = F.count(F.lit(1))
    return at.agg(n.alias("row_count"), reused.alias("reused_rows"), (n - reused).alias("acquired_rows"), F.min_by("block_hash", KEY).alias("first_hash"), F.max_by("block_hash", KEY).alias("target_hash"))
