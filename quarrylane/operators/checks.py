"""Checks of built datasets. Each returns violations or one summary row; `assert_clean` raises on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import is_hash
from ..plans.catalog import BY_NAME, KEY, DatasetError

#: Numbers in a range; inside it rows are sorted and windowed, between ranges only edges meet.
LINK_SLICE = 4096


def _domain(columns: list[str]) -> Column:
    """Whether a row's values lie in their domains; nulls are the null counts' business."""
    ok = F.col(KEY) >= 0
    for name in columns:
        feature = BY_NAME.get(name)
        if feature is None:
            continue
        c = F.col(name)
        fits = is_hash(c) if feature.kind == "UTF-8" else c > 0 if feature.positive else c >= 0
        ok = ok & (c.isNull() | fits)
    if {"gas_used", "gas_limit"} <= set(columns):
        ok = ok & F.coalesce(F.col("gas_used") <= F.col("gas_limit"), F.lit(True))
    return F.coalesce(ok, F.lit(True))


def domain_violations(df: DataFrame) -> DataFrame:
    """Block numbers whose values are out of their domains."""
    return df.where(~_domain(df.columns)).select(KEY)


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls of each column, under the column's name."""
    return df.agg(*(F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in df.columns))


def contiguity(df: DataFrame, first: int, last: int) -> DataFrame:
    """One row: row_count, first_block, last_block, repeats, and whether the blocks are exactly first..last."""
    n, distinct = F.count(F.lit(1)), F.count_distinct(KEY)
    low, high = F.min(KEY), F.max(KEY)
    exact = (n == last - first + 1) & (distinct == n) & (low == first) & (high == last)
    return df.agg(n.alias("row_count"), low.alias("first_block"), high.alias("last_block"), (n - distinct).alias("repeats"), F.coalesce(exact, F.lit(False)).cast("bigint").alias("exact"))


def _sliced(df: DataFrame, size: int) -> DataFrame:
    """df with `slice`, the range of `size` numbers of its row. Rows without a number keep to themselves, by partition."""
    alone = F.lit(-(1 << 62)) - F.spark_partition_id().cast("bigint")
    return df.withColumn("slice", F.coalesce(F.floor(F.col(KEY) / size).cast("bigint"), alone))


def _in_slice() -> WindowSpec:
    return Window.partitionBy("slice").orderBy(KEY)


def _after(slices: DataFrame) -> DataFrame:
    """Slices with `before`, the last row of the slice before: a window over one row per slice, all slices of a chain in one group."""
    return slices.withColumn("before", F.lag("last").over(Window.partitionBy(F.shiftright("slice", 51)).orderBy("slice")))


def with_predecessors(df: DataFrame, own: list[str], earlier: list[str], size: int = LINK_SLICE) -> DataFrame:
    """The number and `own` columns of each row, and `before`: a struct of number and `earlier` columns of the row before it.

    One exchange by ranges of numbers and one sort; inside a range the row before is a window's,
    and between ranges only their first and last rows meet. before is null for the very first row.
    Rows without a number are left out.
    """
    rows = _sliced(df.where(F.col(KEY).isNotNull()).select(KEY, *dict.fromkeys([*own, *earlier])), size)
    inside = rows.withColumn("before", F.lag(F.struct(KEY, *earlier)).over(_in_slice()))
    ends = inside.groupBy("slice").agg(F.min_by(F.struct(KEY, *own), KEY).alias("first"), F.max_by(F.struct(KEY, *earlier), KEY).alias("last"))
    heads = _after(ends).select("first.*", "before")
    return inside.where("before is not null").select(KEY, *own, "before").unionByName(heads)


def _broken_link(before: str = "before") -> Column:
    """repeat, gap, parent or time: how a row fails to follow the one before it; null if it follows or is the first."""
    previous = lambda c: F.col(f"{before}.{c}")
    reason = F.when(previous(KEY) == F.col(KEY), "repeat").when(previous(KEY) != F.col(KEY) - 1, "gap").when(~F.col("parent_hash").eqNullSafe(previous("block_hash")), "parent").when(F.col("timestamp") < previous("timestamp"), "time")
    return F.when(F.col(before).isNotNull(), reason)


def link_violations(df: DataFrame, size: int = LINK_SLICE) -> DataFrame:
    """Blocks that do not follow the block before them: block_number and reason (repeat, gap, parent, time)."""
    rows = with_predecessors(df, ["parent_hash", "timestamp"], ["block_hash", "timestamp"], size)
    return rows.select(KEY, _broken_link().alias("reason")).where("reason is not null")


def time_violations(df: DataFrame, first_timestamp: int | None = None, last_timestamp: int | None = None) -> DataFrame:
    """Blocks earlier than the block before them (decreases), and edges whose time is not as resolved (edge)."""
    rows = with_predecessors(df, ["timestamp"], ["timestamp"])
    falls = rows.where(f"before.{KEY} = {KEY} - 1 and timestamp < before.timestamp").select(KEY, F.lit("decreases").alias("reason"))
    edges = df.select(KEY, "timestamp").agg(F.min(KEY).alias("a"), F.max(KEY).alias("b"), F.min_by("timestamp", KEY).alias("ta"), F.max_by("timestamp", KEY).alias("tb"))
    points = edges.select(F.explode(F.array(F.struct(F.col("a").alias(KEY), F.col("ta").alias("t"), F.lit(first_timestamp).cast("bigint").alias("want")), F.struct(F.col("b").alias(KEY), F.col("tb").alias("t"), F.lit(last_timestamp).cast("bigint").alias("want")))).alias("x")).select("x.*")
    wrong = points.where("want is not null and not (t <=> want)").select(KEY, F.lit("edge").alias("reason"))
    return falls.unionByName(wrong)


def slice_summaries(df: DataFrame, size: int = LINK_SLICE) -> DataFrame:
    """One row per range of `size` numbers: counts of rows, nulls, domain faults, repeats and broken links, and the first and last row.

    Two such rows of neighbouring ranges can be merged (`merged_summary`) without their rows: counts
    add up, and the link between the ranges is judged by the edge rows.
    """
    linked = [c if c in df.columns else None for c in ("block_hash", "parent_hash", "timestamp")]
    edge = F.struct(F.col(KEY), *((F.col(c) if c else F.lit(None).cast("string" if "hash" in name else "bigint")).alias(name) for c, name in zip(linked, ("block_hash", "parent_hash", "timestamp"), strict=True)))
    rows = _sliced(df, size).withColumn("edge", edge).withColumn("before", F.lag("edge").over(_in_slice()))
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.col(c).isNull().cast("int")
    broken = _broken_link() if None not in linked else F.lit(None).cast("string")
    numbered = F.col(KEY).isNotNull()
    return rows.groupBy("slice").agg(
        F.count(F.lit(1)).alias("row_count"), F.count(KEY).alias("numbered"), F.sum(nulls).cast("bigint").alias("null_values"), F.count_if(~_domain(df.columns)).alias("domain_faults"),
        F.count_if(numbered & (F.col(f"before.{KEY}") == F.col(KEY))).alias("repeats"), F.count_if(numbered & broken.isNotNull()).alias("link_faults"), F.min_by("edge", KEY).alias("first"), F.max_by("edge", KEY).alias("last"),
    )


def merged_summary(slices: DataFrame, links: bool) -> DataFrame:
    """One row for all ranges: the sums of their counts, with the links between ranges if these count, and the first and last row of all."""
    between = _after(slices.where("first is not null")).select("first.*", "before").select(_broken_link().alias("reason"))
    faults = between.agg(F.count_if(F.col("reason").isNotNull()).alias("between")) if links else None
    sums = slices.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("row_count", "numbered", "null_values", "domain_faults", "repeats", "link_faults")), F.min_by("first", f"first.{KEY}").alias("first"), F.max_by("last", f"last.{KEY}").alias("last"))
    if faults is None:
        return sums
    both = sums.withColumn("between", F.lit(0).cast("bigint")).unionByName(faults, allowMissingColumns=True)  # two rows
    columns = [c for c in sums.columns if c not in ("first", "last")]
    merged = both.agg(*(F.max(c).alias(c) for c in columns), F.max("between").alias("between"), F.max("first").alias("first"), F.max("last").alias("last"))
    return merged.withColumn("link_faults", F.col("link_faults") + F.col("between")).drop("between")


def dataset_summary(df: DataFrame, first: int, last: int, target_hash: str | None = None, times: tuple[int, int] | None = None) -> DataFrame:
    """One row with everything that can be wrong with a dataset, as counts; exact, target_ok and times_ok are 1 or 0.

    Whatever columns there are is checked: links need hash, parent hash and time, the target needs
    the hash, and times (the first and the last block's) need the time. The table is scanned once
    and exchanged once, by ranges of numbers; no row meets another one by a join.
    """
    linked = {"block_hash", "parent_hash", "timestamp"} <= set(df.columns)
    found = merged_summary(slice_summaries(df), linked)
    low, high = F.col("first"), F.col("last")
    exact = (F.col("row_count") == last - first + 1) & (F.col("numbered") == F.col("row_count")) & (F.col("repeats") == 0) & (low[KEY] == first) & (high[KEY] == last)
    target = high["block_hash"].eqNullSafe(F.lit(target_hash)) if target_hash is not None and "block_hash" in df.columns else F.lit(True)
    dated = low["timestamp"].eqNullSafe(F.lit(times[0])) & high["timestamp"].eqNullSafe(F.lit(times[1])) if times is not None and "timestamp" in df.columns else F.lit(True)
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    return found.select("row_count", "domain_faults", "null_values", yes(exact).alias("exact"), yes(target).alias("target_ok"), yes(dated).alias("times_ok"), "link_faults")


def observed_facts(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df, and what the job that evaluates it will have seen of its rows: counts, edges, nulls and values out of their domains.

    The facts come with that job itself; nothing is evaluated for them alone.
    """
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.col(c).isNull().cast("int")
    edges = {}
    if "timestamp" in df.columns:
        edges |= {"from_timestamp": F.min_by("timestamp", KEY), "to_timestamp": F.max_by("timestamp", KEY)}
    if "block_hash" in df.columns:
        edges["target_hash"] = F.max_by("block_hash", KEY)
    seen = Observation()
    facts = {"row_count": F.count(F.lit(1)), "from_block": F.min(KEY), "to_block": F.max(KEY), "null_values": F.coalesce(F.sum(nulls), F.lit(0)), "domain_faults": F.count_if(~_domain(df.columns))} | edges
    return df.observe(seen, *(c.alias(k) for k, c in facts.items())), seen


def assert_observed(facts: dict, asked: tuple[int, int] | None = None) -> None:
    """Raise the code of the first thing that observed facts show to be wrong; asked is the range that the rows must cover."""
    span = asked or (facts["from_block"], facts["to_block"])
    covered = facts["row_count"] > 0 and (facts["from_block"], facts["to_block"]) == tuple(span) and facts["row_count"] == span[1] - span[0] + 1
    for bad, code in ((facts["null_values"], "DATASET_NULLS"), (facts["domain_faults"], "DATASET_DOMAIN"), (not covered, "DATASET_RANGE")):
        if bad:
            raise DatasetError(code, f"the rows are not valid: {facts}")


def assert_clean(summary: DataFrame) -> None:
    """Raise the code of the first thing that a summary row finds wrong."""
    row = summary.first()
    for bad, code in ((row["null_values"], "DATASET_NULLS"), (row["domain_faults"], "DATASET_DOMAIN"), (not row["exact"], "DATASET_RANGE"), (row["link_faults"], "DATASET_LINKS"), (not row["target_ok"], "DATASET_TARGET"), (not row["times_ok"], "DATASET_TIMES")):
        if bad:
            raise DatasetError(code, f"the dataset is not valid: {row.asDict()}")


def assert_coverage(built: DataFrame, first: int, last: int, times: tuple[int, int] | None = None) -> None:
    """Raise unless a built result has exactly the blocks first..last, without nulls and inside its domains."""
    assert_clean(dataset_summary(built, first, last, None, times))


def proof_mismatches(staged: DataFrame) -> DataFrame:
    """Rows whose proof columns are null, differ from the published column they prove, or prove gas to be impossible or receipts incomplete."""
    pairs = {"_proof_hash": "block_hash", "_proof_parent_hash": "parent_hash", "_proof_timestamp": "timestamp", "_proof_gas_used": "gas_used", "_proof_gas_limit": "gas_limit"}
    bad = F.lit(False)
    for proof, name in pairs.items():
        if proof in staged.columns:
            bad = bad | F.col(proof).isNull()
            if name in staged.columns:
                bad = bad | ~F.col(proof).eqNullSafe(F.col(name))
    if {"_receipt_gas_used", "_proof_gas_used"} <= set(staged.columns):
        bad = bad | ~F.col("_receipt_gas_used").eqNullSafe(F.col("_proof_gas_used"))
    if {"_proof_gas_used", "_proof_gas_limit"} <= set(staged.columns):
        bad = bad | F.coalesce((F.col("_proof_gas_limit") <= 0) | (F.col("_proof_gas_used") > F.col("_proof_gas_limit")), F.lit(False))
    return staged.where(bad).select(KEY)
