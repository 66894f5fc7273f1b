"""Agreement of a dataset with an independent copy of the chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.catalog import KEY
from ..sources.scratch import stored
from .canonical import canonical_chain
from .checks import link_violations

#: Consecutive numbers in a leaf of a digest tree (32,768 at most), and nodes below another.
LEAF_BLOCKS = 1024
FANOUT = 64


def sampled(dataset_id: Column, first: Column, last: Column, inner: int = 3) -> Column:
    """The numbers of the first and last block, and of up to `inner` between, seeded by the id; first and last must be there, and in order.

    The seed is the first eight bytes of the SHA-256 of the id's bytes; the inner blocks are
    consecutive from there, wrapping round.
    """
    digest = F.sha2(F.try_to_binary(F.replace(dataset_id, F.lit("-"), F.lit("")), F.lit("hex")), 256)
    seed = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    width = last - first - 1
    steps = F.when(width > 0, F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(inner).cast("bigint"), F.greatest(width, F.lit(1))) - 1)).otherwise(F.array().cast("array<bigint>"))
    between = F.transform(steps, lambda i: first + 1 + ((seed + i) % F.greatest(width, F.lit(1))).cast("bigint"))
    return F.array_distinct(F.concat(F.array(first, last), between))


def sample_numbers(datasets: DataFrame, inner: int = 3) -> DataFrame:
    """(dataset_id, block_number) of the blocks that `sampled` names; datasets has dataset_id (a UUID), first_block and last_block."""
    return datasets.select("dataset_id", F.explode(sampled(F.col("dataset_id"), F.col("first_block"), F.col("last_block"), inner)).alias(KEY))


def rows_at(df: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows with the given block numbers."""
    return df.join(numbers.select(KEY).distinct(), KEY, "left_semi")


def missing_at(df: DataFrame, numbers: DataFrame) -> DataFrame:
    """The given block numbers that have no row."""
    return numbers.select(KEY).distinct().join(df, KEY, "left_anti")


def _packed(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    return df.select(KEY, F.struct(*columns).alias(name))


def _reason(columns: list[str]) -> Column:
    """Missing there, missing here, or the first column in which ours and theirs differ; null if they agree."""
    differs: list[Column] = [F.when(~F.col(f"ours.{c}").eqNullSafe(F.col(f"theirs.{c}")), F.lit(c)) for c in columns]
    return F.coalesce(F.when(F.col("theirs").isNull(), F.lit("missing_there")), F.when(F.col("ours").isNull(), F.lit("missing_here")), *differs)


def _differences(a: DataFrame, b: DataFrame, columns: list[str], how: str) -> DataFrame:
    """(block_number, reason): missing here, missing there, or the first column that differs."""
    both = _packed(a, columns, "ours").join(_packed(b, columns, "theirs"), KEY, how)
    return both.select(KEY, _reason(columns).alias("reason")).where("reason is not null")


def compare_sample(df: DataFrame, verifier: DataFrame, sample: DataFrame) -> DataFrame:
    """Differences in any column of the dataset at the sampled blocks; a block absent from both is missing_there.

    Each copy is read once and looked up from the sampled numbers.
    """
    columns = [c for c in df.columns if c != KEY]
    asked = sample.select(KEY).distinct()
    met = asked.join(_packed(df, columns, "ours"), KEY, "left").join(_packed(verifier, columns, "theirs"), KEY, "left")
    return met.select(KEY, _reason(columns).alias("reason")).where("reason is not null")


def digest_tree(df: DataFrame, first: int, last: int, size: int = LEAF_BLOCKS, fanout: int = FANOUT) -> DataFrame:
    """(level, node, rows, numbers, digest) of a tree of digests over the rows of first..last, stored.

    A leaf (level 0) stands for `size` consecutive numbers; its digest is of sums of pieces of its
    rows' SHA-256, so rows are added up where they are and never gathered. rows counts them, numbers
    counts the different block numbers. Each node above is the digest of up to `fanout` nodes below;
    the last level is the root. Copies with equal rows have equal digests, whatever the rows' order.
    """
    offset = F.col(KEY) - first
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    pieces = [F.conv(F.substring(row, 1 + 11 * k, 11), 16, 10).cast("bigint") for k in range(3)]  # 44 bits each, so that sums fit
    rows = df.where(F.col(KEY).between(first, last)).select(F.floor(offset / size).cast("bigint").alias("node"), (offset % size + 1).alias("at"), *(p.alias(f"p{k}") for k, p in enumerate(pieces)))
    sums = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("at"))).alias("numbers"), *(F.sum(f"p{k}").alias(f"p{k}") for k in range(3)))
    level = stored(sums.select(F.lit(0).alias("level"), "node", "rows", "numbers", F.sha2(F.concat_ws(":", "rows", "p0", "p1", "p2"), 256).alias("digest")))
    tree, nodes = level, (last - first) // size + 1
    while nodes > 1:
        nodes = -(-nodes // fanout)
        below = F.array_sort(F.collect_list(F.struct("node", "digest")))  # `fanout` at most
        level = level.groupBy((F.col("level") + 1).alias("level"), F.floor(F.col("node") / fanout).alias("node")).agg(F.sum("rows").alias("rows"), F.sum("numbers").alias("numbers"), F.sha2(F.to_json(below), 256).alias("digest"))
        tree = tree.unionByName(level)
    return stored(tree)


def differing_leaves(a: DataFrame, b: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(node) of the leaves whose digests differ, or that one tree lacks: from the roots down, looking only below nodes that differ."""
    top = a.unionByName(b).agg(F.max("level")).first()[0]
    below = None
    for level in reversed(range((top or 0) + 1)):
        mine, theirs = (t.where(F.col("level") == level).select("node", F.col("digest").alias(c)) for t, c in ((a, "mine"), (b, "theirs")))
        both = mine.join(theirs, "node", "full_outer").where("not (mine <=> theirs)").select("node")
        if below is not None:
            both = both.withColumn("parent", F.floor(F.col("node") / fanout)).join(below.withColumnRenamed("node", "parent"), "parent", "left_semi").select("node")
        below = stored(both)
    return below


def compare_full(df: DataFrame, verifier: DataFrame, first: int, last: int, size: int = LEAF_BLOCKS) -> DataFrame:
    """Differences over all blocks of first..last, and breaks in the verifier's own chain (verifier_<reason>).

    Every block of the range is looked for in both copies, so one that both lack is found, at the
    range's edges too (missing_there). Rows outside the range are not compared. Both copies are
    digested where they are; only the rows of leaves of the digest trees that differ are exchanged
    and compared column by column, and only leaves without all their numbers are searched for lost blocks.
    """
    columns = [c for c in df.columns if c != KEY]
    ours, theirs = (x.where(F.col(KEY).between(first, last)).select(KEY, *columns) for x in (df, verifier))
    links = link_violations(verifier.where(F.col(KEY).between(first, last))).select(KEY, F.concat(F.lit("verifier_"), F.col("reason")).alias("reason"))
    trees = [digest_tree(x, first, last, size) for x in (ours, theirs)]
    at = lambda x: x.withColumn("node", F.floor((F.col(KEY) - first) / size).cast("bigint"))
    within = lambda x, nodes: at(x).join(nodes, "node", "left_semi").drop("node")
    leaves = differing_leaves(*trees)
    found = _differences(within(ours, leaves), within(theirs, leaves), columns, "full_outer")
    spark = df.sparkSession
    want = spark.range(0, (last - first) // size + 1).select(F.col("id").alias("node"), F.least(F.lit(size), F.lit(last - first + 1) - F.col("id") * size).alias("want"))
    have = trees[0].unionByName(trees[1]).where("level = 0").groupBy("node").agg(F.max("numbers").alias("have"))
    short = stored(want.join(have, "node", "left").where("coalesce(have, 0) < want").select("node"))
    planned = short.select(F.explode(F.sequence(F.lit(first) + F.col("node") * size, F.least(F.lit(first) + (F.col("node") + 1) * size - 1, F.lit(last).cast("bigint")))).alias(KEY))
    neither = planned.join(within(ours, short).select(KEY), KEY, "left_anti").join(within(theirs, short).select(KEY), KEY, "left_anti")
    return found.unionByName(links).unionByName(neither.select(KEY, F.lit("missing_there").alias("reason")))


def core_mismatches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differences in hash, parent hash and time, and blocks that only one side has."""
    return _differences(a, b, ["block_hash", "parent_hash", "timestamp"], "full_outer")


def ancestry_breaks(chain: DataFrame, target: int, target_hash: str, anchor: int, anchor_hash: str) -> DataFrame:
    """(block_number, reason): what breaks the line from the target to the anchor, both included; no rows if it holds.

    The chain may hold forks: the branch that leads down from the anchor, and from heights with a
    single header, is judged, and the others are left aside.
    """
    span = chain.where(F.col(KEY).between(target, anchor)).select(KEY, "block_hash", "parent_hash", "timestamp")
    line = canonical_chain(span, anchor, anchor_hash, uncontested=True)
    # Another header at the anchor's height is a fault, not a fork that could be left aside.
    top = span.where(F.col(KEY) == anchor)
    line = stored(line.where(F.col(KEY) < anchor).unionByName(top.orderBy((F.col("block_hash") == anchor_hash).desc()).limit(1)))
    links = link_violations(line).where(F.col(KEY) > target)
    edge = line.agg(F.count(F.lit(1)).alias("n"), F.max_by("block_hash", KEY).alias("top"), F.min_by("block_hash", KEY).alias("low"))
    faults = F.array_compact(
        F.array(
            F.when(F.col("n") != anchor - target + 1, F.struct(F.lit(anchor).cast("bigint").alias(KEY), F.lit("coverage").alias("reason"))),
            F.when(~F.col("top").eqNullSafe(F.lit(anchor_hash)), F.struct(F.lit(anchor).cast("bigint").alias(KEY), F.lit("anchor").alias("reason"))),
            F.when(~F.col("low").eqNullSafe(F.lit(target_hash)), F.struct(F.lit(target).cast("bigint").alias(KEY), F.lit("target").alias("reason"))),
        )
    )
    return links.unionByName(edge.select(F.explode(faults).alias("x")).select("x.*"))


def refresh_anchor(chain: DataFrame, target: int, target_hash: str, anchor: int, anchor_hash: str, head: int, head_hash: str | None = None) -> DataFrame:
    """One row: block_number and block_hash of the new anchor, and refreshed (1 or 0).

    The stored anchor must still have its hash, the head must not be behind it, and the line from
    the target to the anchor and on to the head must hold. Of several headers at the head's height,
    head_hash names the one that is final; without it there must be just one.
    """
    tops = [r[0] for r in chain.where(F.col(KEY) == head).select("block_hash").distinct().limit(2).collect()]
    top = head_hash if head_hash is not None else tops[0] if tops else None
    new = chain.where((F.col(KEY) == head) & (F.col("block_hash") == top)).select(KEY, "block_hash").limit(1)
    if top is None or head < anchor or (head_hash is None and len(tops) > 1):
        return new.withColumn("refreshed", F.lit(0).cast("bigint"))
    broken = ancestry_breaks(chain, target, target_hash, anchor, anchor_hash).unionByName(ancestry_breaks(chain, anchor, anchor_hash, head, top)).count()
    return new.select(KEY, "block_hash", F.lit(int(broken == 0)).cast("bigint").alias("refreshed"))
