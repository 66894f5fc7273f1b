"""The canonical chain among forks: headers by hash, walked back from an anchor.

Headers land in any order and of any branch, and several can share a height. The line is what the
anchor's parent pointers lead through. Stretches of heights with a single header each, all linked,
collapse to one pointer first; only the ends of stretches and the headers of contested heights are
walked, by pointer doubling: with each join the pointers reach twice as far, so the number of joins
is the logarithm of the number of forks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import packed_hash
from ..plans.catalog import KEY
from ..sources.scratch import stored

#: Heights per slice: a slice's headers are compared with their neighbours in one task, and no stretch is longer.
SLICE = 4096
#: 2^64 pointers; more rounds would mean a cycle, which parent hashes one height down can't form.
MAX_ROUNDS = 64


def _nodes(headers: DataFrame) -> DataFrame:
    """(low, k, high, hash, parent, contested) of each node: a linked stretch of heights with one header each, or a header of a contested height.

    low and k name the node: its lowest height, and the place of its hash among those there. hash is
    its highest header's, parent its lowest one's, both packed. Headers are moved once, to their slices;
    of those inside a stretch nothing is kept.
    """
    n = F.col(KEY)
    dealt = headers.select(KEY, packed_hash(F.col("block_hash")).alias("hash"), packed_hash(F.col("parent_hash")).alias("parent"), F.floor(n / SLICE).alias("slice")).repartition("slice").distinct()
    order = Window.partitionBy("slice").orderBy(KEY, "hash", "parent")
    near = {"n_1": F.lag(KEY, 1), "n_2": F.lag(KEY, 2), "n1": F.lead(KEY, 1), "n2": F.lead(KEY, 2), "hash_1": F.lag("hash", 1), "parent1": F.lead("parent", 1)}
    seen = dealt.withColumns({name: c.over(order) for name, c in near.items()})
    other = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    single = other("n_1", KEY) & other("n1", KEY)
    down = single & F.coalesce((F.col("n_1") == n - 1) & other("n_2", "n_1") & (F.col("parent") == F.col("hash_1")), F.lit(False))
    up = single & F.coalesce((F.col("n1") == n + 1) & other("n2", "n1") & (F.col("parent1") == F.col("hash")), F.lit(False))
    ends = seen.where(~(down & up)).select("slice", KEY, "hash", "parent", (~single).alias("contested"), F.when(~down, n).alias("start"))
    low = F.max("start").over(order.rowsBetween(Window.unboundedPreceding, 0))
    named = ends.withColumns({"low": low, "k": F.dense_rank().over(Window.partitionBy("slice", KEY).orderBy("hash"))})
    own = F.when(F.col("contested"), F.col("parent")).alias("own")  # one hash with two parents is two nodes of one name
    made = named.groupBy("slice", "low", "k", own).agg(F.max(KEY).alias("high"), F.max_by("hash", KEY).alias("hash"), F.min_by("parent", KEY).alias("parent"), F.max("contested").alias("contested"))
    return stored(made.select("low", "k", "high", "hash", "parent", "contested"))


def _pointers(nodes: DataFrame) -> DataFrame:
    """Each node with the one that its parent is in, next_low and next_k: null where that is not there. A parent is always the highest of its node."""
    down = nodes.select("low", "k", "hash", "contested", (F.col("low") - 1).alias("at"), "parent")
    tops = nodes.select(F.col("high").alias("at"), F.col("hash").alias("parent"), F.col("low").alias("next_low"), F.col("k").alias("next_k")).distinct()
    return stored(down.join(tops, ["at", "parent"], "left").select("low", "k", "hash", "contested", "next_low", "next_k"))


def _settled(nodes: DataFrame, pointers: DataFrame, anchor: int) -> tuple[DataFrame, DataFrame]:
    """(seeds, pointers): where walks start so that every height has a header on the line, and pointers mended to lead on.

    A height with a single header is on the line. Where headers at a contested height are reached by
    no pointer, as the parent above is a wrong one or the height above has no header, one of them is
    taken: one whose own parent is there if there is any, then the one with the smallest hash. So a
    fault above hides no block; which of two branches was lost nothing tells there.
    """
    contested = pointers.where("contested and hash is not null")
    taken = stored(contested.groupBy("low").agg(F.min_by("k", F.struct(F.col("next_low").isNull(), "hash")).alias("k")))
    tops = taken.where(F.col("low") < anchor).join(nodes.select((F.col("low") - 1).alias("low")), "low", "left_anti")
    seeds = nodes.where("not contested").select("low", "k").unionByName(tops.select("low", "k"))
    to = taken.select((F.col("low") + 1).alias("low"), F.col("low").alias("next_low"), F.col("k").alias("next_k"))
    lost = pointers.where("next_low is null").select("low", "k").join(to, "low").select("low", "k", "next_low", "next_k")
    return seeds, stored(pointers.where("next_low is not null").select("low", "k", "next_low", "next_k").unionByName(lost))


def _below(headers: DataFrame, anchor: int, anchor_hash: str) -> DataFrame:
    return headers.where((F.col(KEY) < anchor) | ((F.col(KEY) == anchor) & (F.col("block_hash") == anchor_hash)))


def _walked(headers: DataFrame, anchor: int, anchor_hash: str, uncontested: bool) -> tuple[DataFrame, DataFrame]:
    """(nodes, those on the line that `canonical_chain` gives)."""
    nodes = _nodes(_below(headers, anchor, anchor_hash))
    pointers = _pointers(nodes)
    seeds = nodes.where((F.col("high") == anchor) & (F.col("hash") == packed_hash(F.lit(anchor_hash)))).select("low", "k")
    if uncontested:
        more, pointers = _settled(nodes, pointers, anchor)
        seeds = seeds.unionByName(more)
    pointers = pointers.where("next_low is not null").select("low", "k", "next_low", "next_k")
    reached = stored(seeds.distinct())
    for _ in range(MAX_ROUNDS):
        more = stored(reached.join(pointers, ["low", "k"]).select(F.col("next_low").alias("low"), F.col("next_k").alias("k")).distinct().join(reached, ["low", "k"], "left_anti"))
        if more.isEmpty():  # an ancestor further away would have one at exactly this distance before it
            break
        reached = reached.unionByName(more)
        after = pointers.select(F.col("low").alias("next_low"), F.col("k").alias("next_k"), F.col("next_low").alias("after_low"), F.col("next_k").alias("after_k"))
        pointers = stored(pointers.join(after, ["next_low", "next_k"]).select("low", "k", F.col("after_low").alias("next_low"), F.col("after_k").alias("next_k")))
    return nodes, nodes.join(reached, ["low", "k"], "left_semi").where("not contested or hash is not null")


def line_spans(headers: DataFrame, anchor: int, anchor_hash: str, uncontested: bool = False) -> DataFrame:
    """(low, high, hash) of the line that `canonical_chain` gives: all headers from low to high where hash is null, else the one with that hash (packed) at low."""
    on_line = _walked(headers, anchor, anchor_hash, uncontested)[1]
    return stored(on_line.select("low", "high", F.when(F.col("contested"), F.col("hash")).alias("hash")).distinct())


def off_line(headers: DataFrame, anchor: int, anchor_hash: str) -> tuple[int, DataFrame] | None:
    """(low, lost): the line from the anchor leads down to low, and of the headers from there to below the anchor all are on it but those of lost (block_number, hash, packed). None without the anchor's header.

    Losers are few, so who only has to leave them out need not move all headers to the line's heights, as `rows_on` does.
    """
    nodes, on_line = _walked(headers, anchor, anchor_hash, False)
    on_line = stored(on_line.select("low", F.when(F.col("contested"), F.col("hash")).alias("hash")))
    low = on_line.agg(F.min("low")).first()[0]
    if low is None:
        return None
    won = on_line.where("hash is not null").groupBy("low").agg(F.min("hash").alias("won"))
    lost = nodes.where("contested and hash is not null").join(won, "low").where("hash <> won")
    return low, stored(lost.select(F.col("low").alias(KEY), "hash").distinct())


def rows_on(headers: DataFrame, spans: DataFrame, anchor: int, anchor_hash: str) -> DataFrame:
    """The rows of headers on a line of spans; a span is a slice long at most."""
    line = spans.select(F.explode(F.sequence("low", "high")).alias("_line_number"), F.col("hash").alias("_line_hash"))
    own = F.col("_line_hash").isNull() | (F.col("_line_hash") == packed_hash(F.col("block_hash")))
    rows = _below(headers, anchor, anchor_hash).where(F.col("block_hash").isNotNull())
    return rows.join(line, (F.col(KEY) == F.col("_line_number")) & own, "left_semi").select(*headers.columns)


def canonical_chain(headers: DataFrame, anchor: int, anchor_hash: str, uncontested: bool = False) -> DataFrame:
    """The rows of headers on the line from the anchor down, one header per height.

    headers has block_number, block_hash and parent_hash, and any other columns; forks and orphans
    may be among them, and headers above the anchor are left out. The line ends at the first parent
    that is not there. With `uncontested`, every height with a single header is taken to be on the
    line, and walked from, too, and of contested heights below a gap or a broken link one header is
    taken: that settles forks on a chain with such faults, which `link_violations` then lists. Repeated rows stay repeated. Without the anchor's header
    there are no rows (with uncontested: none at its height).
    """
    return rows_on(headers, line_spans(headers, anchor, anchor_hash, uncontested), anchor, anchor_hash)
