"""Mixing sources to target weights under a time-varying curriculum.

Sizes are words. Each source has a target: its weight's share of all words, but at most
MAX_REPEATS times its own size; what is cut off goes to the others by weight. A source's documents
form an endless stream in the order of a hash, one pass after another, of which the mix takes the
first `target` words. A schedule says how fast a source's demand is met as training goes from 0 to
1: each source's rate is piecewise linear over KNOTS and integrates to its target. A document's
position in training is the moment at which the integral reaches its place in the stream, and the
mix is sorted by position.

Running sums over a source are taken in BUCKETS slices of the hash range: a window inside each
slice, and one over the slices' sums, so that no source's documents meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ROW_KEY, durable, one_of_each, text_of, with_row_key, words

MAX_REPEATS = 3
BUCKETS = 1024
#: Moments of training between which a source's rate is linear.
KNOTS = (0.0, 0.25, 0.5, 0.75, 1.0)
#: How far the rate of the source furthest from the mean weight moves, as a share of its mean rate.
RAMP = 0.8


def targets(sizes: DataFrame, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, target) for each source; sizes has source and source_size.

    Weights are 1, 2, 3 and so on again in the order of the sources' code points, null last. A
    source is capped when its share at the final level exceeds its cap; the level is found in one
    sort by cap per weight, as capped sources are the first in that order.
    """
    # One row per source: the windows over all of them sort a table as small as the list of sources.
    every = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(every.orderBy(F.col("source").isNull(), F.col("source")))
    weighed = sizes.withColumn("weight", ((rank - 1) % 3 + 1).cast("double"))
    cap = F.col("source_size").cast("double") * max_repeats
    by_cap = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    summed = weighed.withColumn("cap", cap).withColumns(
        {
            "all_words": F.sum(F.col("source_size").cast("double")).over(every),
            "cut_words": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    level = (F.col("all_words") - F.col("cut_words")) / F.col("weight_left")  # words per weight, were this source the first without a cap
    free = F.max(F.when(level * F.col("weight") <= F.col("cap"), level)).over(every)
    share = F.least(F.col("cap"), F.coalesce(free, F.lit(float("inf"))) * F.col("weight"))
    return summed.withColumn("target", share).select("source", "source_size", "weight", "target")


def _rates(ramp: float) -> list[Column]:
    """The rate of demand at each knot, in words per unit of training.

    Sources above the mean weight (by target) grow, the others shrink; at each moment the rates of
    all sources add up to the same number of words.
    """
    every = Window.partitionBy(F.lit(0))
    mean = F.coalesce(F.try_divide(F.sum(F.col("weight") * F.col("target")).over(every), F.sum("target").over(every)), F.lit(0.0))
    furthest = F.max(F.abs(F.col("weight") - mean)).over(every)
    tilt = F.when(furthest > 1e-9, (F.col("weight") - mean) / furthest).otherwise(F.lit(0.0)) * ramp
    return [F.col("target") * (1 + tilt * (2 * t - 1)) for t in KNOTS]


def with_schedule(sources: DataFrame, ramp: float = RAMP) -> DataFrame:
    """sources with `rates` at the knots and `met`, the integral of the rate up to each knot."""
    made = sources.withColumn("rates", F.array(*_rates(ramp)))
    met, total = [F.lit(0.0)], F.lit(0.0)
    for k in range(1, len(KNOTS)):
        total = total + (F.col("rates")[k - 1] + F.col("rates")[k]) * ((KNOTS[k] - KNOTS[k - 1]) / 2)
        met.append(total)
    return made.withColumn("met", F.array(*met))


def position(word: Column) -> Column:
    """The moment at which the integral of the schedule reaches a word of the stream."""
    out = F.lit(1.0)
    for k in reversed(range(1, len(KNOTS))):
        span, r0, r1 = KNOTS[k] - KNOTS[k - 1], F.col("rates")[k - 1], F.col("rates")[k]
        left, slope = F.greatest(word - F.col("met")[k - 1], F.lit(0.0)), (r1 - r0) / span
        root = F.sqrt(F.greatest(r0 * r0 + 2 * slope * left, F.lit(0.0)))
        inside = F.when(r0 + root > 0, KNOTS[k - 1] + 2 * left / (r0 + root)).otherwise(F.lit(KNOTS[k - 1]))
        out = F.when(word <= F.col("met")[k], F.least(inside, F.lit(KNOTS[k]))).otherwise(out)
    return out


def placed(docs: DataFrame, max_repeats: float = MAX_REPEATS, ramp: float = RAMP) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, start, rates, met) for each document.

    start is the number of words before the document in its source's stream. The order is that of
    hashes of id and text, so reruns agree; rows equal in both are interchangeable.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64(text_of()).alias("text_hash"), F.size(words(text_of())).cast("bigint").alias("size"))
    order = F.xxhash64("doc_id", "text_hash")
    sized = durable(rows.withColumn("order", order).withColumn("slice", F.shiftrightunsigned("order", 54).cast("int")))
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    before = Window.partitionBy("source").orderBy("slice")
    slices = slices.withColumn("offset", F.sum("slice_size").over(before) - F.col("slice_size"))
    sources = with_schedule(targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), max_repeats), ramp)
    parts = slices.select(F.col("source").alias("of"), F.col("slice").alias("part"), "offset")
    plan = durable(parts.join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("source", "weight"))
    inside = Window.partitionBy("source", "slice").orderBy("order", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    summed = sized.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
    joined = summed.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("part")))
    return joined.select("doc_id", "source", "text_hash", "size", "source_size", "target", (F.col("offset") + F.col("inside")).alias("start"), "rates", "met")


def _taken() -> Column:
    """Words of a document that lie in the first `target` words of its source's endless stream."""
    goal = F.round("target").cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = goal - passes * F.col("source_size")
    return passes * F.col("size") + F.least(F.col("size"), F.greatest(rest - F.col("start"), F.lit(0)))


def mixed(docs: DataFrame, max_repeats: float = MAX_REPEATS, ramp: float = RAMP) -> DataFrame:
    """One row per document, in training order: doc_id, size, source_size, target, taken, position.

    taken counts the words that the mix takes from the document, repeats included; the last one
    that a source needs may be taken in part. position is the moment (0 to 1) at which training
    first reaches the document; null if it is not taken. A null text has size 0; a null source is a
    source of its own. Repeated rows give repeated rows. An empty table gives no rows.
    """
    made = placed(docs, max_repeats, ramp).withColumn("taken", _taken())
    made = made.withColumn("position", F.when(F.col("taken") > 0, position(F.col("start").cast("double"))))
    out = made.select("doc_id", "size", "source_size", "target", "taken", "position")
    return out.repartitionByRange(F.col("position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def materialised(docs: DataFrame, max_repeats: float = MAX_REPEATS, ramp: float = RAMP) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, in training order.

    A document's copy in a pass is there if the mix takes at least half of its words in that pass.
    All columns of docs are kept, whatever they are called. Documents without words are taken once.
    An empty table gives no rows.
    """
    made = placed(docs, max_repeats, ramp).withColumn("taken", _taken())
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(1)).cast("int")
    passes = made.withColumn("times", times).where("times > 0")
    turns = passes.select("doc_id", "text_hash", F.explode(F.transform(F.sequence(F.lit(0), F.col("times") - 1), lambda k: position(F.col("start") + k * F.col("source_size").cast("double")))).alias("position"), "source")
    # Rows equal in id, source and text stand at different places of the stream; all their turns go to any one row of the kind.
    key = [*ROW_KEY, "sourceless", "of"]
    source = {"sourceless": F.col("source").isNull(), "of": F.coalesce(F.col("source").cast("string"), F.lit(""))}
    turns = turns.select(F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("id"), F.col("text_hash").alias("hash"), *(c.alias(k) for k, c in source.items()), "position")
    joined = one_of_each(with_row_key(docs, **source), key).join(turns, key).select("row", "position")
    return joined.repartitionByRange("position").sortWithinPartitions("position").select("row.*")
