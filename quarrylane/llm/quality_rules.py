"""Risk-controlled quality rules, in DataFrame operations only.

Each rule rejects a document when one of its statistics exceeds a cutoff. The cutoffs of all rules
are lowered together, level by level, from the mildest on; so the documents that a level rejects are
among those that the next one rejects. The level is chosen per stratum (the language) from labelled
documents: of those labelled good, a stratum has n, and any rule rejects k of them at a level. The
level is safe if the exact (Clopper-Pearson) upper bound of its false rejection rate is at most the
allowed risk, that is if P(Binomial(n, risk) <= k) <= error. Levels are tested in their fixed order
up to the first that fails, which needs no correction; over strata the error is divided
(Bonferroni). So with probability 1 - ERROR, in no stratum are more than RISK of the good documents
rejected by the rules. A stratum with too few labels gets no cutoff: with four strata, some 90 good
labels without a false rejection suffice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import durable
from .statistics import with_counts

RISK = 0.05
ERROR = 0.05
LEVELS = 12
#: The mildest and the strictest cutoff of each rule; the levels between are evenly spaced in logarithms.
RANGES = {"symbols": (0.6, 0.04), "repeats": (0.5, 0.3), "dup_lines": (0.3, 0.02), "upper": (0.8, 0.1), "marks": (1.0, 0.05)}
RULES = tuple(RANGES)
#: Strata tables up to this many rows are broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 10_000


def _shares() -> dict[str, Column]:
    of = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "symbols": of("n_symbols", "word_chars"),
        "repeats": of("n_repeat_words", "n_words"),
        "dup_lines": of("n_dup_lines", "n_words"),
        "upper": of("n_upper", "word_chars"),
        "marks": of("n_marks", "n_words"),
    }


def cutoffs(rule: str) -> list[float]:
    """A rule's cutoff at each level."""
    mild, strict = RANGES[rule]
    return [mild * (strict / mild) ** (i / (LEVELS - 1)) for i in range(LEVELS)]


def _first_level() -> Column:
    """The first level at which any rule rejects a document; LEVELS if none does."""
    spared = [sum((share <= c).cast("int") for c in cutoffs(r)) for r, share in _shares().items()]
    return F.least(*spared)


def binomial_tail_at_most(k: Column, n: Column, p: float, error: Column) -> Column:
    """Whether P(X <= k) <= error for X ~ Binomial(n, p), summed term by term in logarithms."""
    odds, miss = math.log(p) - math.log1p(-p), math.log1p(-p)
    start = F.struct((n * F.lit(miss)).alias("term"), (n * F.lit(miss)).alias("total"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log(((n - i + 1) / i).cast("double")) + F.lit(odds)
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, start, step, lambda acc: acc["total"])
    return F.when(n * F.lit(p) <= k, F.lit(False)).otherwise(total <= F.log(error))


def safe_cutoffs(counts: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per stratum with labels: its cutoff (null: none) for each rule, as columns of their names.

    counts has doc_id, the stratum and the counts of `with_counts`; labels has doc_id and quality.
    A document counts as good if all its labels are 1. Rows with a null doc_id have no label.
    """
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    rated = counts.join(good, "doc_id", "left_semi").select(F.col(stratum).alias("stratum"), _first_level().alias("level"))
    tallies = durable(rated.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.array(*(F.count_if(F.col("level") <= i) for i in range(LEVELS))).alias("k")))
    strata = max(1, tallies.count())
    safe = tallies.select("stratum", "n", F.posexplode("k").alias("level", "k"))
    safe = safe.withColumn("safe", binomial_tail_at_most(F.col("k"), F.col("n"), risk, F.lit(error / strata)))
    chosen = safe.groupBy("stratum").agg(F.coalesce(F.min(F.when(~F.col("safe"), F.col("level"))), F.lit(LEVELS)).alias("failed"))
    cut = (F.get(F.array(*map(F.lit, cutoffs(r))), F.col("failed") - 1).alias(r) for r in RULES)
    return chosen.select("stratum", *cut)


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, rejected_by, kept.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows. kept is
    false if base_failed, or if a rule rejects the document; rejected_by names these rules. A null
    text has no words; a null stratum is a stratum of its own. Repeated rows give repeated rows. An
    empty table gives no rows; without labels only base_failed rejects. Further columns of docs are
    not read, so their names cannot clash.
    """
    columns = [c for c in dict.fromkeys(("doc_id", "text", stratum)) if c in docs.columns]
    base = docs.select(*columns) if stratum in columns else docs.select(*columns, F.lit(None).cast("string").alias(stratum))
    counted = durable(with_counts(base.withColumn(stratum, F.col(stratum).cast("string"))).drop("text"))
    chosen = durable(safe_cutoffs(counted, labels, stratum))
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    chosen = chosen.select("stratum", *(F.col(r).alias(f"cut_{r}") for r in RULES))
    joined = counted.join(chosen, F.col(stratum).eqNullSafe(F.col("stratum")), "left")
    hits = [F.when(share > F.col(f"cut_{r}"), F.lit(r)) for r, share in _shares().items()]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = joined.withColumns({"base_failed": failed, "rejected_by": F.array_join(F.array_compact(F.array(*hits)), ",")})
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"), "rejected_by")
