"""Quality classifier: a sparse ensemble of rules, compiled to Spark columns.

Boosted trees over text statistics are fitted to a bounded sample of labelled documents; each path
from a root is a conjunctive rule; an L1-penalised logistic regression gives most rules weight
zero; the rest become one column expression, which Spark evaluates over all documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import durable
from .statistics import FEATURES, with_features
from .trees import boost, paths

#: At most so many labelled documents are learned from: those whose ids' hashes are below a share of all hashes.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.7


def _applies(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, left, cut in rule:
        out &= (x[:, f] <= cut) == left
    return out


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of the logistic regression with an L1 penalty, by accelerated proximal steps."""
    n, k = z.shape
    step = 4.0 / max(1.0, float(np.linalg.eigvalsh((z.T @ z).astype(np.float64) / n + np.eye(k) * 1e-9)[-1]) + 1.0)
    w, b, v, c, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    for _ in range(steps):
        gap = 1 / (1 + np.exp(-np.clip(z @ v.astype(z.dtype) + c, -30, 30))) - y
        new_w, new_b = v - step * (gap.astype(z.dtype) @ z) / n, c - step * gap.mean()
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return float(b), w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.0005) -> tuple[float, list[tuple[tuple, float]]]:
    """(intercept, [(rule, weight)]): the rules with a weight, over features in the order of FEATURES.

    All different paths of the trees are offered, and the penalty alone chooses among them. With a
    single class, or no rows, there are no rules: the score is the mean, or 1 without rows.
    """
    if not len(y) or y.min() == y.max():
        return (30.0 if not len(y) or y[0] == 1 else -30.0), []
    _, found = boost(x, y)
    rules = list(dict.fromkeys(p for tree in found for p in paths(tree)))
    z = np.empty((len(y), len(rules)), np.float32)
    for k, rule in enumerate(rules):
        z[:, k] = _applies(rule, x)
    scale = z.std(axis=0, dtype=np.float64)
    used = scale > 0  # the others hold for all rows or for none
    rules, z, scale = [r for r, u in zip(rules, used, strict=True) if u], z[:, used], scale[used]
    if not rules:
        return float(np.log(y.mean() / (1 - y.mean()))), []
    z /= scale.astype(np.float32)
    intercept, weights = lasso(z, y, penalty)
    return intercept, [(r, float(w / s)) for r, w, s in zip(rules, weights, scale, strict=True) if w]


def compiled(model: tuple[float, list[tuple[tuple, float]]]) -> Column:
    """The score as a column over FEATURES."""
    total = F.lit(model[0])
    for rule, weight in model[1]:
        holds = None
        for f, left, cut in rule:
            x = F.col(FEATURES[f])
            one = x <= cut if left else x > cut
            holds = one if holds is None else holds & one
        total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def held_out() -> Column:
    """Whether a document's label is kept from learning: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _picked(labels: DataFrame, sample_rows: int) -> DataFrame:
    """(doc_id, quality) of at most sample_rows rated documents; conflicting labels of an id count as 0."""
    rated = labels.where("doc_id is not null and quality is not null").where(~held_out())
    rated = durable(rated.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality")))
    n, picked = rated.count(), rated
    share = 0.95 * sample_rows / n if n else 1.0
    while n > sample_rows:  # again only if chance puts too many below the share
        picked = rated.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < F.lit(int(share * (1 << 31))))
        n, share = picked.count(), share * 0.9
    return picked


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[float, list[tuple[tuple, float]]]:
    """Fit on at most sample_rows labelled documents that are not held out.

    Only their features are computed. An id with several texts stands for one of them: the one with
    the least features.
    """
    few = F.broadcast(_picked(labels, sample_rows))  # sample_rows rows at most
    rows = with_features(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(few, "doc_id"))
    found = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(*FEATURES)).alias("x")).select("doc_id", "quality", "x.*").toPandas().sort_values("doc_id")
    return fit(found[list(FEATURES)].to_numpy(float), found["quality"].to_numpy(float))


def _measured(docs: DataFrame) -> DataFrame:
    """(row, *FEATURES): each row of docs as a struct, whatever its columns are called, and its text's features."""
    made = with_features(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    # Exploding one struct keeps the optimizer from writing the features out in each rule.
    return made.select("row", F.explode(F.array(F.struct(*FEATURES))).alias("made")).select("row", "made.*")


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted (1 if the score is at least 0.7).

    A null text is an empty one and scored like any other; ids, sources, languages and labels are
    no inputs of a score, so equal texts have equal scores. Repeated rows give repeated rows. An
    empty table gives no rows; without labels every score is near 1. Further columns are not read.
    """
    score = compiled(learn(docs, labels, sample_rows))
    rows = _measured(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    made = rows.select("row.doc_id", score.alias("score"))
    return made.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns, whatever these are called.

    Nulls, repeated rows and empty tables are treated as in `scored`.
    """
    model = learn(docs, labels, sample_rows)
    return _measured(docs).where(compiled(model) >= THRESHOLD).select("row.*")
