import math
import random
import re
import string

import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from quarrylane.llm import quality_rules, rule_classifier, statistics, trees

LABELS = "doc_id bigint, quality int, toxic int"


def brute_counts(text):
    words, symbols = (text or "").split(), sum(c in "#*$%&|<>" for c in text or "")
    lines = [x for x in (text or "").split("\n") if x.split()]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(docs_of):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c\n", "d$ ", "<|e ", "\n", "é\t", "Z! "]) for _ in range(rng.randrange(90)))) for i in range(80)] + ODD
    got = statistics.with_counts(docs_of(rows)).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.text)


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (0, 458, 0.01), (3, 900, 0.01), (2, 50, 0.2), (40, 3000, 0.02), (5, 5, 0.5), (0, 100000, 0.01)])
def test_binomial_tail(spark, k, n, p):
    exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
    row = spark.createDataFrame([(k, n)], "k bigint, n bigint")
    for error in (exact * 1.01, exact * 0.99):
        (got,) = row.select(quality_rules.binomial_tail_at_most(F.col("k"), F.col("n"), p, F.lit(float(error)) if error > 0 else F.lit(1e-300))).first()
        assert got == (k < n * p and max(error, 1e-300) >= exact)


def labelled(spark, docs_of, n=3000):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice("abcdefghij") * rng.randrange(2, 9) + str(rng.randrange(400)) for _ in range(rng.randrange(60, 90))]
        good = rng.random() < 0.8
        rows.append((i, " ".join(words) + "." if good else " ".join(w + "###" for w in words)))
        labels.append((i, int(good), 0))
    return docs_of(rows), spark.createDataFrame(labels, LABELS)


def test_rules_keep_good_and_reject_bad(spark, docs_of):
    docs, labels = labelled(spark, docs_of)
    out = quality_rules.judged(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(out)
    assert share[1] >= 1 - quality_rules.RISK and share[0] == 0


def test_search_equals_brute_force(spark, docs_of):
    """Cutoffs by the definition: lower all rules together while the exact bound holds, in each stratum."""
    rng = random.Random(9)
    strata, rows, labels = {}, [], []
    for i in range(1200):
        lang = ("en", "de", "fr")[i % 7 % 3]
        words = ["".join(rng.choice("abcXYZ#!") if rng.random() < 0.1 * rng.random() else "w" for _ in range(6)) + str(i * 100 + k) for k in range(60)]
        strata[i] = lang
        rows.append((i, " ".join(words)))
        labels.append((i, int(rng.random() < 0.9), 0))
    docs = docs_of(rows).withColumn("lang", F.element_at(F.array(F.lit("en"), F.lit("de"), F.lit("fr")), (F.col("doc_id") % 7 % 3 + 1).cast("int")))
    rated = spark.createDataFrame(labels, LABELS)
    found = {r.stratum: [r[k] for k in quality_rules.RULES] for r in quality_rules.safe_cutoffs(statistics.with_counts(docs), rated).collect()}
    for lang in ("en", "de", "fr"):
        good = [text for (i, text), (_, q, _) in zip(rows, labels, strict=True) if q and strata[i] == lang]
        shares = []
        for text in good:
            n, chars, symbols, dups, repeats = brute_counts(text)
            shares.append((symbols / chars, repeats / n, dups / n, sum("A" <= c <= "Z" for c in text) / chars, text.count("!") / n))
        chosen = [None] * len(quality_rules.RULES)
        for level in range(quality_rules.LEVELS):
            cut = [quality_rules.cutoffs(r)[level] for r in quality_rules.RULES]
            k = sum(any(x > c for x, c in zip(s, cut, strict=True)) for s in shares)
            p, n = quality_rules.RISK, len(good)
            if sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) > quality_rules.ERROR / 3:
                break
            chosen = cut
        assert found[lang] == pytest.approx(chosen)
    assert any(x[0] for x in found.values())


def test_rules_act_at_small_scale(spark):
    """On the small tables the largest stratum has labels enough: rules reject, and few good documents."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_rules.judged(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    assert out.where("not base_failed and not kept").count() > 0
    good = out.join(labels.where("quality = 1"), "doc_id").agg(F.avg((F.col("rejected_by") != "").cast("int"))).first()[0]
    assert good <= quality_rules.RISK


def test_too_few_labels_give_no_cutoff(spark, docs_of):
    docs, labels = labelled(spark, docs_of, 60)
    assert all(r.kept for r in quality_rules.judged(docs, labels).collect())
    assert all(not r.kept for r in quality_rules.judged(docs_of(ODD), labels.limit(0)).collect() if r.n_words < 50)
    assert quality_rules.judged(docs_of(ODD), labels).count() == len(ODD)
    assert quality_rules.judged(docs_of(ODD).limit(0), labels).count() == 0


def test_classifier(spark, docs_of):
    docs, labels = labelled(spark, docs_of, 1200)
    out = rule_classifier.scored(docs, labels).join(labels, "doc_id").where("held_out")
    rows = out.collect()
    assert len(rows) > 200 and np.mean([r.predicted == r.quality for r in rows]) > 0.98
    flipped = labels.withColumn("quality", F.when(rule_classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in rule_classifier.scored(docs, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in rows)  # held-out labels have no influence
    kept = rule_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0.75 < kept.count() / 1200 < 0.85


def test_classifier_without_labels_and_odd_rows(spark, docs_of):
    none = spark.createDataFrame([], LABELS)
    rows = rule_classifier.scored(docs_of(ODD), none).collect()
    assert len(rows) == len(ODD) and all(r.predicted == 1 and not (r.doc_id is None and r.held_out) for r in rows)
    assert rule_classifier.scored(docs_of(ODD).limit(0), none).count() == 0
    docs, labels = labelled(spark, docs_of, 400)
    rows = rule_classifier.scored(docs_of(ODD).drop("d").withColumn("n_words", F.lit("x")), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 1] < 0.3)).astype(float)
    start, found = trees.boost(x, y)
    odds = start + 0.3 * sum(trees.predict(t, x) for t in found)
    assert np.mean((odds > 0) == y) > 0.99


def brute_features(text):
    """The classifier's features of one text, in plain Python."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars, count = sum(map(len, words)), lambda known: sum(c in known for c in text)
    share = lambda a, b: a / b if b else 0.0
    ended = sum(bool(re.search(r"[.!?:;][\x20\x09-\x0D]*\Z", x)) for x in lines)
    return (
        len(words), share(chars, len(words)), share(count("#*$%&|<>"), chars), share(count(string.ascii_uppercase), chars), share(count("!"), len(words)), share(count(string.digits), chars), share(count("|"), len(words)),
        share(len(set(words)), len(words)), share(sum(a == b for a, b in zip(words, words[1:], strict=False)), len(words)), share(len(lines) - len(set(lines)), len(lines)), share(len(words), len(lines)), share(ended, len(lines)),
    )


def test_features_equal_brute_force(spark, docs_of):
    texts = [t for _, t in ODD] + ["A! b? a a|a\nA! b? a a|a\n\n x 1 #\t9. \r\n", "One. Two:\n three;  \nfour", "ÄÖ ß É 𝔸 ١"]
    rows = list(enumerate(texts)) + [(1000 + r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = statistics.with_features(docs_of(rows)).select("text", *statistics.FEATURES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == pytest.approx(brute_features(r.text)), r.text


def test_compiled_rules_equal_a_loop(spark, docs_of):
    """The score that Spark evaluates is that of the fitted rules, document by document."""
    docs, labels = labelled(spark, docs_of, 500)
    intercept, rules = rule_classifier.learn(docs, labels)
    assert rules and all(1 <= len(rule) <= 3 and weight for rule, weight in rules)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rule_classifier.scored(docs, labels).collect():
        x = brute_features(texts[r.doc_id])
        odds = intercept + sum(w for rule, w in rules if all((x[f] <= cut) == left for f, left, cut in rule))
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-9)
