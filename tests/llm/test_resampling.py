import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from odd_rows import ODD

from quarrylane.llm import resampling


def brute_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)]


def brute(rows, targets, max_n=1, buckets=10_000, min_words=20, percent=10):
    features = lambda t: [b" ".join(w[k : k + n]) for w in [brute_words(t)] for n in range(1, max_n + 1) for k in range(len(w) - n + 1)]
    count = lambda texts: Counter(crc32(f) % buckets for t in texts for f in features(t))
    s, t = count([x for _, x in rows]), count(targets)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        found = features(text)
        weight = sum(gain[crc32(f) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(brute_words(text))])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def texts(rng, count):
    words = ["Der", "die", "DAS", "über", "cat", "dog", "4you", "x-y"] + [f"w{k}" for k in range(400)]
    return [" ".join(rng.choices(words, k=rng.choice([0, 5, 19, 20, 60, 200]))) for _ in range(count)]


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize(("max_n", "head"), [(1, 1 << 16), (1, 20), (2, 1 << 16), (2, 50)])
def test_equals_brute_force(spark, docs_of, monkeypatch, max_n, head):
    monkeypatch.setattr(resampling, "HEAD", head)
    rng = random.Random(4)
    rows, target = list(enumerate(texts(rng, 150))), texts(rng, 20)
    items = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id bigint, text string")
    assert result(resampling.ranked(docs_of(rows), items, max_n=max_n, buckets=500, percent=30)) == brute(rows, target, max_n, 500, 20, 30)


def test_a_full_counter_lets_its_tail_go(spark, docs_of, monkeypatch):
    monkeypatch.setattr(resampling, "HELD", 10)
    monkeypatch.setattr(resampling, "HEAD", 30)
    rows = list(enumerate(texts(random.Random(5), 60)))
    totals, heads = resampling.bucket_totals(docs_of(rows))
    assert totals == dict(Counter(crc32(w) % 10_000 for _, t in rows for w in brute_words(t)))
    assert len(heads[0]) <= 30
    counts = Counter(w for _, t in rows for w in brute_words(t))
    assert all(counts[w] * 30 >= sum(counts.values()) for w in heads[0])


def test_odd_rows(spark, docs_of):
    items = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "item_id bigint, text string")
    assert result(resampling.ranked(docs_of(ODD), items, percent=50)) == brute(ODD, ["one two", None, ""], percent=50)
    assert result(resampling.ranked(docs_of(ODD), items.limit(0))) == brute(ODD, [])
    assert resampling.ranked(docs_of(ODD).limit(0), items).count() == 0


def test_drawn_rows_keep_their_columns(spark, docs_of):
    rows = list(enumerate(texts(random.Random(6), 100)))
    items = spark.createDataFrame([(1, "cat dog w1 w2")], "item_id bigint, text string")
    docs = docs_of(rows).selectExpr("*", "1 as score", "2 as hash", "3 as place")
    picked = resampling.drawn(docs, items, percent=25)
    want = {r[0] for r in brute(rows, ["cat dog w1 w2"], percent=25) if r[4]}
    assert {r.doc_id for r in picked.collect()} == want and picked.columns == docs.columns
    assert resampling.drawn(docs_of([(3, "a " * 30)] * 4), items, percent=100).count() == 1
