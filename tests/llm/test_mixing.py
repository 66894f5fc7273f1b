import random

import pytest
from odd_rows import ODD

from quarrylane.llm import mixing


def brute_targets(sizes):
    """Water filling by rounds: cut what is above its cap, share the rest by weight, again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, open_ = float(sum(sizes.values())), {}, set(sizes)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 3 * sizes[s] + 1e-9}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 3.0 * sizes[s] for s in above}
        open_ -= above
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": int(10 ** rng.uniform(0, 5)) for i in range(rng.randrange(1, 25))} | {None: 700, "zero": 0}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)
    assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6 * sum(sizes.values())


def corpus(docs_of, n=300):
    rng = random.Random(8)
    return docs_of([(i, "w " * rng.randrange(1, 60)) for i in range(n)])


def test_taken_words_meet_the_targets(docs_of):
    docs = corpus(docs_of)
    source = {r.doc_id: r.source for r in docs.collect()}
    rows = mixing.mixed(docs).collect()
    assert rows == mixing.mixed(docs).collect() and len(rows) == 300
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        s = source[r.doc_id]
        taken[s], target[s] = taken.get(s, 0) + r.taken, r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken)
    seen = [r.position for r in rows if r.position is not None]
    assert seen == sorted(seen) and 0 <= seen[0] and seen[-1] <= 1


def test_position_inverts_the_integral(spark, docs_of):
    rows = mixing.placed(corpus(docs_of)).withColumn("at", mixing.position(mixing.F.col("start").cast("double"))).collect()
    for r in rows:
        if r.start > r.target:
            continue
        area = 0.0
        for k in range(1, len(mixing.KNOTS)):
            a, b = mixing.KNOTS[k - 1], min(mixing.KNOTS[k], r.at)
            if b > a:
                slope = (r.rates[k] - r.rates[k - 1]) / (mixing.KNOTS[k] - a)
                area += r.rates[k - 1] * (b - a) + slope * (b - a) ** 2 / 2
        assert abs(area - r.start) < 1e-6 * max(1, r.target)


def test_materialised(docs_of):
    docs = corpus(docs_of)
    wanted = {r.doc_id: r for r in mixing.mixed(docs).collect()}
    out = mixing.materialised(docs)
    assert out.columns == docs.columns
    times = {}
    for r in out.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert all(times.get(i, 0) == int(r.taken / r.size + 0.5) for i, r in wanted.items())


def test_odd_rows(docs_of):
    rows = mixing.mixed(docs_of(ODD)).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mixed(docs_of(ODD).limit(0)).count() == 0
    assert mixing.materialised(docs_of(ODD)).count() >= 1
    assert mixing.materialised(docs_of(ODD).limit(0)).count() == 0
    assert all(r.taken == 0 for r in mixing.mixed(docs_of([(1, ""), (2, None)])).collect())
