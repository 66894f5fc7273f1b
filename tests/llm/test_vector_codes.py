import hashlib
import math

import numpy as np
import pytest

from quarrylane.llm import vector_codes

KIND = "vec_id bigint, embedding array<float>, label int, code string, `values` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], KIND)


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain loops over Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min((apart(part(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        chosen = [[near(v, p)[1] for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [part(v, p) for (_, v, _), c in zip(kept, chosen, strict=True) if c[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out, sums = [], {}
    for i, v, label in kept:
        found = [near(v, p) for p in range(parts)]
        out.append((i, label, [k for _, k in found], sum(d for d, _ in found)))
        sums[label] = sums.get(label, 0) + out[-1][3]
    return sorted(((*r, sums[r[1]]) for r in out), key=repr), books


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(seed, count, width=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 8 * width))
    return [(int(i), (centres[rng.integers(20)] + 0.3 * rng.normal(size=8 * width)).astype(np.float32).tolist(), None if i % 7 == 0 else int(i % 3)) for i in rng.permutation(count)]


@pytest.mark.parametrize("pivots", [1, 4, 16])
def test_equals_brute_force(spark, pivots):
    rows = random_rows(1, 300)
    out, books = vector_codes.compressed(frame(spark, rows), pivots=pivots)
    want, want_books = brute(rows)
    assert books.tolist() == want_books and result(out) == want
    numbers = ",".join(str(x) for p in want_books for e in p for x in e)
    assert vector_codes.codebooks_digest(books) == hashlib.sha256(numbers.encode()).hexdigest()


def test_bounds_leave_out_evaluations_and_lose_none():
    rng = np.random.default_rng(2)
    entries = rng.integers(-4000, 4000, (16, 8))
    parts = entries[rng.integers(0, 16, 2000)] + rng.integers(-200, 200, (2000, 8))
    pivots = vector_codes.far_apart(entries, 4)
    index, best, evaluated = vector_codes.nearest_entries(parts, vector_codes.to_pivots(parts, pivots), entries, pivots)
    every = np.square(parts[:, None] - entries[None]).sum(2)
    assert (index == every.argmin(1)).all() and (best == every.min(1)).all()
    assert evaluated < 0.3 * every.size


def test_ties_go_to_the_lower_index():
    entries = np.array([[5, 0], [0, 0], [2, 0], [0, 0]])
    pivots = entries[:2]
    parts = np.array([[1, 0], [0, 0]])
    assert vector_codes.nearest_entries(parts, vector_codes.to_pivots(parts, pivots), entries, pivots)[0].tolist() == [1, 1]


def test_roots_are_exact():
    numbers = np.array([0, 1, 2, 3, 4, 10**18, 10**18 - 1, (1 << 62) - 1, ((1 << 31) - 1) ** 2, ((1 << 31) - 1) ** 2 - 1])
    assert vector_codes.floored_root(numbers).tolist() == [math.isqrt(int(x)) for x in numbers]


def test_odd_rows(spark):
    rows = random_rows(3, 20) + [(None, [0.5] * 16, 1), (None, [0.25] * 16, None), (2, [1.0] * 16, 5), (2, [1.0] * 16, 5), (3, None, 1), (4, [float("nan")] + [0.0] * 15, 1), (5, [float("inf")] + [0.0] * 15, 1), (6, [None] + [0.0] * 15, 1)]
    out, books = vector_codes.compressed(frame(spark, rows))
    want, want_books = brute(rows)
    assert books.tolist() == want_books and result(out) == want
    few, books = vector_codes.compressed(frame(spark, rows[:3] + [(900, [0.5] * 9, 1), (901, [], 1)]))
    assert books.shape == (8, 3, 2) and result(few) == brute(rows[:3])[0]
    none, books = vector_codes.compressed(frame(spark, rows).limit(0))
    assert none.count() == 0 and books.size == 0 and none.columns == out.columns
    assert vector_codes.compressed(frame(spark, [(1, None, 2)]))[0].count() == 0


def test_what_does_not_fit_is_refused(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compressed(frame(spark, [(1, [0.5] * 9, 1)]))
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.compressed(frame(spark, [(1, [1e30] * 16, 1)]))
