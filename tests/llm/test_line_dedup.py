import random
from collections import Counter

import pytest
from odd_rows import ODD

from quarrylane.llm import line_dedup


def brute(rows):
    """Kept texts by the definition: earlier in (doc_id, null last), rows given in that order."""
    seen, out = [], []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        kept = []
        for line in text.split("\n"):
            words = frozenset(line.split())
            hit = bool(words) and any(5 * len(words & s) >= 4 * len(words | s) for s in seen)
            if words:
                seen.append(words)
            if not hit:
                kept.append(line)
        out.append("\n".join(kept))
    return out


@pytest.mark.parametrize("hot", [1 << 17, 16, 1])
def test_equals_brute_force(docs_of, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_WORDS", hot)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 30))] for _ in range(60)]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs_of(rows)).collect()}
    for (i, text), want in zip(rows, brute(rows)):
        assert found[i][0] == want
        assert found[i][1] - found[i][2] == (len(want.split("\n")) if want or found[i][1] > found[i][2] else 0)


@pytest.mark.parametrize("hot", [1 << 17, 1])
def test_dense_groups_of_near_copies(docs_of, monkeypatch, hot):
    """Many variants of few lines, short ones and some about the length from which there are more parity bits."""
    monkeypatch.setattr(line_dedup, "HOT_WORDS", hot)
    rng = random.Random(11)
    bases = [[f"b{k}w{i}" for i in range(n)] for k, n in enumerate((9, 12, 17, 40, 62, 66, 70, 150))]
    rows = []
    for i in range(160):
        lines = []
        for base in rng.sample(bases, 3):
            line = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(line) // 10, len(line) // 7])):
                line[rng.randrange(len(line))] = rng.choice(["x", "y", f"new{rng.randrange(400)}"])
            for _ in range(rng.choice([0, 0, 1, len(line) // 9])):
                line.pop(rng.randrange(len(line)))
            lines.append(" ".join(rng.sample(line, len(line))))
        rows.append((i, "\n".join(lines)))
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(rows)).collect()}
    assert [found[i] for i, _ in rows] == brute(rows)


def test_candidates_that_fail_are_tried_against_all(docs_of, monkeypatch):
    """With filters that let everything through, first candidates fail and the second try decides."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(line_dedup, "_plausible", lambda a, b: F.lit(True))
    rows = [(1, "a b c d e f g h i j"), (2, "a b q r s t u v w x"), (3, "a b q r s t u v w y"), (4, "c d e f g h i j k a")]
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(rows)).collect()}
    assert [found[i] for i, _ in rows] == brute(rows)


def test_two_words_of_a_line_with_one_key(spark, docs_of):
    """A line posted twice under one w is not its own earlier match."""
    from pyspark.sql import functions as F

    words = spark.range(300_000).select(F.concat(F.lit("w"), F.col("id")).alias("word"))
    posted = F.shiftrightunsigned(F.xxhash64("word"), 64 - line_dedup._HASH_BITS).bitwiseAND(F.lit((1 << 32) - 1))
    codes = sorted((r.code, r.word) for r in words.withColumn("code", posted).collect())
    twins = [(a[1], b[1]) for a, b in zip(codes, codes[1:]) if a[0] == b[0]]
    last = [w for _, w in codes[-200:]]
    lines = [" ".join([*twins[k], *last[k * 20 : k * 20 + 8]]) for k in range(3)]
    near = lines[1].replace(last[20], last[199])
    rows = [(1, lines[0]), (2, lines[1]), (3, near), (4, lines[2] + "\n" + lines[0])]
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(rows)).collect()}
    assert [found[i] for i, _ in rows] == brute(rows)


def test_a_hot_word_is_split(spark):
    """Sets of frequent words alone do not meet under one word, and matching ones still meet."""
    from pyspark.sql import functions as F

    rng = random.Random(2)
    sets = [sorted(rng.sample(range(60), rng.randrange(4, 15))) for _ in range(800)]
    for x in sets[:60]:  # near copies: a word less, or another one
        sets += [x[:k] + x[k + 1 :] for k in (0, len(x) // 2)] + [sorted({*x} - {x[1]} | {rng.randrange(60)})]
    rows = spark.createDataFrame([(k, x[: len(x) - -(-4 * len(x) // 5) + 2], cold) for cold in (0, 99) for k, x in enumerate(sets)], "k int, prefix array<int>, cold int")
    posts = rows.select("k", "cold", F.explode(line_dedup._posts()).alias("p")).select("k", "cold", "p.w").distinct().collect()
    keys = {c: Counter(r.w for r in posts if r.cold == c) for c in (0, 99)}
    assert max(keys[0].values()) * 4 < max(keys[99].values())
    under = {c: [{r.w for r in posts if r.cold == c and r.k == k} for k in range(len(sets))] for c in (0, 99)}
    matching = [(a, b) for a in range(len(sets)) for b in range(a) if 9 * len({*sets[a]} & {*sets[b]}) >= 4 * (len(sets[a]) + len(sets[b]))]
    assert len(matching) > 20 and all(under[c][a] & under[c][b] for a, b in matching for c in (0, 99))


def test_sets_are_candidates_by_their_rarest_shared_word(spark):
    """Sets of 47 words can differ in five words each: their rarest shared word is among the first six, and postings after these make no candidates."""
    columns = ", ".join(f"{s}{c} {t}" for s in ("a_", "b_") for c, t in (("n", "int"), ("i", "int"), ("parity0", "bigint"), ("parity1", "bigint")))
    places = [(i, j) for i in range(11) for j in range(11)]
    rows = spark.createDataFrame([(47, i, 0, 0, 47, j, 0, 0) for i, j in places], columns)
    assert {(r.a_i, r.b_i) for r in rows.where(line_dedup._plausible("a_", "b_")).collect()} == {(i, j) for i, j in places if max(i, j) <= 5}


def test_words_are_read_once(docs_of, monkeypatch):
    """All rounds verify on the words that one pass over the texts has found."""
    calls, words = [], line_dedup._words
    monkeypatch.setattr(line_dedup, "_words", lambda *args: calls.append(1) or words(*args))
    base = [f"w{i}" for i in range(20)]
    rows = [(k, " ".join([*base[:17], f"x{k}", f"y{k}", f"z{k}"])) for k in range(12)] + [(12, " ".join(base[:17])), (13, " ".join(base[1:17]))]
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(rows)).collect()}
    assert [found[i] for i, _ in rows] == brute(rows)
    assert len(calls) == 1


def test_odd_rows(docs_of):
    source = docs_of(ODD).withColumnRenamed("d", "n_lines")
    out = line_dedup.dedup_lines(source)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == len(ODD)
    texts = [(r.doc_id, r.text) for r in rows]
    assert sorted(t for i, t in texts if i == 3) == ["", "one"]
    assert sorted(len(t) for i, t in texts if i == 6) == [0, 15000]
    assert (1, None) in texts and (1, "") in texts and (2, " \t\n") in texts and (None, "a b c") in texts
    assert [t for i, t in texts if i == 4] == ["two two\n"]


def test_empty_table(docs_of):
    assert line_dedup.dedup_lines(docs_of(ODD).limit(0)).count() == 0
