import random
from collections import defaultdict

import numpy as np
import pytest
from odd_rows import ODD

from quarrylane.llm import substring_dedup
from quarrylane.llm.fm_index import FmIndex, WaveletMatrix, suffix_order


def brute_kept(rows, n):
    """The kept words of each row: every window by its words, with the smallest id it begins in."""
    number = lambda i: substring_dedup.LAST if i is None else i
    first, out = {}, []
    for i, text in rows:
        words = (text or "").split()
        for k in range(len(words) - n + 1):
            window = tuple(words[k : k + n])
            first[window] = min(first.get(window, number(i)), number(i))
    for i, text in rows:
        words = (text or "").split()
        gone = {k + j for k in range(len(words) - n + 1) if first[tuple(words[k : k + n])] < number(i) for j in range(n)}
        out.append((i, None if text is None else " ".join(w for k, w in enumerate(words) if k not in gone), len(words), len(gone)))
    return out


def result(df):
    return sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in df.collect()), key=repr)


def sequences(rng, count, symbols, most):
    return [[rng.randint(1, symbols) for _ in range(rng.randint(1, most))] for _ in range(count)]


def joined(parts):
    return np.array([s for p in parts for s in [*p, 0]])


def brute_length(index, stream, depth):
    """The longest prefix of stream, up to depth, that is somewhere in the index's sequences."""
    for k in range(min(depth, len(stream)), 0, -1):
        if any(p[j : j + k] == stream[:k] for p in index for j in range(len(p) - k + 1)):
            return k
    return 0


def test_suffixes_are_in_order():
    rng = random.Random(1)
    for symbols, most in ((2, 30), (9, 12), (1, 90)):
        text = joined(sequences(rng, 12, symbols, most)).tolist()
        unique = [s + 100 if s else text[:k].count(0) for k, s in enumerate(text)]
        assert suffix_order(np.array(text)).tolist() == sorted(range(len(text)), key=lambda k: unique[k:])


def test_wavelet_matrix_counts():
    numbers = np.random.default_rng(2).integers(0, 40, 1000)
    matrix = WaveletMatrix(numbers, 39)
    for number in (0, 1, 17, 39):
        ends = np.array([0, 1, 63, 64, 65, 500, 999, 1000])
        got = matrix.place(np.full(8, number), ends) - matrix.place(np.full(8, number), np.zeros(8, np.int64))
        assert got.tolist() == [int((numbers[:e] == number).sum()) for e in ends]


@pytest.mark.parametrize(("symbols", "depth"), [(2, 5), (3, 13), (8, 3), (1, 4)])
def test_matching_statistics_equal_brute_force(symbols, depth):
    rng = random.Random(symbols)
    indexed, streamed = sequences(rng, 8, symbols, 25), sequences(rng, 10, symbols + 1, 30)  # one symbol is unknown to the index
    index = FmIndex(joined(indexed), depth)
    lengths, lows = index.matching_statistics(joined(streamed))
    text, at = joined(indexed), 0
    for stream in streamed:
        for k in range(len(stream)):
            length = brute_length(indexed, stream[k:], depth)
            assert lengths[at + k] == length
            assert text[index.order[lows[at + k]] :][:length].tolist() == stream[k : k + length]
        at += len(stream) + 1


def random_docs(rng, count, vocabulary=300):
    words = [f"w{k}" for k in range(vocabulary)] + ["x" * 30 + str(k) for k in range(5)]
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for i in range(count):
        text = [rng.choice(words) for _ in range(rng.choice([0, 3, 12, 13, 14, 60, 200]))]
        if rng.random() < 0.4:
            at = rng.randint(0, len(text))
            text[at:at] = passage[rng.randint(0, 20) :]
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1].split()
            if text and rng.random() < 0.7:
                text[rng.randrange(len(text))] = "edit"
        rows.append((rng.choice([i, i, i, None, i - 1]), rng.choice([" ", "\n", " \t "]).join(text)))
    return rows


@pytest.mark.parametrize(("frequent", "shared"), [(4096, 1 << 16), (5, 1 << 16), (5, 0), (0, 1 << 16)])
def test_equals_brute_force(docs_of, frequent, shared):
    rows = random_docs(random.Random(7), 120)
    assert result(substring_dedup.dedup_substrings(docs_of(rows), frequent=frequent, broadcast_windows=shared)) == sorted(brute_kept(rows, 13), key=repr)


def test_many_buckets_and_shards(docs_of, monkeypatch):
    for name, value in (("BUCKET_WORDS", 500), ("SHARD_WORDS", 60), ("SLICE_BYTES", 700)):
        monkeypatch.setattr(substring_dedup, name, value)
    rows = random_docs(random.Random(8), 80)
    assert result(substring_dedup.dedup_substrings(docs_of(rows))) == sorted(brute_kept(rows, 13), key=repr)


@pytest.mark.parametrize("n", [2, 3, 5, 20])
def test_other_window_sizes(docs_of, n):
    rows = random_docs(random.Random(n), 40, vocabulary=12 if n < 6 else 300)
    assert result(substring_dedup.dedup_substrings(docs_of(rows), n=n)) == sorted(brute_kept(rows, n), key=repr)


def test_repeated_words_make_long_units(docs_of):
    rows = [(1, "la " * 500), (2, "la " * 30 + "so"), (3, "la " * 12), (4, "do " + "la " * 13 + "do")]
    assert result(substring_dedup.dedup_substrings(docs_of(rows))) == sorted(brute_kept(rows, 13), key=repr)


def test_odd_rows(docs_of):
    out = substring_dedup.dedup_substrings(docs_of(ODD))
    assert result(out) == sorted(brute_kept(ODD, 13), key=repr)
    assert {"lang", "source", "d", "key"} <= set(out.columns)
    assert substring_dedup.dedup_substrings(docs_of(ODD).limit(0)).count() == 0
    clashing = docs_of([(1, "a b"), (2, None)]).selectExpr("doc_id", "text", "1 as n_words", "2 as oid", "3 as hash", "4 as marks", "5 as `a b,c`")
    assert sorted((r.oid, r.hash, r.marks, r["a b,c"], r.n_words) for r in substring_dedup.dedup_substrings(clashing).collect()) == [(2, 3, 4, 5, 0), (2, 3, 4, 5, 2)]


def test_routing_keys_depend_on_the_window_alone():
    rng = random.Random(3)
    texts = [substring_dedup.spaced(t.encode()) for _, t in random_docs(rng, 60)]
    keys = defaultdict(set)
    for parts in (texts, texts[30:], texts[:7]):
        found = substring_dedup.Slice(parts)
        starts = found.windows(13)
        for window, key in zip(found.texts(starts, np.full(len(starts), 13)), found.keys(starts, 13).tolist(), strict=True):
            keys[window].add(key)
    assert keys and all(len(k) == 1 for k in keys.values())
