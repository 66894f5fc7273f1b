import hashlib
import random
import struct

import pytest
import xxhash
from odd_rows import ODD
from pyspark.sql import functions as F

from quarrylane.llm import fingerprint


def brute_hashes(text):
    """The distinct hashes of five-word shingles: XXH64 with seed 42 of each word, chained over the words."""
    words = (text or "").split()
    if not words:
        return set()
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    out = set()
    for run in [hashes[i : i + 5] for i in range(len(words) - 4)] or [hashes]:
        seed = 42
        for h in run:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", h), seed)
        out.add(seed)
    return out


def kept(hashes):
    return {h for h in hashes if h < 1 << 62}


def brute_likeness(a, b):
    if a == b:
        return 1.0
    x, y = kept(a), kept(b)
    return len(x & y) / min(len(x), len(y)) if x and y else 0.0


def test_sketches_and_likeness_equal_brute_force(spark, docs_of):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice(base) for _ in range(rng.choice([0, 1, 3, 5, 9, 40, 300])))) for i in range(1, 80)]
    rows += [(100 + k, rows[k][1] + " more words at the end of it") for k in range(20)]
    found = {r.doc_id: r for r in fingerprint.fingerprint_pairs(docs_of(rows)).collect()}
    ordered = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(ordered):
        following, half = ordered[(k + 1) % len(ordered)][1], len(text) // 2
        mine, theirs, edited = brute_hashes(text), brute_hashes(following), brute_hashes(text[: len(text) - half] + following[:half])
        n, _, hashes = found[i].fingerprint.split(":")
        assert int(n, 16) == len(mine) and {int(hashes[j : j + 16], 16) for j in range(0, len(hashes), 16)} == kept(mine)
        assert found[i].near_next == brute_likeness(mine, theirs) and found[i].near_edited == brute_likeness(mine, edited)


def test_sketches_merge(spark):
    a, b = " ".join(f"a{k}" for k in range(200)), " ".join(f"a{k}" for k in range(100, 400))
    one = lambda c: fingerprint.sketch(fingerprint.shingle_hashes(F.col(c)))
    (found,) = spark.createDataFrame([(a, b)], "a string, b string").select(fingerprint.merged(one("a"), one("b"))).first()
    assert {h % (1 << 64) for h in found} == kept(brute_hashes(a) | brute_hashes(b))


def test_edited_texts_follow_descending_ids(docs_of):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(i % 40))) for i in range(1, 90)]
    found = {r.doc_id: r for r in fingerprint.fingerprint_pairs(docs_of(rows)).collect()}
    ordered = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(ordered):
        following, half = ordered[(k + 1) % len(ordered)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i].n_chars == len(text)
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1


def test_containment_is_estimated(docs_of):
    long = " ".join(f"u{k}" for k in range(4000))
    short = " ".join(f"u{k}" for k in range(1000, 1500)) + " " + " ".join(f"v{k}" for k in range(500))
    found = {r.doc_id: r for r in fingerprint.fingerprint_pairs(docs_of([(2, short), (1, long)])).collect()}
    assert abs(found[2].near_next - 0.5) < 0.1


def test_odd_rows(docs_of):
    rows = fingerprint.fingerprint_pairs(docs_of(ODD)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in rows) == sorted((i or 0, len(t or "")) for i, t in ODD)
    prints = {}
    for r in rows:
        prints.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    # The second of two equal rows follows the first: same text, likeness 1.
    assert max(r.near_next for r in rows if r.doc_id == 6) == 1.0
    assert fingerprint.fingerprint_pairs(docs_of(ODD).limit(0)).count() == 0


def test_only_one_document(docs_of):
    (row,) = fingerprint.fingerprint_pairs(docs_of([(9, "a b c d e f g h")])).collect()
    assert row.near_next == 1.0


@pytest.mark.parametrize("copies", [1, 3, fingerprint.COPIES])
def test_equal_rows_are_dealt_to_tasks(docs_of, copies):
    texts = {i: " ".join(f"w{(i * 5 + k) % 40}" for k in range(10 + i)) for i in range(1, 7)}
    rows = [(i, texts[i]) for i in texts for _ in range({2: 11, 5: 3}.get(i, 1))] + [(None, "a b c d e f g h")] * 4 + [(None, None)] * 5 + [(3, None), (3, "")]
    found = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in fingerprint.fingerprint_pairs(docs_of(rows), copies).collect()]
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)  # noqa: E731  in the order of signed hashes
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1])))
    want = []
    for k, (i, text) in enumerate(ordered):
        following, half = ordered[(k + 1) % len(ordered)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        mine, changed, theirs = (brute_hashes(t) for t in (text, edited, following))
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), brute_likeness(mine, changed), brute_likeness(mine, theirs)))
    assert sorted(found, key=repr) == sorted(want, key=repr)
