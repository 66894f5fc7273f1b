import random

import numpy as np
import xxhash
from odd_rows import ODD

from quarrylane.llm import simhash


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    n, root = len(prints), list(range(len(prints)))

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(n):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                root[top(a)] = top(b)
    return [top(a) for a in range(n)]


def test_fingerprint_equals_its_definition():
    for text in [t for _, t in ODD] + ["A B c d e F g", "É é", "a\x0bb c d"]:
        assert simhash.fingerprint(text) == brute_print(text)


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(150)] + [0, (1 << 64) - 1, 1 << 63]
    for _ in range(450):  # chains and dense groups around earlier ones
        p = rng.choice(prints[:160] if rng.random() < 0.5 else prints)
        for b in rng.sample(range(64), rng.randrange(1, 6)):
            p ^= 1 << b
        prints.append(p)
    prints = list(dict.fromkeys(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = dict(simhash.near_components(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect())
    want = brute_groups(prints)
    label = {}
    for s, w in zip(signed, want):
        label.setdefault(w, []).append(s)
    for group in label.values():
        assert {found.get(s, s) for s in group} == {min(group)}


def test_odd_rows(docs_of):
    rows = simhash.simhash_groups(docs_of(ODD)).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.fingerprint) for r in rows} == {(i, f"{simhash.fingerprint(t):016x}") for i, t in ODD}
    empty = {r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert empty == {1}
    kept = simhash.keep_one_per_group(docs_of(ODD))
    assert kept.columns == docs_of(ODD).columns
    assert kept.count() == len({(r.component_id, r.fingerprint if r.component_id is None else "") for r in rows})


def test_empty_table_and_nulls_alone(docs_of):
    assert simhash.simhash_groups(docs_of(ODD).limit(0)).count() == 0
    assert simhash.keep_one_per_group(docs_of(ODD).limit(0)).count() == 0
    rows = simhash.simhash_groups(docs_of([(None, "p q r s t"), (None, "p q r s t")])).collect()
    assert [r.component_id for r in rows] == [None, None]
