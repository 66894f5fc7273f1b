import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import ODD

from quarrylane.llm import bpe
from quarrylane.llm.queries import tokenizer_path

PATH = tokenizer_path()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é\n'st0<|endoftxx>🙂  ", max_size=160), st.integers(1, 40), st.integers(1, 4))
def test_tree_equals_plain_encoding(text, block, width):
    tokenizer, coder = bpe.load(PATH), bpe.Coder(PATH)
    parts = [coder.part(text[i : i + block]) for i in range(0, len(text), block)] or [coder.part("")]
    joined = bpe.tree(coder, parts, width)
    assert joined.ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert joined.text == text


@pytest.mark.parametrize("unit", ["abcdefgh", "0123", "the ", "   \n", "a'b", "é", "<|endoftext|>", "!?"])
def test_long_runs(unit):
    tokenizer, coder, text = bpe.load(PATH), bpe.Coder(PATH), unit * 700
    parts = [coder.part(text[i : i + 97]) for i in range(0, len(text), 97)]
    assert bpe.tree(coder, parts, 4).ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_documents(docs_of):
    rng = random.Random(2)
    rows = ODD + [(20 + k, "".join(rng.choice(["thing ", "er", "ing", " é", "\n", "x", "12", "<|endoftext|>"]) for _ in range(900))) for k in range(6)]
    rows += [(40, rows[-1][1])]
    docs = docs_of(rows).withColumnRenamed("d", "n_tokens")
    out = bpe.encode_documents(docs, PATH, block_chars=200, leaf_chars=60, ids=True).collect()
    tokenizer = bpe.load(PATH)
    assert len(out) == len(rows)
    for r in out:
        want = tokenizer.encode(r.text, add_special_tokens=False).ids
        assert r.token_ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert sorted((r.doc_id or 0) for r in out) == sorted((i or 0) for i, _ in rows)


def test_empty_table(docs_of):
    assert bpe.encode_documents(docs_of(ODD).limit(0), PATH).count() == 0


def _settled():
    import regex

    return [c for c in map(chr, range(0x10000)) if regex.match(f"[{bpe._SETTLED}]", c)]


def test_settled_characters_are_the_library_s():
    """Every settled character, in several places, is split and encoded as by the library."""
    coder, chars = bpe.Coder(PATH), _settled()
    texts = [x for c in chars for x in (c, f"a{c}1{c} {c}", f" {c}{c}'{c}  {c}s\n{c}")]
    assert len(chars) > 30_000 and not any(coder.bytes.ids(x) is None for x in texts)
    for i in range(0, len(texts), 4096):
        some = texts[i : i + 4096]
        assert [x.tolist() for x in coder.ids(some)] == [x.ids for x in coder.tokenizer.encode_batch_fast(some, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80), st.text(alphabet="ab é1²'s. \n\t字한<|endoftxx>", max_size=80))
def test_parts_are_the_library_s(any_text, settled):
    coder = bpe.Coder(PATH)
    for text in (any_text, settled):
        text = text.encode("utf-8", "replace").decode()
        mine, want = coder.part(text), bpe.encode_part(coder.tokenizer, text)
        for k in ("ids", "starts", "ends"):
            assert getattr(mine, k).tolist() == getattr(want, k).tolist()
        assert {*bpe._heads(mine.words).tolist()} <= {*bpe._heads(want.words).tolist()}  # sure starts of words only
        assert coder.ids([text])[0].tolist() == want.ids.tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_decoding_is_the_library_s(ids):
    coder = bpe.Coder(PATH)
    text = coder.tokenizer.decode(ids, skip_special_tokens=False)
    assert coder.digest(np.array(ids, np.uint32))[2] == hashlib.sha256(text.encode()).hexdigest()


def test_another_kind_of_tokenizer(docs_of):
    """One that lower-cases and drops white space takes the library's own way."""
    path = tokenizer_path("word_bpe_49k.json")
    assert bpe.Coder(path).bytes is None
    rows = [(1, "Some Words, and some more! " * 3), (2, None), (3, "x")]
    for r in bpe.encode_documents(docs_of(rows), path, ids=True).collect():
        assert r.token_ids == bpe.load(path).encode(r.text or "", add_special_tokens=False).ids
