"""BPE encoding by tree concatenation.

A text of more than LEAF_CHARS is cut into leaves that are encoded on their own; then neighbouring
halves are joined, pair by pair up a tree. A text of more than BLOCK_CHARS is first cut into blocks
that separate tasks encode (each by its own tree) and join, GROUP neighbours in each task and then
the results. Near a cut the two halves' tokens may be wrong, so a window around it is encoded again
as one text, and grows until it agrees with both sides:

* left, it starts where a word (a piece of the tokenizer's own splitting) starts, with at least
  GUARD words of the left half after it, or inside one unsplit piece, at a token that it encodes
  to the same token again;
* right, it has a word start in common with the right half, with GUARD words after it, or ends
  inside one unsplit piece with the token that the right half has there.

Splitting looks back no further than the last word's start and ahead no further than the guard, so
beyond a common word start both scans go on alike. Inside one piece, a sequence of BPE tokens is
the piece's encoding if each neighbouring pair is the encoding of the two together, and each pair
was seen by one side or the window. If nothing agrees, the window grows to all of both halves,
which is the plain encoding.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_of

LEAF_CHARS = 4_096
BLOCK_CHARS = 32_768
GROUP = 8
GUARD = 8
_LOADED: dict = {}

#: The splitting of byte-level tokenizers, and the bytes that their vocabularies write as themselves.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Characters of long-settled classes: for these alone the pattern above surely splits as the library does.
_SETTLED = r"\t\n\r\x20-\x7e\u00a1-\u024f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0410-\u044f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"


class ByteLevel:
    """A fast way to the same tokens, for tokenizers that split by PIECES, do nothing else to a text and merge in the order of their ids.

    For settled characters without added tokens, an encoder over the same vocabulary and the same
    pattern gives what the library gives; `ids` is none where that is not certain.
    """

    def __init__(self, tokenizer, made: dict):
        import tiktoken

        self.odd = regex.compile(f"[^{_SETTLED}]")
        self.added = [x.content for x in tokenizer.get_added_tokens_decoder().values()]
        written = {chr(b): b for b in _PRINTED} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.table = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.table[i] = bytes(written[x] for x in token)
        self.lengths = np.array([len(x) for x in self.table], np.int64)
        ranks = {self.table[i]: i for token, i in vocabulary.items() if token not in self.added}
        merged = [vocabulary["".join(x) if isinstance(x, list) else x.replace(" ", "")] for x in made["model"]["merges"]]
        if merged != sorted(merged) or min(map(len, ranks), default=0) < 1:
            raise KeyError("the merges are not in the order of the ids")
        self.encoder = tiktoken.Encoding("same", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, tokenizer) -> ByteLevel | None:
        made = json.loads(tokenizer.to_str())
        splits = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}.items() <= (made["pre_tokenizer"] or {}).items()
        decodes = (made["decoder"] or {}).get("type") == "ByteLevel"
        model = made["model"]
        plain = model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and not made["normalizer"] and not made["post_processor"]
        try:
            return cls(tokenizer, made) if splits and decodes and plain else None
        except KeyError:  # a token that is not written in bytes, or other merges
            return None

    def ids(self, text: str) -> np.ndarray | None:
        return None if self.odd.search(text) or any(x in text for x in self.added) else self.encoder.encode_to_numpy(text, disallowed_special=())

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the tokens of a text start and end, in code points; a token inside one covers it whole."""
        ends = self.lengths[ids].cumsum()
        starts = ends - self.lengths[ids]
        if text.isascii():
            return starts, ends
        lead = (np.frombuffer(text.encode("utf-8"), np.uint8) & 0xC0) != 0x80
        at = lead.cumsum() - 1
        return at[starts], at[ends - 1] + 1

    def words(self, text: str, starts: np.ndarray) -> np.ndarray:
        """Numbers of the stretches that begin at white space after something else; the pattern surely splits there."""
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        white = chars <= 32  # among settled characters
        heads = white[starts] & ~white[np.maximum(starts, 1) - 1]
        heads[:1] = True
        return heads.cumsum() - 1

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))


def _from_file(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def load(path: str):
    """The tokenizer of a file, once per process, without truncation and padding."""
    if path not in _LOADED:
        _LOADED[path] = _from_file(path)
    return _LOADED[path]


def _fast(path: str) -> ByteLevel | None:
    """The fast way of a file's tokenizer, once per process. The tokenizer itself is let go of: most processes never need it again."""
    if ("fast", path) not in _LOADED:
        _LOADED["fast", path] = ByteLevel.of(_from_file(path))
    return _LOADED["fast", path]


class Part:
    """A stretch of text and its tokens: ids, where each token's text starts and ends (code points), its word."""

    def __init__(self, text: str, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray):
        self.text, self.ids, self.starts, self.ends, self.words = text, ids, starts, ends, words


def encode_part(tokenizer, text: str) -> Part:
    made = tokenizer.encode(text, add_special_tokens=False)
    spans = np.array(made.offsets, np.int64).reshape(-1, 2)
    words, last, at = np.empty(len(made.ids), np.int64), None, -1
    for i, w in enumerate(made.word_ids):
        if w is None or w != last:  # a special token stands alone
            at += 1
        words[i], last = at, w
    return Part(text, np.array(made.ids, np.int64), spans[:, 0], spans[:, 1], words)


class Coder:
    """Encodes texts and parts of texts, and decodes, with one tokenizer."""

    def __init__(self, path: str):
        self.path, self.bytes = path, _fast(path)

    @property
    def tokenizer(self):
        return load(self.path)

    @property
    def longest(self) -> float:
        """Length of the longest added token; infinite if one has letters or digits only, so that it could hide in a piece."""
        added = self.bytes.added if self.bytes else [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        return float("inf") if any(map(_one_kind, added)) else max(map(len, added), default=0)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The tokens of texts: the fast way's where it is certain, else the library's."""
        found = [self.bytes.ids(x) if self.bytes else None for x in texts]
        others = [x for x, f in zip(texts, found, strict=True) if f is None]
        rest = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else [])
        return [np.array(next(rest).ids, np.uint32) if f is None else f for f in found]

    def part(self, text: str) -> Part:
        ids = self.bytes.ids(text) if self.bytes else None
        if ids is None:
            return encode_part(self.tokenizer, text)
        starts, ends = self.bytes.spans(text, ids)
        return Part(text, ids.astype(np.int64), starts, ends, self.bytes.words(text, starts))

    def grown(self, text: str, leaf_chars: int = LEAF_CHARS) -> Part:
        """The part of a whole text, by a tree over its leaves; other tokenizers than byte-level ones take it as one leaf."""
        if not self.bytes:
            return self.part(text)
        return tree(self, [self.part(text[i : i + leaf_chars]) for i in range(0, len(text), leaf_chars)] or [self.part("")])

    def digest(self, ids: np.ndarray) -> tuple[int, str, str]:
        text = self.bytes.decode(ids) if self.bytes else self.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode("utf-8")
        try:
            text.decode("utf-8")
        except UnicodeDecodeError:
            text = text.decode("utf-8", "replace").encode("utf-8")
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()


def _heads(words: np.ndarray) -> np.ndarray:
    """Indices of the tokens that start a word."""
    return np.flatnonzero(np.diff(words, prepend=-1))


def _clean(part: Part, i: int) -> bool:
    """Whether token i starts at a code point of its own, not inside one."""
    return i == 0 or part.ends[i - 1] <= part.starts[i]


def _left_start(a: Part, width: int) -> tuple[int, bool]:
    """The token at which the window starts in a, and whether that is a safe word start."""
    if width >= len(a.ids):
        return 0, True
    heads = _heads(a.words)
    safe = heads[: max(0, len(heads) - GUARD)]
    inside = safe[safe <= len(a.ids) - width]
    if len(inside) and len(a.ids) - inside[-1] <= 4 * width:
        return int(inside[-1]), True
    i = len(a.ids) - width
    while i > 0 and not _clean(a, i):
        i -= 1
    if i == 0:
        return 0, True
    return i, False


def join(coder: Coder, a: Part, b: Part, width: int = 32) -> Part:
    """The part of a's text followed by b's, exactly as the whole would be encoded."""
    if not len(a.text) or not len(b.text):
        return b if not len(a.text) else a
    longest = coder.longest
    while True:
        i, safe = _left_start(a, width)
        j = min(width, len(b.ids))
        while j < len(b.ids) and not _clean(b, j):
            j += 1
        cut_left = 0 if i == 0 else int(a.starts[i])
        cut_right = len(b.text) if j == len(b.ids) else int(b.starts[j])
        window = coder.part(a.text[cut_left:] + b.text[:cut_right])
        shift = len(a.text) - cut_left  # of b's text in the window
        left = safe or _inside_left(window, a, i, longest)
        meet = _meeting(window, b, j, shift, longest) if left else None
        if meet is not None:
            k, m = meet  # the window's tokens before k, then b's from m
            back = len(a.text) - shift
            ids = np.concatenate([a.ids[:i], window.ids[:k], b.ids[m:]])
            starts = np.concatenate([a.starts[:i], window.starts[:k] + back, b.starts[m:] + len(a.text)])
            ends = np.concatenate([a.ends[:i], window.ends[:k] + back, b.ends[m:] + len(a.text)])
            join_left = i > 0 and not safe  # the window's first word is a's last
            middle = window.words[:k] + ((a.words[i] if join_left else a.words[i - 1] + 1) if i else 0)
            first = (middle[-1] if k else a.words[i - 1] if i else -1) + 1
            same = m < len(b.ids) and m > 0 and b.words[m] == b.words[m - 1]  # inside one piece
            tail = b.words[m:] - (b.words[m] if m < len(b.ids) else 0) + (first - 1 if same else first)
            return Part(a.text + b.text, ids, starts, ends, np.concatenate([a.words[:i], middle, tail]))
        if i == 0 and j == len(b.ids):
            return window
        width *= 2


def _inside_left(window: Part, a: Part, i: int, longest: float) -> bool:
    """Whether the window, which starts inside a's last piece, begins with a's token there."""
    start = int(a.starts[i - 1])
    inside = a.words[i - 1] == a.words[i] == a.words[-1] and len(a.text) - start > longest and _one_kind(a.text[start:])
    return bool(inside and len(window.ids) > 1 and window.ids[0] == a.ids[i] and window.ends[0] == a.ends[i] - a.starts[i])


def _one_kind(text: str) -> bool:
    """Whether a text is letters only, or digits only: then its splitting is the same from any point."""
    return text.isalpha() or text.isdecimal()


def _meeting(window: Part, b: Part, j: int, shift: int, longest: float) -> tuple[int, int] | None:
    """Token indices (in the window, in b) from which b's tokens follow; none if they do not agree."""
    whole = j == len(b.ids)
    if whole:
        return len(window.ids), len(b.ids)  # nothing of b is left out
    heads, theirs = _heads(window.words), _heads(b.words[:j])
    mine = {int(window.starts[k]) - shift: int(k) for k in heads[: max(0, len(heads) - GUARD)] if window.starts[k] >= shift}
    for m in theirs[1:]:
        k = mine.get(int(b.starts[m]))
        if k is not None and (k == 0 or window.ends[k - 1] <= window.starts[k]):
            return k, int(m)
    last = j - 1  # the window ends with b's token before j, inside one piece
    inside = b.words[last] == b.words[j] and b.words[0] == b.words[j] and b.starts[last] > longest and _one_kind(b.text[: int(b.ends[j])])
    if inside and window.ids[-1] == b.ids[last] and window.starts[-1] - shift == b.starts[last] and _clean(b, last):
        return len(window.ids), j
    return None


def tree(coder: Coder, parts: list[Part], width: int = 32) -> Part:
    """Join neighbours pair by pair until one part is left."""
    while len(parts) > 1:
        parts = [join(coder, *parts[i : i + 2], width) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


_DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_PART = "text string, ids array<int>, heads binary, starts array<int>, ends array<int>"


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in small pieces: an encoding takes many times the memory of its text."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _packed(coder: Coder, part: Part) -> tuple:
    """A part as the columns of _PART: word starts as bits, and places only where text and tokens do not give them."""
    heads = np.packbits(np.diff(part.words, prepend=-1) > 0).tobytes()
    places = ([], []) if coder.bytes else (part.starts, part.ends)
    return part.text, part.ids, heads, *places


def _unpacked(coder: Coder, text: str, ids, heads: bytes, starts, ends) -> Part:
    ids = np.asarray(ids, np.int64)
    words = np.unpackbits(np.frombuffer(heads, np.uint8), count=len(ids)).astype(np.int64).cumsum() - 1
    places = coder.bytes.spans(text, ids) if coder.bytes else (np.asarray(starts, np.int64), np.asarray(ends, np.int64))
    return Part(text, ids, *places, words)


def _blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """One row for each block of each distinct long text: its key, place, text and the number of blocks."""
    blocks = (F.floor((F.char_length("text") - 1) / block_chars) + 1).cast("int")
    cut = docs.select("key", "text", blocks.alias("blocks"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("place"))
    return cut.select("key", "place", "blocks", F.substr("text", F.col("place") * block_chars + 1, F.lit(block_chars)).alias("block"))


def encode_documents(docs: DataFrame, tokenizer_path: str, block_chars: int = BLOCK_CHARS, leaf_chars: int = LEAF_CHARS, ids: bool = False) -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256 (and token_ids, an array, if ids is set).

    The tokens are those of the tokenizers library for the whole text, added tokens in the text
    included, and the decoded text is its decoding of them. A null text counts as empty: no tokens.
    Every row of docs is kept, with its other columns; columns of docs with the new names are
    replaced. Of equal long texts, each block is encoded once. An empty table gives no rows.
    """
    docs = docs.drop("n_tokens", "ids_sha256", "decoded_sha256", "token_ids")
    held = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*held, F.lit(0).alias("_")).alias("held"), text_of().alias("text"))
    extra = ", token_ids array<int>" if ids else ""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(tokenizer_path)
        for batch in _slices(batches, 64):
            texts = batch.column("text").to_pylist()
            small = [len(x) <= leaf_chars or not coder.bytes for x in texts]
            short = iter(coder.ids([x for x, s in zip(texts, small, strict=True) if s]))
            encoded = [next(short) if s else coder.grown(x, leaf_chars).ids for x, s in zip(texts, small, strict=True)]
            found = list(zip(*map(coder.digest, encoded), strict=True)) or [[], [], []]
            columns = [batch.column("held"), batch.column("text"), pa.array(found[0], pa.int64()), pa.array(found[1], pa.string()), pa.array(found[2], pa.string())]
            names = ["held", "text", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns, names = [*columns, pa.array(encoded, pa.list_(pa.int32()))], [*names, "token_ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(tokenizer_path)
        types = [pa.string(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for batch in _slices(batches, 8):
            parts = [_packed(coder, coder.grown(x, leaf_chars)) for x in batch.column("block").to_pylist()]
            columns = [pa.array([p[k] for p in parts], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("key", "place", "blocks")), *columns], ["key", "place", "blocks", "text", "ids", "heads", "starts", "ends"])

    def joined(coder: Coder, rows: pd.DataFrame) -> Part:
        rows = rows.sort_values("place")
        return tree(coder, [_unpacked(coder, *x) for x in zip(rows["text"], rows["ids"], rows["heads"], rows["starts"], rows["ends"], strict=True)])

    def near(rows: pd.DataFrame) -> pd.DataFrame:
        coder = Coder(tokenizer_path)
        part, whole = joined(coder, rows), int(rows["blocks"].iloc[0]) <= GROUP
        first = [rows["key"].iloc[0], int(rows["place"].min())]
        if whole:  # done: only the digest travels on
            return pd.DataFrame([[*first, "", [], b"", [], [], *coder.digest(part.ids), *([part.ids] if ids else [])]])
        return pd.DataFrame([[*first, *_packed(coder, part), None, None, None, *([None] if ids else [])]])

    def far(rows: pd.DataFrame) -> pd.DataFrame:
        key, digest = rows["key"].iloc[0], list(rows.columns[7:])
        if rows["ids_sha256"].iloc[0] is not None:
            return rows[["key", *digest]]
        coder = Coder(tokenizer_path)
        found = joined(coder, rows).ids
        return pd.DataFrame([[key, *coder.digest(found), *([found] if ids else [])]])

    held_type = rows.schema["held"].dataType.simpleString()
    is_long = F.char_length("text") > block_chars
    short = rows.where(~is_long).mapInArrow(whole, f"held {held_type}, text string, {_DIGEST}{extra}")
    long = rows.where(is_long).withColumn("key", F.sha2(F.encode("text", "UTF-8"), 256))
    blocks = _blocks(long, block_chars).dropDuplicates(["key", "place"])
    leaves = blocks.mapInArrow(leaf, f"key string, place int, blocks int, {_PART}")
    groups = leaves.groupBy("key", F.floor(F.col("place") / GROUP)).applyInPandas(near, f"key string, place int, {_PART}, {_DIGEST}{extra}")
    found = groups.groupBy("key").applyInPandas(far, f"key string, {_DIGEST}{extra}")
    both = short.unionByName(long.join(found, "key").drop("key"))
    names = both.columns[2:]
    return both.select(*(F.col("text").alias("text") if c == "text" else F.col("held").getField(c).alias(c) for c in docs.columns), *names)
