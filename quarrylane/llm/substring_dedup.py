"""Substring deduplication with an FM-index per shard.

A window is `n` consecutive words. A word goes if a window over it begins, word for word, in a
document with a smaller doc_id as well. The steps:

1. Each window is routed by its smallest hash of four consecutive words, so that equal windows meet
   wherever they are. Consecutive windows with one routing key make a unit, a piece of text of a few
   words more than n; texts are never cut otherwise, and no two documents are ever paired.
2. Routing keys are counted. The windows of a frequent key, say that of a passage that very many
   documents share, are routed by a hash of all their words instead, each a unit of its own, so that
   what surrounds the passage does not meet in one place.
3. Each task sends, for some documents and one bucket of keys, the different units and where they
   occur in one packed row. For frequent keys it sends a window once with its smallest doc_id only,
   and no occurrences.
4. A bucket's units are dealt to shards by key. An FM-index over a shard's different units is built,
   the units are streamed through it by backward search, and where n words match, the interval of
   suffixes gives all places of the window and with them the smallest doc_id. A window is marked for
   the occurrences with a larger doc_id. For frequent keys the window and the smallest doc_id come back.
5. The marks go to their documents by a join. Windows of frequent keys are looked up by their text
   among those that came back, which are broadcast up to BROADCAST_WINDOWS and joined beyond.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fm_index import FmIndex
from .shared import drop_durable, durable, text_of

WINDOW_WORDS = 13
SHINGLE_WORDS = 4
#: Keys with more units than this are frequent.
FREQUENT = 4096
#: At most so many frequent keys, 8 bytes each, are broadcast; above, the limit on their units rises.
FREQUENT_KEYS = 1 << 20
#: Up to so many shared windows of frequent keys, of at most WINDOW_BYTES each, are broadcast.
BROADCAST_WINDOWS = 1 << 16
WINDOW_BYTES = 512
#: Words of a bucket's units, and of one index.
BUCKET_WORDS = 1 << 21
SHARD_WORDS = 1 << 20
#: Bytes of text that a task looks at together.
SLICE_BYTES = 1 << 23
#: Windows of one unit: they are the bits of a mark.
UNIT_WINDOWS = 64
#: Stands for a null doc_id, which so counts as the largest.
LAST = (1 << 63) - 1
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_SHORT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def spaced(text: bytes | None) -> bytes:
    """The words of a text with one space between them."""
    out = (text or b"").translate(_SPACES).strip(b" ")
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Slice:
    """Some documents' words, side by side: the text, where words begin and end, each document's first word, and hashes."""

    def __init__(self, texts: list[bytes]):
        filled = [t for t in texts if t]
        self.text = b" ".join(filled) + b" " if filled else b""
        padded = np.frombuffer(self.text + bytes(24), np.uint8)
        self.end = np.flatnonzero(padded[: len(self.text)] == 32)
        self.begin = np.concatenate(([0], self.end[:-1] + 1)) if len(self.end) else self.end
        self.first = np.concatenate(([0], np.cumsum([t.count(b" ") + 1 if t else 0 for t in texts])))
        loads = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        size = self.end - self.begin
        # The first 16 and the last 8 bytes of a word and its size: equal for equal words, which is all that routing asks.
        h = loads[self.begin] & _SHORT[np.minimum(size, 8)]
        h = _mixed(h + (loads[self.begin + 8] & _SHORT[np.clip(size - 8, 0, 8)]) * _ODD[0] + size.astype(np.uint64) * _ODD[1])
        self.hashes = np.where(size > 16, _mixed(h ^ loads[np.maximum(self.end - 8, 0)]), h)

    def hash_of(self, starts: np.ndarray, words: int) -> np.ndarray:
        """The hash of so many words from each start."""
        out = np.zeros(len(starts), np.uint64)
        for k in range(words):
            out = _mixed(out * _ODD[2] + self.hashes[starts + k])
        return out

    def windows(self, n: int) -> np.ndarray:
        """The first word of every window."""
        counts = np.maximum(np.diff(self.first) - n + 1, 0)
        return np.repeat(self.first[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())

    def keys(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Each window's smallest shingle hash."""
        k = min(SHINGLE_WORDS, n)
        if not len(starts):
            return np.zeros(0, np.uint64)
        low, width, across = self.hash_of(np.arange(len(self.hashes) - k + 1), k), 1, n - k + 1
        while 2 * width <= across:
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        return np.minimum(low[starts], low[starts + across - width])

    def units(self, n: int, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first word, number of windows, key, whether the key is frequent) of each unit."""
        starts = self.windows(n)
        keys = self.keys(starts, n)
        often = np.zeros(len(keys), bool)
        if frequent is not None and len(frequent) and len(keys):
            often = frequent[np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)] == keys
            keys[often] = self.hash_of(starts[often], n)
        new = np.ones(len(keys), bool)
        new[1:] = (starts[1:] != starts[:-1] + 1) | (keys[1:] != keys[:-1]) | often[1:]
        # Windows of different documents are never consecutive: n is at least 2, so a document's last word starts none.
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(keys)))
        pieces = -(-sizes // UNIT_WINDOWS)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(heads, pieces) + nth * UNIT_WINDOWS
        count = np.minimum(np.repeat(sizes, pieces) - nth * UNIT_WINDOWS, UNIT_WINDOWS)
        return starts[at], count, keys[at], often[at]

    def texts(self, starts: np.ndarray, words: np.ndarray) -> list[bytes]:
        text = self.text
        return [text[a:b] for a, b in zip(self.begin[starts].tolist(), self.end[starts + words - 1].tolist(), strict=True)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with at most SLICE_BYTES of text together (a longer text alone), and their spaced texts."""
    for batch in batches:
        texts, start, held = [], 0, 0
        for k, text in enumerate(batch.column("text")):
            text = spaced(text.as_py())
            if texts and held + len(text) > SLICE_BYTES:
                yield batch.slice(start, len(texts)), texts
                texts, start, held = [], k, 0
            texts.append(text)
            held += len(text)
        if texts:
            yield batch.slice(start, len(texts)), texts


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, np.ndarray) else v for v in columns.values()], list(columns))


def _rows(docs: DataFrame, *more: Column) -> DataFrame:
    """(oid, hash, text, *more): the id with LAST for null, a hash of the text, and its bytes."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("oid"), F.xxhash64(text_of()).alias("hash"), text_of().cast("binary").alias("text"), *more)


def frequent_keys(docs: DataFrame, n: int, limit: int = FREQUENT) -> tuple[np.ndarray, int]:
    """The sorted keys with more units than the limit (raised until there are FREQUENT_KEYS at most), and the words of all units."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _slices(batches):
            _, windows, keys, _ = Slice(texts).units(n)
            different, counts = np.unique(keys, return_counts=True)
            words = int(windows.sum()) + len(windows) * (n - 1)
            yield _batch(key=np.append(different.view(np.int64), 0), n=np.append(counts, words), words=np.append(np.zeros(len(counts), bool), True))

    counted = durable(_rows(docs).select("text").mapInArrow(count, "key bigint, n bigint, words boolean").groupBy("key", "words").agg(F.sum("n").alias("n")).where(f"words or n > {int(limit)}"))
    words = counted.where("words").agg(F.sum("n")).first()[0] or 0
    often = counted.where("not words")
    while often.count() > FREQUENT_KEYS:
        limit *= 2
        often = often.where(F.col("n") > limit)
    keys = np.array([r[0] for r in often.select("key").collect()], np.int64).view(np.uint64)  # FREQUENT_KEYS at most
    drop_durable(counted)
    return np.sort(keys), words


def _packed(*arrays: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unpacked(data: bytes, *types: str) -> list[np.ndarray]:
    """Arrays of equal length, as they were packed."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    count = len(raw) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(raw, t, count, at))
        at += count * np.dtype(t).itemsize
    return out


def _sent(n: int, buckets: int, frequent) -> Callable:
    """A task's packed units: (bucket, texts, units, places)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch, texts in _slices(batches):
            found = Slice(texts)
            start, windows, key, often = found.units(n, frequent.value)
            doc = np.searchsorted(found.first, start, side="right") - 1
            oid, hashes = (batch.column(c).to_numpy()[doc] for c in ("oid", "hash"))
            position = (start - found.first[doc]).astype(np.int32)
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            out = {"bucket": bucket[order][bounds], "texts": [], "units": [], "places": []}
            for rows in np.split(order, bounds[1:]) if len(order) else []:
                known: dict[bytes, int] = {}
                unit = np.array([known.setdefault(t, len(known)) for t in found.texts(start[rows], windows[rows] + n - 1)], np.int32)
                one = np.zeros(len(known), np.int64)
                one[unit] = rows
                low, high = np.full(len(known), LAST), np.full(len(known), -LAST - 1)
                np.minimum.at(low, unit, oid[rows])
                np.maximum.at(high, unit, oid[rows])
                out["texts"].append(zstandard.ZstdCompressor(level=1).compress(b"\n".join(known)))
                out["units"].append(_packed(key[one], low, high, windows[one].astype(np.uint8), often[one].astype(np.uint8)))
                here = ~often[rows]
                out["places"].append(_packed(oid[rows][here], hashes[rows][here], position[rows][here], unit[here]))
            yield _batch(bucket=out["bucket"], **{c: pa.array(out[c], pa.binary()) for c in ("texts", "units", "places")})

    return send


def window_minima(units: np.ndarray, windows: np.ndarray, least: np.ndarray, n: int) -> np.ndarray:
    """The smallest `least` of all units in which each window occurs, window by window.

    units is a text of symbols with a 0 after each unit; a unit has so many windows and n - 1 symbols more.
    """
    index = FmIndex(units, n)
    length, low = index.matching_statistics(units)
    unit_of = np.cumsum(units == 0)[index.order]
    unit_of[units[index.order] == 0] -= 1
    heads = np.flatnonzero(index.shared < n)
    lowest = np.minimum.reduceat(least[unit_of], heads)
    sizes = windows + n
    begins = np.cumsum(sizes) - sizes
    at = np.repeat(begins - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    if (length[at] < n).any():
        raise AssertionError("a unit is missing from its own index")
    return lowest[np.searchsorted(heads, low[at], side="right") - 1]


def _symbols(texts: list[bytes], n: int, windows: np.ndarray) -> np.ndarray:
    known: dict[bytes, int] = {}
    out = np.zeros(int((windows + n).sum()), np.int64)
    words = b" ".join(texts).split(b" ")
    filled = np.ones(len(out), bool)
    filled[np.cumsum(windows + n) - 1] = False
    out[filled] = [known.setdefault(w, len(known) + 1) for w in words]
    return out


_MARKS = "oid bigint, hash bigint, pos int, mask bigint, window binary, least bigint"


def _bucket_marks(n: int) -> Callable:
    """Marks of a bucket's occurrences, and the shared windows of its frequent keys."""

    def judge(rows: pa.Table) -> pa.Table:
        import zstandard

        known: dict[bytes, int] = {}
        units, places = [], []
        for texts, unit, place in zip(*(rows.column(c) for c in ("texts", "units", "places")), strict=True):
            number = np.array([known.setdefault(t, len(known)) for t in zstandard.ZstdDecompressor().decompress(texts.as_py()).split(b"\n")], np.int64)
            units.append((number, *_unpacked(unit.as_py(), "<u8", "<i8", "<i8", "u1", "u1")))
            *at, local = _unpacked(place.as_py(), "<i8", "<i8", "<i4", "<i4")
            places.append((*at, number[local]))
        number, keys, lows, highs, counts, oftens = (np.concatenate(c) for c in zip(*units, strict=True))
        key, windows, often = (np.zeros(len(known), c.dtype) for c in (keys, counts, oftens))
        key[number], windows[number], often[number] = keys, counts, oftens
        low, high = np.full(len(known), LAST), np.full(len(known), -LAST - 1)
        np.minimum.at(low, number, lows)
        np.maximum.at(high, number, highs)
        # Only keys that come in two documents can share a window.
        _, same = np.unique(key, return_inverse=True)
        least, most = np.full(len(known), LAST), np.full(len(known), -LAST - 1)
        np.minimum.at(least, same, low)
        np.maximum.at(most, same, high)
        chosen = np.flatnonzero((least < most)[same])
        chosen = chosen[np.argsort(key[chosen], kind="stable")]
        windows = windows.astype(np.int64)
        total = np.cumsum(windows[chosen] + n)
        fresh = np.diff(key[chosen], prepend=key[chosen][:1]) != 0
        cuts = [0]
        for at in np.flatnonzero(fresh).tolist():  # a shard ends at the first new key after SHARD_WORDS
            if total[at - 1] - (total[cuts[-1] - 1] if cuts[-1] else 0) >= SHARD_WORDS:
                cuts.append(at)
        texts = list(known)
        begin, minima, done = np.full(len(known), -1), [], 0
        for part in np.split(chosen, cuts[1:]) if len(chosen) else []:
            minima.append(window_minima(_symbols([texts[u] for u in part.tolist()], n, windows[part]), windows[part], low[part], n))
            begin[part] = done + np.cumsum(windows[part]) - windows[part]
            done += int(windows[part].sum())
        minima = np.concatenate(minima) if minima else np.zeros(0, np.int64)
        oid, hashes, position, unit = (np.concatenate(c) for c in zip(*places, strict=True))
        here = np.flatnonzero(begin[unit] >= 0)
        oid, hashes, position, unit = oid[here], hashes[here], position[here], unit[here]
        count = windows[unit]
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        earlier = minima[np.repeat(begin[unit], count) + nth] < np.repeat(oid, count)
        bits = earlier.astype(np.uint64) << nth.astype(np.uint64)
        mask = np.bitwise_or.reduceat(bits, np.cumsum(count) - count).view(np.int64) if len(unit) else np.zeros(0, np.int64)
        kept = mask != 0
        shared = np.flatnonzero((often == 1) & (low < high))
        blank = lambda k, kind: pa.nulls(k, kind)
        marks = [pa.array(oid[kept]), pa.array(hashes[kept]), pa.array(position[kept]), pa.array(mask[kept]), blank(int(kept.sum()), pa.binary()), blank(int(kept.sum()), pa.int64())]
        found = [blank(len(shared), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64())] + [pa.array([texts[u] for u in shared.tolist()], pa.binary()), pa.array(minima[begin[shared]])]
        names = [c.split()[0] for c in _MARKS.split(", ")]
        return pa.concat_tables([pa.Table.from_arrays(marks, names), pa.Table.from_arrays(found, names)])

    return judge


def _frequent_places(docs: DataFrame, n: int, frequent) -> DataFrame:
    """(oid, hash, pos, window) of every window of a frequent key."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _slices(batches):
            found = Slice(texts)
            start, windows, _, often = found.units(n, frequent.value)
            start = start[often]
            doc = np.searchsorted(found.first, start, side="right") - 1
            oid, hashes = (batch.column(c).to_numpy()[doc] for c in ("oid", "hash"))
            yield _batch(oid=oid, hash=hashes, pos=(start - found.first[doc]).astype(np.int32), window=pa.array(found.texts(start, np.full(len(start), n)), pa.binary()))

    return _rows(docs).mapInArrow(places, "oid bigint, hash bigint, pos int, window binary")


def _kept(n: int, frequent, lookup) -> Callable:
    """The texts without the marked windows' words."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _slices(batches):
            counts = np.array([t.count(b" ") + 1 if t else 0 for t in texts])
            first = np.cumsum(counts) - counts
            change = np.zeros(int(counts.sum()) + 1, np.int64)
            marks = batch.column("marks")
            doc = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(marks), 0).to_numpy())
            if len(doc):
                mark = marks.flatten()
                which, nth = np.nonzero(np.unpackbits(mark.field("mask").to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                starts = first[doc[which]] + mark.field("pos").to_numpy()[which] + nth
                np.add.at(change, starts, 1)
                np.subtract.at(change, starts + n, 1)
            if lookup.value:
                found = Slice(texts)
                start, _, _, often = found.units(n, frequent.value)
                start = start[often]
                oid = batch.column("oid").to_numpy()[np.searchsorted(found.first, start, side="right") - 1]
                least = np.array([lookup.value.get(w, LAST) for w in found.texts(start, np.full(len(start), n))], np.int64)
                start = start[least < oid]
                np.add.at(change, start, 1)
                np.subtract.at(change, start + n, 1)
            stays = np.cumsum(change[:-1]) == 0
            left = np.add.reduceat(np.append(stays, False), first) * (counts > 0) if len(first) else counts
            kept = [t if n_left == n_all else b" ".join(compress(t.split(b" "), stays[at : at + n_all].tolist())) for t, n_left, n_all, at in zip(texts, left.tolist(), counts.tolist(), first.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.binary()), pa.array(counts, pa.int64()), pa.array(counts - left, pa.int64())], ["row", "kept", "n_words", "n_removed"])

    return keep


def window_marks(docs: DataFrame, n: int, frequent, words: int) -> DataFrame:
    """The marks and the shared windows of frequent keys, as rows of _MARKS."""
    buckets = max(1, -(-words // BUCKET_WORDS))
    sent = _rows(docs).mapInArrow(_sent(n, buckets, frequent), "bucket bigint, texts binary, units binary, places binary")
    return sent.groupBy("bucket").applyInArrow(_bucket_marks(n), _MARKS)


def dedup_substrings(docs: DataFrame, n: int = WINDOW_WORDS, frequent: int = FREQUENT, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """docs with the repeated words taken out of their texts, and n_words and n_removed.

    Words are what white space (space, tab to carriage return) separates, unchanged; a text comes
    back as its kept words with one space between them. A word goes if a window of n words (2 or
    more) over it begins, word for word, in a document with a smaller doc_id too; windows are judged
    on the input. All rows and columns stay; columns named n_words or n_removed are replaced. A null
    text has no words and stays null; a text of fewer than n words has no window and loses nothing;
    texts of any length are read whole. A null doc_id counts as the largest bigint; documents with
    equal ids do not take words from each other, so repeated rows lose the same words. An empty
    table gives no rows.
    """
    if n < 2:
        raise ValueError("windows have two words or more")
    docs = docs.drop("n_words", "n_removed")
    send = docs.sparkSession.sparkContext.broadcast
    keys, words = frequent_keys(docs, n, frequent)
    keys = send(keys)
    marks = durable(window_marks(docs, n, keys, words))
    places = marks.where("mask is not null").select("oid", "hash", "pos", "mask")
    shared = marks.where("window is not null").select("window", "least")
    small = shared.where(F.length("window") <= WINDOW_BYTES)
    lookup = {}
    if shared.count() <= broadcast_windows and shared.count() == small.count():
        lookup = {bytes(w): least for w, least in small.collect()}  # broadcast_windows rows of WINDOW_BYTES at most
    else:
        met = _frequent_places(docs, n, keys).join(shared, "window").where("least < oid")
        places = places.unionByName(met.select("oid", "hash", "pos", F.lit(1).cast("bigint").alias("mask")))
    by_row = places.groupBy("oid", "hash").agg(F.collect_set(F.struct("pos", "mask")).alias("marks"))
    made = _rows(docs, F.struct(*docs.columns).alias("row"))
    joined = made.join(by_row, ["oid", "hash"], "left")
    kind = T.StructType([made.schema["row"], T.StructField("kept", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    out = joined.select("row", "oid", "text", "marks").mapInArrow(_kept(n, keys, send(lookup)), kind)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept").cast("string"))
    return out.select(*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns), "n_words", "n_removed")
