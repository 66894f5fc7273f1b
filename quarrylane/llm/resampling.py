"""Target-distribution importance resampling over hashed word features.

A feature is a word, or with `max_n` 2 also a pair of consecutive words; its bucket is the CRC-32 of
its bytes modulo the number of buckets. A document's weight is the mean log-ratio of its features'
bucket shares in the target texts and in all documents, and the draw adds Gumbel noise from a hash
of the id to it: the highest sums are a weighted sample without replacement.

Head and tail of the vocabulary go different ways. Each task counts its features; those that make
up at least 1/HEAD of its own go on by name, all others are the tail and go into bucket totals by
their CRC directly. The named counts are added up over all tasks and their CRC is taken once per
feature; both together are the exact bucket totals. Features proved to be at least 1/HEAD of the
whole are the head, HEAD at most of each kind: their CRC states (of words) and buckets (of pairs)
are broadcast for the scoring pass. There, a feature of the head is looked up; an unseen one takes
the CRC directly, a pair going on from its first word's state. Where a feature is counted does not
change its bucket, so results do not depend on the head.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import numbered
from .shared import ROW_KEY, drop_durable, durable, one_of_each, text_of, with_row_key

BUCKETS = 10_000
MAX_N = 1
#: Each kind of feature has at most so many in the head.
HEAD = 1 << 16
#: Longer features are never in the head, so that its bytes are bounded too.
HEAD_BYTES = 64
#: A task's counter lets its tail go when it holds so many features.
HELD = 1 << 20
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
#: Digits, lower-case letters, and all bytes of characters beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased."""
    return _WORD.findall(text.lower()) if text else []


def pairs_of(words: list[bytes]) -> list[bytes]:
    return [a + b" " + b for a, b in zip(words, words[1:], strict=False)]


def _counts(max_n: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's counts: (feature, size, n) of its head, (null, bucket, n) of its tail."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, tail = [Counter() for _ in range(max_n)], Counter()
        totals = [0] * max_n

        def let_go(k: int) -> None:
            stay = Counter()
            for feature, n in kinds[k].items():
                if n * HEAD >= totals[k] and len(feature) <= HEAD_BYTES:
                    stay[feature] = n
                else:
                    tail[crc32(feature) % buckets] += n
            kinds[k] = stay

        for batch in batches:
            for text in batch.column("text"):
                words = words_of(text.as_py())
                for k, features in enumerate((words, pairs_of(words) if max_n > 1 else [])[:max_n]):
                    kinds[k].update(features)
                    totals[k] += len(features)
                    if len(kinds[k]) > HELD:
                        let_go(k)
        for k in range(max_n):
            let_go(k)
        named = [(f, k + 1, n) for k in range(max_n) for f, n in kinds[k].items()] + [(None, b, n) for b, n in tail.items()]
        features, sizes, numbers = zip(*named, strict=True) if named else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(features, pa.binary()), pa.array(sizes, pa.int32()), pa.array(numbers, pa.int64())], ["feature", "at", "n"])

    return count


def _text_bytes(rows: DataFrame) -> Column:
    return F.encode(F.col("text").cast("string"), "UTF-8").alias("text")


def bucket_totals(rows: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> tuple[dict[int, int], list[list[bytes]]]:
    """The exact number of features in each bucket over all texts of rows, and the head: frequent words, and frequent pairs."""
    sent = rows.select(_text_bytes(rows)).mapInArrow(_counts(max_n, buckets), "feature binary, at int, n bigint")
    summed = durable(sent.groupBy("feature", "at").agg(F.sum("n").alias("n")))
    bucket = F.when(F.col("feature").isNull(), F.col("at")).otherwise((F.crc32("feature") % buckets).cast("int"))
    totals = {b: n for b, n in summed.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).collect()}  # one row per bucket at most
    least = -(-sum(totals.values()) // HEAD)
    heads = [[] for _ in range(max_n)]
    for feature, size in summed.where(F.col("feature").isNotNull() & (F.col("n") >= least)).select("feature", "at").collect():  # HEAD rows at most
        heads[size - 1].append(bytes(feature))
    drop_durable(summed)
    return totals, heads


def gains(target: dict[int, int], source: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Thousandths of the log-ratio of a bucket's shares, floored; each bucket has one feature more than counted."""
    t_all, s_all = float(sum(target.values()) + buckets), float(sum(source.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((source.get(b, 0) + 1.0) * t_all))) for b in range(buckets)]


def _weights(docs: DataFrame, heads: list[list[bytes]], gain: list[int], max_n: int, buckets: int) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight) of each row."""
    states = {w: crc32(w) for w in heads[0]}
    pair_buckets = {p: crc32(p) % buckets for p in heads[1]} if max_n > 1 else {}
    sent = docs.sparkSession.sparkContext.broadcast((states, pair_buckets, gain))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, pair_buckets, gain = sent.value
        of_word, of_pair = {w: gain[s % buckets] for w, s in states.items()}, {p: gain[b] for p, b in pair_buckets.items()}
        for batch in batches:
            counts, features, weights = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                total, n = 0, len(words)
                for w in words:
                    g = of_word.get(w)
                    total += gain[crc32(w) % buckets] if g is None else g
                if max_n > 1:
                    for a, b in zip(words, words[1:], strict=False):
                        g = of_pair.get(a + b" " + b)
                        if g is None:
                            state = states.get(a)
                            g = gain[crc32(b" " + b, crc32(a) if state is None else state) % buckets]
                        total += g
                    n += max(0, n - 1)
                counts.append(len(words))
                features.append(n)
                weights.append(total // n if n else 0)
            numbers = [pa.array(x, pa.int64()) for x in (counts, features, weights)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *numbers], ["doc_id", "text_hash", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), _text_bytes(docs))
    return rows.mapInArrow(weigh, "doc_id bigint, text_hash bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variable from a hash of seed and id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, text_hash, n_features, weight, score, rank.

    Features are counted over all of docs and of target (each has a column text). A null or empty
    text has no features and weight 0. rank is 1, 2, 3 and so on by descending score, ties to the
    smaller doc_id (null last), for the first floor(percent * N / 100) of the N documents with at
    least min_words words; null for the others. A null doc_id draws the noise of the word null.
    Repeated rows give repeated rows, with ranks of their own. An empty table gives no rows; an
    empty target makes all its shares equal. Other columns are not read.
    """
    if max_n not in (1, 2):
        raise ValueError("features are words, or words and pairs")
    source, heads = bucket_totals(docs, max_n, buckets)
    wanted, _ = bucket_totals(target, max_n, buckets)
    scored = _weights(docs, heads, gains(wanted, source, buckets), max_n, buckets)
    # Stored, as the range sort would compute it twice.
    scored = durable(scored.withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("bigint")))
    able = F.col("n_words") >= min_words
    draws = scored.where(able).count() * percent // 100
    order = [(~able).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc()]
    rank = F.when(F.col("place") <= draws, F.col("place")).cast("bigint")
    return numbered(scored, order, "place").select("doc_id", "text_hash", "n_features", "weight", "score", rank.alias("rank"))


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of docs that are drawn, with all their columns; `options` are those of `ranked`.

    Of rows equal in doc_id and text, one stays if any of them is drawn.
    """
    picked = ranked(docs, target, **options).where("rank is not null")
    key = picked.select(F.col("doc_id").isNull().alias("unknown"), F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("id"), F.col("text_hash").alias("hash"))
    return one_of_each(with_row_key(docs), ROW_KEY).join(key, ROW_KEY, "left_semi").select("row.*")
