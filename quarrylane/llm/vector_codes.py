"""Vector code compression: product codes from integer k-means, with LAESA pivots.

Components become integers and vectors are cut into parts; each part position has a codebook that
starts as that part of the first vectors and moves to the floored means of its parts, round by
round. All arithmetic is exact in integers.

The distances of every part to a few fixed pivots (starting entries that lie far apart) are computed
once and stored with the parts. In each round only the entries' distances to the pivots are new:
the difference of a part's and an entry's distance to a pivot is a lower bound of the distance of
the two. Entries are tried in the order of their bounds, exactly, until the bound exceeds the best
distance found, so most of them are never evaluated. Square roots are floored, and the bound allows for it.

A task sends one row of sums per entry and component, and the driver holds the codebooks alone;
their size does not depend on the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import durable

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PIVOTS = 4
#: Up to so many labels, their sums are broadcast; beyond, the join is shuffled.
BROADCAST_LABELS = 100_000
_FAR = np.iinfo(np.int64).max


def largest(width: int) -> int:
    """Components up to this size keep all squared distances of parts of a width within 62 bits."""
    return isqrt((1 << 62) // (4 * width))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis."""
    return np.square(x - y).sum(axis=-1)


def floored_root(x: np.ndarray) -> np.ndarray:
    """The exact integer square root of numbers under 2^62."""
    root = np.sqrt(x.astype(np.float64)).astype(np.int64)
    root -= root * root > x
    return root + ((root + 1) * (root + 1) <= x)


def far_apart(entries: np.ndarray, count: int) -> np.ndarray:
    """Up to count of the entries, each the furthest from those before it, the first one first."""
    chosen = [0]
    nearest = squared(entries, entries[0])
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def to_pivots(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots): floored distances."""
    return np.stack([floored_root(squared(parts, p)) for p in pivots], axis=1)


def nearest_entries(parts: np.ndarray, known: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of the nearest entry for each part, ties to the lower index; and how many distances were evaluated.

    known are the parts' floored distances to the pivots.
    """
    theirs = to_pivots(entries, pivots)
    bound = np.zeros((len(parts), len(entries)), np.int64)
    for k in range(len(pivots)):  # two floored roots are off by less than 1 together
        np.maximum(bound, np.abs(known[:, k, None] - theirs[None, :, k]) - 1, out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    index, best, evaluated = np.zeros(len(parts), np.int64), np.full(len(parts), _FAR), 0
    rows = np.arange(len(parts))
    for k in range(len(entries)):
        low = bound[rows, order[rows, k]]
        rows = rows[low * low <= best[rows]]  # bounds ascend and the best falls, so who is out stays out
        if not len(rows):
            break
        evaluated += len(rows)
        entry = order[rows, k]
        distance = squared(parts[rows], entries[entry])
        better = (distance < best[rows]) | ((distance == best[rows]) & (entry < index[rows]))
        index[rows[better]], best[rows[better]] = entry[better], distance[better]
    return index, best, evaluated


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def _assigned(batch: pa.RecordBatch, codebooks: np.ndarray, pivots: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(parts, index, squared distance) for each part position."""
    n_parts, _, width = codebooks.shape
    values = _matrix(batch.column("values"), n_parts * width).reshape(-1, n_parts, width)
    known = _matrix(batch.column("known"), n_parts * len(pivots[0])).reshape(-1, n_parts, len(pivots[0]))
    for p in range(n_parts):
        index, best, _ = nearest_entries(values[:, p], known[:, p], codebooks[p], pivots[p])
        yield values[:, p], index, best


def kept_vectors(vectors: DataFrame, vector: str, scale: int, id_column: str, label: str) -> DataFrame:
    """(vec_id, label, values) of the rows whose vector has finite components only, as floored integers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", finite))
    return rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("values"))


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def train(known: DataFrame, codebooks: np.ndarray, pivots: list[np.ndarray], rounds: int) -> np.ndarray:
    """The codebooks after some rounds over rows of (values, known)."""
    n_parts, n_entries, width = codebooks.shape
    for _ in range(rounds):
        books = codebooks

        def sums(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            total = np.zeros((n_parts, n_entries, width + 1), np.int64)  # the last number counts
            for batch in batches:
                for p, (values, index, _) in enumerate(_assigned(batch, books, pivots)):
                    np.add.at(total[p, :, :width], index, values)
                    total[p, :, width] += np.bincount(index, minlength=n_entries)
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.ravel_multi_index(at, total.shape)), pa.array(total[at])], ["at", "total"])

        flat = np.zeros(n_parts * n_entries * (width + 1), object)
        for at, total in known.select("values", "known").mapInArrow(sums, "at bigint, total bigint").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect():
            flat[at] = int(total)  # one row per number of the codebooks
        found = flat.reshape(n_parts, n_entries, width + 1)
        codebooks = books.copy()
        for p in range(n_parts):
            for e in range(n_entries):
                if found[p, e, width]:
                    codebooks[p, e] = [x // found[p, e, width] for x in found[p, e, :width]]
    return codebooks


def compressed(
    vectors: DataFrame, vector: str = "embedding", id_column: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of each kept vector, and the codebooks (parts, entries, width).

    code is an array of entry indices in part order; error sums the squared distances to the
    entries over the parts, label_error the errors over the rows of an equal label (nulls together).
    Vectors that are null, or hold a null or a non-finite component, are left out, as are those of
    another length than the first kept vector, which can't be cut alike. The codebooks start as the
    vectors of the smallest ids (null last; of equal ids the smaller vector first); with fewer
    vectors than entries they are as short as that. Repeated rows count and come back as often as
    they come. An empty table gives no rows and empty codebooks. A length that parts does not divide,
    and components too large for exact 64-bit distances, raise an error. Other columns are not read.
    """
    kept = kept_vectors(vectors, vector, scale, id_column, label)
    starts = [r["values"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "values").select("values").limit(entries).collect()]
    columns = ["vec_id", "label", "code", "error", "label_error"]
    length = len(starts[0]) if starts else 0
    if not length:
        empty = kept.where(F.lit(False)).withColumns({"code": F.array().cast("array<int>"), "error": F.lit(0).cast("bigint"), "label_error": F.lit(0).cast("bigint")})
        return empty.select(*columns), np.zeros((parts, 0, 0), np.int64)
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    width = length // parts
    kept = kept.where(F.size("values") == length)
    if any(len(x) != length for x in starts):
        starts = [r["values"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "values").select("values").limit(entries).collect()]
    most = largest(width)
    codebooks = np.array(starts, np.int64).reshape(len(starts), parts, width).swapaxes(0, 1)
    fixed = [far_apart(codebooks[p], pivots) for p in range(parts)]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("values"), length)
            if values.size and (values.max() > most or values.min() < -most):
                raise ValueError(f"a component times {scale} is beyond {most}: its distances do not fit 64 bits")
            cut = values.reshape(-1, parts, width)
            known = np.concatenate([to_pivots(cut[:, p], fixed[p]) for p in range(parts)], axis=1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(known.reshape(-1)), known.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("values"), lists], ["vec_id", "label", "values", "known"])

    number, label_kind = T.LongType(), kept.schema["label"].dataType
    of = lambda **kinds: T.StructType([T.StructField(k, t) for k, t in kinds.items()])
    known = durable(kept.mapInArrow(measured, of(vec_id=number, label=label_kind, values=T.ArrayType(number), known=T.ArrayType(number))))
    books = train(known, codebooks, fixed, rounds)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_assigned(batch, books, fixed))
            codes = np.stack([index for _, index, _ in found], axis=1).astype(np.int32)
            error = np.sum([best for _, _, best in found], axis=0, dtype=np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.reshape(-1)), parts).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), lists, pa.array(error)], ["vec_id", "label", "code", "error"])

    out = durable(known.mapInArrow(coded, of(vec_id=number, label=label_kind, code=T.ArrayType(T.IntegerType()), error=number)))
    sums = durable(out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"))
    sums = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    return out.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(*columns), books


def code_text(code: str = "code"):
    """A code as text: two hex digits for each index."""
    return F.lower(F.array_join(F.transform(code, lambda i: F.lpad(F.hex(i), 2, "0")), ""))
