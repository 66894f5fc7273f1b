"""Near-duplicates by SimHash: a segment-popcount embedding with a grid range-join.

A 64-bit fingerprint is embedded as 48 bit counts of segments: in each half, 16 segments of one bit
and 8 of two. (Wider segments would make fewer grid points and many more chance meetings.) The
Manhattan distance of two such vectors never exceeds the Hamming distance of their fingerprints.
With at most 4 differing bits, at least one half of the vector (24 counts) is within Manhattan
distance 2, and then some grid point lies within 1 of both. So each fingerprint is posted at its
own point of each half and at the points next to it, and fingerprints that meet are compared bit by
bit. No link is lost: the grid only proposes.

Points with a single fingerprint are dropped by a window. In crowded points, every fingerprint is
first compared with the point's smallest one; the components of these links then let the pairwise
comparison leave out pairs that are connected already, so that a dense group does not emit all its
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ROW_KEY, components, durable, one_of_each, text_of, with_row_key

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None) -> int:
    """Unsigned SimHash of one text; 0 when it has no words."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return 0
    joined, n = b" ".join(found), max(1, len(found) - SHINGLE_WORDS + 1)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[SHINGLE_WORDS - 1 :].tolist() if len(found) >= SHINGLE_WORDS else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    columns = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        signed = np.fromiter((fingerprint(x.as_py()) for x in texts), np.uint64, len(texts)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(signed)], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) with fp as a signed 64-bit integer; a null text counts as empty."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id bigint, text_hash bigint, fp bigint")


def _cell(half: Column) -> Column:
    """32 bits as a grid point: the low 16 are counts of one bit each, the high 16 become 8 counts of two."""
    pairs = F.shiftright(half, 16)
    counts = pairs - F.shiftright(pairs, 1).bitwiseAND(F.lit(0x5555))  # both bits of a pair, summed in place
    return half.bitwiseAND(F.lit(0xFFFF)) + F.shiftleft(counts, 16)


def _ball(cell: Column) -> Column:
    """A grid point and the points that differ by 1 in one count."""
    near = [cell] + [cell.bitwiseXOR(F.lit(1 << i)) for i in range(16)]
    for i in range(16, 32, 2):
        count = F.shiftright(cell, i).bitwiseAND(F.lit(3))
        near += [F.when(count < 2, cell + F.lit(1 << i)), F.when(count > 0, cell - F.lit(1 << i))]
    return F.array_compact(F.array(*near))


def _posts(fps: DataFrame) -> DataFrame:
    """(cell, fp): every grid point at which a fingerprint is posted; bit 32 tells the halves apart."""
    low, high = _cell(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))), _cell(F.shiftrightunsigned("fp", 32))
    cells = F.concat(_ball(low), F.transform(_ball(high), lambda c: c + F.lit(1 << 32)))
    return fps.select("fp", F.explode(cells).alias("cell"))


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for each distinct fingerprint of the frame that links to another one.

    fps holds distinct values in the column fp. Two link at max_bits (4 at most) or fewer differing
    bits; root is the smallest fingerprint, as a signed number, of the connected group.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the grid is exact for at most 4 differing bits")
    at = Window.partitionBy("cell")
    posts = _posts(fps.select("fp")).select("cell", "fp", F.count(F.lit(1)).over(at).alias("n"), F.min("fp").over(at).alias("pivot"))
    crowded = durable(posts.where("n > 1").drop("n"))
    first = crowded.where((F.col("fp") != F.col("pivot")) & (_apart("fp", "pivot") <= max_bits))
    roots = durable(components(first.select(F.col("fp").alias("u"), F.col("pivot").alias("v"))))
    tagged = durable(crowded.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("cell", "fp", F.coalesce("root", "fp").alias("tag")))
    a, b = tagged.toDF("cell", "fp", "tag"), tagged.toDF("cell", "fp2", "tag2")
    met = a.join(b, (a["cell"] == b["cell"]) & (F.col("tag") < F.col("tag2")) & (_apart("fp", "fp2") <= max_bits))
    tops = durable(components(met.select(F.col("tag").alias("u"), F.col("tag2").alias("v")).distinct()))
    known = roots.unionByName(tops.select("node", F.col("node").alias("root"))).distinct()
    known = known.groupBy("node").agg(F.min("root").alias("root"))
    joined = known.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return joined.select(F.col("node").alias("fp"), F.coalesce("top", "root").alias("root"))


def _grouped(docs: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The documents' prints, and the group (root) of each distinct fingerprint with its least doc_id."""
    prints = durable(fingerprints(docs))
    distinct = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    return prints, distinct.join(near_components(distinct, max_bits), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def simhash_groups(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id.

    Texts are lower-cased (A-Z), cut into words and 4-word shingles (fewer words: the whole
    sequence), hashed with XXH64 and seed 42. component_id is the smallest doc_id that links of at
    most max_bits differing bits lead to, the row's own included; null doc_ids are passed over, and
    a group of nulls alone has a null. Texts without words have fingerprint zero and link like any
    other. Repeated rows give repeated rows. An empty table gives no rows. Further columns of the
    input are not read.
    """
    prints, grouped = _grouped(docs, max_bits)
    # Written down, so that the join's sides are plain exchanges: of a root that very many fingerprints have, their side can then be dealt to several tasks.
    least = durable(grouped.groupBy("root").agg(F.min("least").alias("component_id")))
    heads = grouped.join(least, "root").select("fp", "component_id")
    return prints.join(heads, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of docs that stay when one document of each near-duplicate group does.

    The row with the smallest doc_id stays (null last; of equal ids the text with the smallest
    hash; of repeated rows one). All columns are kept, whatever they are called. An empty table
    gives no rows.
    """
    prints, grouped = _grouped(docs, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    best = prints.groupBy("fp").agg(F.min(order).alias("best")).join(grouped.select("fp", "root"), "fp")
    stay = best.groupBy("root").agg(F.min("best").alias("best"))
    stay = stay.select(F.col("best.unknown").alias("unknown"), F.coalesce("best.doc_id", F.lit(0).cast("bigint")).alias("id"), F.col("best.text_hash").alias("hash"))
    return one_of_each(with_row_key(docs), ROW_KEY).join(stay, ROW_KEY, "left_semi").select("row.*")
