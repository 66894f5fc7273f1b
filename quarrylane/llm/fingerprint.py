"""Document fingerprints: threshold-scaled sketches of five-word shingles, in DataFrame operations.

A sketch keeps every distinct shingle hash whose unsigned value is below a fixed fraction of the
64-bit range. Its size follows the text's, so that the sketch of a union is the union of the
sketches, and the share of a short text that a long one contains can be estimated from both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import successors
from .shared import durable, one_of_each, text_of, words

SHINGLE_WORDS = 5
#: Hashes below 2^64 / 4 stay.
SHIFT = 2
#: So many equal rows are written by one task.
COPIES = 1 << 16


def shingle_hashes(text: Column) -> Column:
    """The distinct hashes of a text's five-word shingles, sorted; fewer words make one shingle, none make none.

    A shingle's hash is the XXH64 of its words' XXH64 values.
    """
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        runs = F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (SHINGLE_WORDS - 1), F.lit(0))),
            lambda first, i: F.xxhash64(first, *(F.get(h, i + k) for k in range(1, SHINGLE_WORDS))),
        )
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= SHINGLE_WORDS, runs).otherwise(whole)

    once = F.transform(F.array(hashes), of)  # so that the words are hashed once, not at each use
    return F.array_sort(F.array_distinct(F.get(once, F.lit(0))))


def sketch(hashes: Column, shift: int = SHIFT) -> Column:
    """struct(n, total, kept): the number of distinct hashes, a hash of them all, and those kept."""
    keep = lambda h: F.shiftrightunsigned(h, 64 - shift) == 0  # noqa: E731  the unsigned value is below 2^(64-shift)
    of = lambda h: F.struct(F.size(h).cast("bigint").alias("n"), F.xxhash64(h).alias("total"), F.filter(h, keep).alias("kept"))
    return F.get(F.transform(F.array(hashes), of), F.lit(0))


def as_text(s: Column) -> Column:
    """A sketch as text: number of shingles, hash of them all, kept hashes; equal texts give equal ones."""
    digits = lambda h: F.lpad(F.hex(h), 16, "0")
    return F.lower(F.concat_ws(":", F.hex(s.getField("n")), digits(s.getField("total")), F.array_join(F.transform(s.getField("kept"), digits), "")))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the smaller sketch's shingles that the larger one has, 0 to 1.

    1 for two texts with the same shingles (none included). If just one sketch is empty, or both
    are and the texts differ, nothing is known to be shared: 0.
    """
    common = F.size(F.array_intersect(a.getField("kept"), b.getField("kept")))
    least = F.least(F.size(a.getField("kept")), F.size(b.getField("kept")))
    same = (a.getField("n") == b.getField("n")) & (a.getField("total") == b.getField("total"))
    return F.when(same, F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(common / least)


def merged(a: Column, b: Column) -> Column:
    """The kept hashes of the union of two texts' shingles."""
    return F.array_sort(F.array_union(a.getField("kept"), b.getField("kept")))


def edited_kinds(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, sketch, n_chars, edited, next, rows, times) and the largest `rows`.

    A kind is what equals in doc_id and text, `rows` rows of docs. There is a row for the last of a
    kind, and if it has others one for all of these; `times` says for how many. So a kind's text is
    read and sent once, whatever their number. edited is the edited text, next the next document's
    sketch: the one with the next smaller doc_id (null is the smallest; equal ids are in the order
    of their texts' hashes; after the last comes the first; all but the last of a kind are followed
    by their own text). The last floor(n/2) code points of a text of n are replaced by as many from
    the start of the next text, or all of it.
    """
    doc_id = F.col("doc_id").cast("bigint")
    base = docs.select(doc_id.isNull().alias("unknown"), F.coalesce(doc_id, F.lit(0)).alias("id0"), text_of().alias("text"))
    base = base.withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(1), "text")})
    key = ["unknown", "id0", "h", "g"]
    counted = base.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.max(F.char_length("text")).alias("n"))
    order = [F.col("unknown").asc(), F.col("id0").desc(), F.col("h").asc(), F.col("g").asc()]
    led = durable(successors(counted, order, key))
    most = led.agg(F.max("rows")).first()[0] or 1
    # One exchange of the texts serves both sides; sketches are made after it, as they do not compress.
    kinds = one_of_each(base, key) if most > 1 else base.repartition(*key)
    take = led.select("next.*", F.struct(*key).alias("to"), F.floor(F.col("n") / 2).cast("int").alias("take"), "rows")
    made = sketch(shingle_hashes(F.col("text")))
    sent = kinds.join(take, key).select("to.*", F.expr("substring(text, 1, take)").alias("head"), made.alias("next"), "rows")
    joined = kinds.join(sent, key).withColumn("sketch", made)
    if most > 1:
        share = lambda last, times: F.struct(F.lit(last).alias("last"), times.alias("times"))
        shares = F.array(share(True, F.lit(1).cast("bigint")), share(False, F.col("rows") - 1))
        joined = joined.select("*", F.inline(F.filter(shares, lambda s: s.getField("times") > 0)))
    else:
        joined = joined.withColumns({"last": F.lit(True), "times": F.col("rows")})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.when(F.col("last"), F.col("head")).otherwise(F.substr("text", F.lit(1), half)))
    following = F.when(F.col("last"), F.col("next")).otherwise(F.col("sketch"))
    return joined.select(F.when(~F.col("unknown"), F.col("id0")).alias("doc_id"), "text", "sketch", n.cast("bigint").alias("n_chars"), edited.alias("edited"), following.alias("next"), "rows", "times"), most


def _each(kinds: DataFrame, most: int, copies: int) -> DataFrame:
    """Each row `times` times; those of kinds with more than `copies` rows by several tasks, each so many at a time."""
    columns = [c for c in kinds.columns if c not in ("rows", "times")]
    if most == 1:
        return kinds.select(*columns)
    times = lambda rows: rows.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("_")).drop("_")
    few = times(kinds.where(F.col("rows") <= copies))
    if most <= copies:
        return few
    parts = kinds.where(F.col("rows") > copies).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / copies))))
    return few.unionByName(times(parts.withColumn("times", F.least(F.lit(copies), F.col("times") - F.col("part") * copies)).repartition("doc_id", "part")))


def fingerprint_pairs(docs: DataFrame, copies: int = COPIES) -> DataFrame:
    """A row per document: fingerprints of its text and its edited text, and their likeness.

    A null text counts as empty. Repeated rows give one row each. An only document is its own next
    one. An empty table gives no rows. Further columns of docs are not read.
    """
    kinds, most = edited_kinds(docs)
    made = kinds.withColumn("edited_sketch", sketch(shingle_hashes(F.col("edited")))).select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next")).alias("near_next"),
        "rows",
        "times",
    )
    return _each(made, most, copies)
