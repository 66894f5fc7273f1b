"""Line deduplication by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. Two lines match when the Jaccard similarity of their sets is 0.8
or more, and a line goes if any earlier line matches it; "earlier" is the order of (doc_id, text
hash, line number). The steps:

1. Words are counted over the whole corpus in a fixed number of hash buckets; a word's rarity class
   is the logarithm of its bucket's count, without an upper end. Any one order of the words gives
   the same result; this one keeps frequent words out of the prefixes.
2. Equal sets collapse to their first occurrence.
3. Each remaining set is posted under its n - ceil(0.8 n) + 1 rarest words. Two matching sets meet
   under at least one. A frequent word among them is split: the set is posted under it together
   with each word that follows it in the prefix, so that no hot word's sets all meet. The length filter, the positional filter and the parity bits of the words
   (equal bits for equal sets, at most one differing bit for each word not shared) drop nearly all
   pairs that cannot match. A posting stays if any other one of its word passes them.
4. The words of the sets that have such postings are read once more, and candidates come in
   rounds. Where sets meet at a word they stand in the order of the word that
   follows it in their prefixes, so that near copies are neighbours, and each is tried against its
   neighbour. For a set whose neighbour is no candidate it is only noted under which words any
   earlier set is one: no pair is made. The neighbours are verified on their words. Sets noted or
   tried, and not matched by then, are tried against the earliest candidates of about their length,
   and what is left of them meets all earlier candidates under the noted words, with hashes of both
   sets' words at hand, up to the first that matches. So no step's rows grow faster than the postings,
   whatever the size of a group of near copies, and no match is missed.
5. Every later occurrence of a set, and every occurrence of a set with an earlier match, goes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WHITE, drop_durable, durable, plain_words, text_of

#: Hash buckets for counting words: at most three digits each go with the plan.
BUCKETS = 1 << 17
#: A word's code is its class above this many bits of its hash.
_HASH_BITS = 57
#: Words of buckets with so many words or more are frequent.
HOT_WORDS = 1 << 17
#: Sets up to so many words have one number of parity bits, the others two.
SHORT = 64
#: Up to so many rows, the list of lines to verify is broadcast (under 100 MB); beyond, it is shuffled.
BROADCAST_ROWS = 1_000_000
_LAST = (1 << 63) - 1
_KEY = ["d", "rk"]
_AT = ["d", "rk", "pos"]
_PARITY = ["parity0", "parity1"]


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """docs with the order keys d (doc_id, null last) and rk, and whether a (d, rk) comes more than once.

    rk tells different texts of one doc_id apart: a hash of the text, or 0 throughout if no doc_id
    has two texts, as hashes do not compress.
    """
    doc_id = F.col("doc_id").cast("bigint")
    keys = {"d": F.coalesce(doc_id, F.lit(_LAST)), "rk": F.xxhash64(text_of(), doc_id.isNull())}
    same = {"rk": F.lit(0).cast("bigint")}
    # Texts are read only where a d comes more than once.
    if docs.select(keys["d"].alias("d")).groupBy("d").count().where("count > 1").isEmpty():
        return docs.withColumns(keys | same), False
    groups = docs.select(*(c.alias(k) for k, c in keys.items())).groupBy("d").agg(F.min("rk").alias("low"), F.max("rk").alias("high"))
    several = not groups.where("low < high").isEmpty()
    return docs.withColumns(keys | ({} if several else same)), True


def _classes(docs: DataFrame) -> list[int]:
    """The rarity class of each hash bucket, from the counts of all words."""
    found = docs.select(F.explode(plain_words(text_of())).alias("w")).where("w <> ''")
    counted = found.groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    classes = [0] * BUCKETS
    for b, n in counted.collect():  # one row for each bucket at most
        classes[b] = min(63, int(math.log2(n) * 1.5))  # 63 is 2^42 words in one bucket
    return classes


def _line_words() -> Column:
    """The words of a row of `_lines`."""
    return F.array_remove(F.when(F.col("odd"), F.split("line", WHITE)).otherwise(F.split("line", " ")), "")


def _codes(words: Column, classes: list[int]) -> Column:
    """The distinct words as numbers, rarest first: 6 bits of class, 57 bits of hash."""
    known = F.split(F.lit(",".join(map(str, classes))), ",").cast("array<bigint>")

    # Spark interprets what is in a lambda, so there is as little as can be in this one.
    def code(h: Column) -> Column:
        rarity = known[h.bitwiseAND(F.lit(BUCKETS - 1))]
        return F.coalesce(F.shiftleft(rarity, _HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - _HASH_BITS)), F.lit(0))

    # In two steps, as a hash that is used twice in one lambda is computed twice.
    hashes = F.array_distinct(F.transform(words, lambda word: F.xxhash64(word)))
    return F.sort_array(F.transform(hashes, code))


def _hot_class() -> int:
    """The rarity class from which words are frequent."""
    return int(math.log2(HOT_WORDS) * 1.5)


def _prefix(start: Column) -> Column:
    """The words of a start as 32 bits of their hashes."""
    return F.transform(start, lambda c: F.shiftright(F.shiftleft(c, 32), 32).cast("int"))


def _start(codes: Column) -> Column:
    """The codes of a set's prefix and the one after it."""
    n = F.size(codes)
    return F.slice(codes, 1, n - F.floor((4 * n + 4) / 5).cast("int") + 2)


def _cold(start: Column) -> Column:
    """How many words at the start of these are not frequent."""
    cold = lambda c: c < F.lit(_hot_class() << _HASH_BITS)
    return F.when(cold(F.get(start, F.size(start) - 1)), F.size(start)).otherwise(F.size(F.filter(start, cold)))


def _posts(prefix: str = "prefix", cold: str = "cold") -> Column:
    """struct(i, w, after) of each posting of a set: its place in the prefix, the key, and the word that follows.

    A prefix word that is not frequent is a key. A frequent one is a key with each later word of the
    prefix or the word after it: two matching sets share at least one prefix word, and with one word
    more on each side at least two. The rarest shared word is in both prefixes; if it is frequent,
    the second rarest is among the words with which it is posted in both.
    """
    words, p = F.col(prefix), F.size(prefix) - 1
    known = F.least(F.col(cold), p)
    after = lambda k: F.coalesce(F.get(words, k), F.lit(0))
    post = lambda i, w, k: F.struct(i.alias("i"), w.alias("w"), after(k).alias("after"))
    singles = F.transform(F.slice(words, 1, known), lambda w, i: post(i, w, i + 1))
    later = lambda i: F.transform(F.slice(words, i + 2, p - i), lambda w, k: post(i, F.hash(F.get(words, i), w), i + k + 2))
    pairs = F.flatten(F.transform(F.sequence(known, p - 1), later))
    return F.when(known < p, F.concat(singles, pairs)).otherwise(singles)


def _parity(codes: Column, k: int) -> Column:
    """64 bits that the words of a set flip; with k 0 or 1, only those of the words that fall to half k.

    Sets up to SHORT words have all their words in the first 64 bits and the others zero.
    """
    one = F.lit(1).cast("bigint")
    bit = lambda c: F.call_function("shiftleft", one, c.bitwiseAND(F.lit(63)).cast("int"))
    half = lambda acc, c: F.when(c.bitwiseAND(F.lit(64)) == 64 * k, acc.bitwiseXOR(bit(c))).otherwise(acc)
    none = F.lit(0).cast("bigint")
    short = F.lit(0).cast("bigint") if k else F.aggregate(codes, none, lambda acc, c: acc.bitwiseXOR(bit(c)))
    return F.when(F.size(codes) <= SHORT, short).otherwise(F.aggregate(codes, none, half))


def _lines(docs: DataFrame) -> DataFrame:
    """(d, rk, odd, pos, line) of every line with a word; odd: its text has white space other than spaces and line feeds."""
    texts = docs.select("d", "rk", text_of().alias("text"), text_of().rlike(r"[\x09\x0B-\x0D]").alias("odd"))
    lines = texts.select("d", "rk", "odd", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.where(F.when(F.col("odd"), F.col("line").rlike(r"[^\x20\x09-\x0D]")).otherwise(F.trim("line") != ""))


def _earlier(a: str, b: str) -> Column:
    """Whether set b comes before set a; both are the prefixes of column names."""
    (d, e), (r, q), (x, y) = ((F.col(f"{a}{k}"), F.col(f"{b}{k}")) for k in _AT)
    return (e < d) | ((e == d) & ((q < r) | ((q == r) & (y < x))))


def _plausible(a: str, b: str) -> Column:
    """Length, positional and parity filters on two postings of one word, as for the rarest word that both sets have.

    Matching sets meet under that one too, so no match is lost; under their other words they need not.
    """
    n, m, i, j = F.col(f"{a}n"), F.col(f"{b}n"), F.col(f"{a}i"), F.col(f"{b}i")
    shared = F.least(n - i, m - j)
    one, two = (F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}")) for p in _PARITY)
    apart = F.when(F.least(n, m) > SHORT, F.bit_count(one) + F.bit_count(two)).otherwise(F.bit_count(one.bitwiseXOR(two)))
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * shared >= 4 * (n + m)) & (9 * apart <= n + m)


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{prefix}{c}") for c in df.columns))


def _listed(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key is in keys, which are broadcast if there are few."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on, "left_semi")


def _words(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(d, rk, pos, words) of some sets; docs has a (d, rk) once, or a column `repeated`."""
    asked = durable(sets.select(*_AT).distinct())
    lines = _listed(_lines(docs), asked, _AT)
    if "repeated" in docs.columns:  # of rows equal in doc_id and text, any one will do
        lines = lines.groupBy(*_AT).agg(F.min("line").alias("line"), F.bool_or("odd").alias("odd"))
    words = durable(lines.select(*_AT, F.array_distinct(_line_words()).alias("words")))
    drop_durable(asked)
    return words


def _alike() -> Column:
    """Whether the words of a and b have a Jaccard similarity of 0.8 or more."""
    return 9 * F.size(F.array_intersect("a_words", "b_words")) >= 4 * (F.size("a_words") + F.size("b_words"))


def _set(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}{k}").alias(k) for k in _AT]


def _matched(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets a (d, rk, pos) for which a pair holds, by the words of both lines; written down."""
    both = pairs.join(_renamed(words, "a_"), [f"a_{k}" for k in _AT]).join(_renamed(words, "b_"), [f"b_{k}" for k in _AT])
    return durable(both.where(_alike()).select(*_set("a_")).distinct())


def _met() -> Column:
    """Two postings of one word whose sets may match, b the earlier one."""
    return (F.col("a_w") == F.col("b_w")) & _earlier("a_", "b_") & _plausible("a_", "b_")


def _partners(left: DataFrame, posted: DataFrame) -> DataFrame:
    """The postings that may match a later one of left."""
    few = _renamed(left, "a_")
    met = _renamed(posted, "b_").join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, _met(), "left_semi")
    return durable(met.select(*(F.col(f"b_{c}").alias(c) for c in left.columns)))


def _matched_by_earliest(words: DataFrame, left: DataFrame, partners: DataFrame) -> DataFrame:
    """The sets of left that match the earliest partner of about their length under a word.

    Variants of one line often match it and not each other; it is likely the first of its length.
    """
    at = [F.struct(*_AT, "i", *_PARITY)]
    earliest = partners.groupBy("w", "n").agg(F.min(*at).alias("x")).select("w", "n", "x.*")
    near = earliest.select("*", F.explode(F.array(F.col("n") - 1, F.col("n"), F.col("n") + 1)).alias("of"))
    a, b = _renamed(left, "a_"), _renamed(near, "b_")
    pairs = a.join(b, _met() & (F.col("a_n") == F.col("b_of"))).select(*(f"{s}{k}" for s in ("a_", "b_") for k in _AT))
    return _matched(words, pairs.distinct())


def _matched_by_any(words: DataFrame, left: DataFrame, partners: DataFrame) -> DataFrame:
    """The sets of left that match any partner, by their words."""
    a, b = (_renamed(x.join(words, _AT), p) for x, p in ((left, "a_"), (partners, "b_")))
    return a.join(b, _met() & _alike(), "left_semi").select(*_set("a_")).distinct()


def _meeting(sets: DataFrame) -> DataFrame:
    """The postings that another set's posting of the same word makes plausible, earlier or later: key, *_AT, n, *_PARITY, i, w."""
    carried = [*_AT, "n", *_PARITY]
    low = (1 << 32) - 1
    # One number has a set's word and, to order the sets under a word, the word that follows it.
    p = F.size("start") - 1
    cold = sets.where((F.col("n") >= 4) & (F.col("cold") >= p)).select(*carried, "start", F.posexplode(F.slice("start", 1, p)).alias("i", "c"))
    key = F.shiftleft("c", 32).bitwiseOR(F.get("start", F.col("i") + 1).bitwiseAND(F.lit(low)))
    hot = sets.where((F.col("n") >= 4) & (F.col("cold") < p)).select(*carried, _prefix(F.col("start")).alias("prefix"), "cold")
    hot = hot.select(*carried, F.explode(_posts()).alias("post")).select(*carried, "post.*")
    hot_key = F.shiftleft(F.col("w").cast("bigint"), 32).bitwiseOR(F.col("after").cast("bigint").bitwiseAND(F.lit(low)))
    keyed = cold.select(key.alias("key"), *carried, "i").unionByName(hot.select(hot_key.alias("key"), *carried, "i"))
    # Both sides of the join share the exchange by word; structs, or null checks that only one of them needs, would make it another one.
    keyed = keyed.where(" and ".join(f"{c} is not null" for c in keyed.columns))
    word = F.shiftright("key", 32)
    postings = keyed.repartition(word).withColumn("w", word)
    other = (F.col("a_d") != F.col("c_d")) | (F.col("a_pos") != F.col("c_pos")) | (F.col("a_rk") != F.col("c_rk"))
    met = _renamed(postings, "a_").join(_renamed(postings, "c_"), (F.col("a_w") == F.col("c_w")) & _plausible("a_", "c_") & other, "left_semi")
    return met.select(*(F.col(f"a_{c}").alias(c) for c in postings.columns))


def later_matches(docs: DataFrame) -> DataFrame:
    """(d, rk, gone): for each distinct (doc_id, text) of keyed docs, the line numbers to remove.

    Rows without a line to remove are left out.
    """
    classes = _classes(docs)
    codes = _lines(docs).select(*_AT, _codes(_line_words(), classes).alias("codes"))
    n, start = F.size("codes"), _start(F.col("codes"))
    parities = [_parity(F.col("codes"), k).alias(p) for k, p in enumerate(_PARITY)]
    # No filter on the codes: it would have them computed twice.
    lines = durable(codes.select(*_AT, F.xxhash64("codes").alias("set"), *parities, n.alias("n"), start.alias("start"), _cold(start).alias("cold")))
    same = ["set", *_PARITY, "n"]
    # The first two of each kind tell which is the first and whether there are more; each task keeps but two before the exchange.
    alike = Window.partitionBy(*same).orderBy(*_AT)
    two = lines.withColumn("k", F.row_number().over(alike)).where("k <= 2")
    sets = durable(two.withColumn("again", F.lead("k").over(alike).isNotNull()).where("k = 1").drop("k"))

    met = durable(_meeting(sets))
    words, row = _words(docs, met), ["w", *_AT, "n", *_PARITY, "i"]
    # The two uses of the postings share the exchange by word.
    postings = met.repartition("w")
    a = _renamed(postings, "a_")
    order = Window.partitionBy("a_w").orderBy("a_key", *(f"a_{k}" for k in _AT))
    ranked = a.select(*a.columns, *(F.lag(f"a_{c}").over(order).alias(f"b_{c}") for c in row[1:]))
    # Two words of one line can have the same w: then the neighbour is the line itself, which is not earlier.
    near = F.coalesce(_plausible("a_", "b_") & _earlier("a_", "b_"), F.lit(False))
    ranked = ranked.select(*(f"a_{c}" for c in row), *(F.when(near, F.col(f"b_{k}")).alias(f"b_{k}") for k in _AT))
    # A set with a neighbour to try meets at least its own posting here and stays.
    noted = F.col("b_d").isNotNull() | (_earlier("a_", "c_") & _plausible("a_", "c_"))
    tried = ranked.join(_renamed(postings, "c_"), (F.col("a_w") == F.col("c_w")) & noted, "left_semi")
    tried = durable(tried)
    pairs = tried.where("b_d is not null").select(*(f"{s}{k}" for s in ("a_", "b_") for k in _AT)).distinct()
    matched = _matched(words, pairs)
    left = durable(tried.select(*(F.col(f"a_{c}").alias(c) for c in row)).distinct().join(matched, _AT, "left_anti"))
    drop_durable(tried)
    if not left.isEmpty():
        partners = _partners(left, met.select(*row))
        more = _matched_by_earliest(words, left, partners)
        few = durable(left.join(more, _AT, "left_anti"))
        last = durable(_matched_by_any(words, few, _partners(few, partners)))
        for done in (left, few, partners):
            drop_durable(done)
        matched = matched.unionByName(more).unionByName(last)
    for done in (met, words):
        drop_durable(done)

    # Only sets that lose an occurrence are looked up among the lines.
    firsts = sets.join(matched.withColumn("matched", F.lit(True)), _AT, "left").where(F.col("again") | F.col("matched"))
    firsts = firsts.select(*same, *(F.col(k).alias(f"first_{k}") for k in _AT), F.coalesce("matched", F.lit(False)).alias("matched"))
    is_first = (F.col("d") == F.col("first_d")) & (F.col("rk") == F.col("first_rk")) & (F.col("pos") == F.col("first_pos"))
    gone = lines.select(*same, *_AT).join(firsts, same).where(F.col("matched") | ~is_first)
    return gone.groupBy(*_KEY).agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with the matching later lines taken out of their texts, and n_lines and n_removed.

    All columns of docs and all rows stay; a text is its kept lines, joined by line feeds again, so
    a text none of whose lines goes is unchanged. Lines without words are never removed. A null
    text has no lines and stays null. Of rows equal in doc_id and text, one keeps its lines and the
    others lose all that have words. Columns of docs named n_lines or n_removed are replaced. An
    empty table gives no rows.
    """
    docs = docs.drop("n_lines", "n_removed")
    held = [c for c in docs.columns if c not in ("doc_id", "text")]
    keyed, repeated = _keyed(docs.select("doc_id", "text", F.struct(*held, F.lit(0).alias("_")).alias("held")))
    first = F.lit(True)
    if repeated:
        # A minimum with map-side combining finds the row that stays, whatever the number of equal rows.
        keyed = durable(keyed.withColumn("row", F.monotonically_increasing_id()))
        stays = keyed.groupBy(*_KEY).agg(F.min("row").alias("row"))
        keyed = keyed.join(stays.withColumn("first", F.lit(True)), [*_KEY, "row"], "left")
        first = F.coalesce("first", F.lit(False))
    gone = later_matches(keyed.select("d", "rk", "text", *([F.lit(True).alias("repeated")] if repeated else [])))
    joined = keyed.join(gone, _KEY, "left").withColumn("all_lines", F.split(F.col("text"), "\n"))
    has_word = lambda x: F.length(F.regexp_replace(x, WHITE, "")) > 0
    others = F.filter("all_lines", lambda x, i: ~F.array_contains("gone", i))
    kept = F.when(~first, F.filter("all_lines", lambda x: ~has_word(x))).when(F.col("gone").isNull(), F.col("all_lines")).otherwise(others)
    out = joined.withColumn("kept_lines", kept)
    n_lines, n_kept = F.coalesce(F.size("all_lines"), F.lit(0)), F.coalesce(F.size("kept_lines"), F.lit(0))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(n_lines)
    n_kept = F.when(F.col("text").isNull(), 0).otherwise(n_kept)
    text = F.array_join("kept_lines", "\n")
    columns = (text.alias(c) if c == "text" else F.col(c) if c == "doc_id" else F.col("held").getField(c).alias(c) for c in docs.columns)
    return out.select(*columns, n_lines.cast("bigint").alias("n_lines"), (n_lines - n_kept).cast("bigint").alias("n_removed"))
