"""URL filter: host and path rules, then a weighted vocabulary.

The rule whose host covers the url's host and whose path begins the url's path decides; the
longest wins. Without a rule, an Aho-Corasick automaton finds the vocabulary's terms in the url. A
term counts only between boundaries: no letter or digit stands right before or after it. Terms
have weights: one of weight 1 or more is strict and blocks a url alone, softer ones add up, each
counted once. In the vocabulary here, SOFT_LIMIT different soft terms reach 1. Others can be given,
or read from a table (`vocabulary_of`).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (action, host, path). A rule fits its host and all subdomains.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
STRICT = ("porn", "porno", "xxx", "hentai", "camgirls", "escorts", "warez", "phishing", "malware", "cheap-pills", "spam-farm", "casino-win")
SOFT = ("adult", "bet", "bets", "betting", "casino", "cheap", "crack", "free", "gambling", "jackpot", "loan", "loans", "nude", "pills", "poker", "sex", "spam", "torrent", "track", "ads", "viagra", "win")
SOFT_LIMIT = 2
#: A vocabulary from a table has at most so many terms.
MOST_TERMS = 100_000


def host_of(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash or the end; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(found, upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, action) columns of the longest fitting rule; null without one."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ordered]
    pick = lambda values: F.coalesce(*(F.when(f, F.lit(v)) for f, v in zip(fits, values, strict=True))) if ordered else F.lit(None).cast("string")
    return pick([h + p for _, h, p in ordered]), pick([a for a, _, _ in ordered])


def weights(strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT, soft_limit: int = SOFT_LIMIT) -> dict[str, float]:
    """Term -> weight: 1 for strict terms, and for soft ones the share of 1 of which soft_limit are needed."""
    return {t.lower(): 1.0 / soft_limit for t in soft} | {t.lower(): 1.0 for t in strict}


def vocabulary_of(terms: DataFrame, most: int = MOST_TERMS) -> dict[str, float]:
    """The weights of a table (term, weight), lower-cased; of a term that comes again, the largest counts.

    Rows without a term or a positive weight are left out. More than `most` terms are refused: the
    vocabulary goes with each task.
    """
    rows = terms.select(F.lower(F.trim(F.col("term").cast("string"))).alias("term"), F.col("weight").cast("double").alias("weight")).where("term <> '' and weight > 0")
    found = rows.groupBy("term").agg(F.max("weight").alias("weight")).limit(most + 1).collect()  # most + 1 rows at most
    if len(found) > most:
        raise ValueError(f"a vocabulary has at most {most} terms")
    return {r["term"]: r["weight"] for r in found}


def counter(vocabulary: dict[str, float]):
    """A function from a url to its numbers of different strict and soft terms, and the weight of all of them together."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term in vocabulary:
        automaton.add_word(term, term)
    if len(automaton):
        automaton.make_automaton()

    def count(url: str | None) -> tuple[int, int, float]:
        text, found = (url or "").lower(), set()
        for end, term in automaton.iter(text) if len(automaton) and text else ():
            start = end - len(term) + 1
            if not (start and text[start - 1].isalnum()) and not (end + 1 < len(text) and text[end + 1].isalnum()):
                found.add(term)
        strict = sum(vocabulary[t] >= 1 for t in found)
        return strict, len(found) - strict, math.fsum(vocabulary[t] for t in found)

    return count


def judged(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT, soft_limit: int = SOFT_LIMIT, vocabulary: dict[str, float] | None = None
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block), n_strict, n_soft.

    vocabulary (term -> weight) takes the place of strict and soft terms. A null url, or one without
    ://, has an empty host and path, and no rule fits an empty host. Urls of any length are read
    whole. Repeated rows give repeated rows; an empty table gives none; other columns are not read.
    """
    known = weights(strict, soft, soft_limit) if vocabulary is None else {t.lower(): w for t, w in vocabulary.items()}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(known)
        for batch in batches:
            found = [count(x) for x in batch.column("url").to_pylist()]
            numbers = [pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *numbers], ["page_id", "url", "n_strict", "n_soft", "weight"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    counted = rows.mapInArrow(counts, "page_id bigint, url string, n_strict bigint, n_soft bigint, weight double")
    split = counted.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, action = rule_for(F.col("host"), F.col("path"), rules)
    bad = (F.col("n_strict") > 0) | (F.col("weight") > 1 - 1e-9)  # thirds and the like do not add up to 1 exactly
    verdict = F.coalesce("action", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    return split.withColumns({"rule": rule, "action": action}).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "n_strict", "n_soft")
