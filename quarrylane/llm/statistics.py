"""Text statistics as DataFrame columns, for the quality rules and the quality classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import text_of, words

_SPACES = " \n\t\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
_WINDOW = 3


def _without(text: Column, chars: str) -> Column:
    """A text without some characters: one fast pass for each."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _count(text: Column, chars: str) -> Column:
    """How many characters of a text are among chars."""
    return (F.char_length(text) - F.char_length(_without(text, chars))).cast("bigint")


def _count_range(text: Column, pattern: str) -> Column:
    """How many characters of a text match a pattern for one character."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("bigint")


def _split(docs: DataFrame) -> DataFrame:
    """docs with __text, __words and __lines (the lines that have a word)."""
    with_text = docs.withColumn("__text", text_of())
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return with_text.withColumns({"__words": words(F.col("__text")), "__lines": lines})


def _repeat_words(found: Column) -> Column:
    """Words that lie in a three-word window found at least twice in the text."""
    def covered(h: Column) -> Column:
        runs = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (_WINDOW - 1), F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

        def places(win: Column) -> Column:
            ordered = F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
            of = lambda s: F.filter(s, lambda x, i: (F.get(s, i - 1).getField("h").eqNullSafe(x.getField("h"))) | (F.get(s, i + 1).getField("h").eqNullSafe(x.getField("h"))))
            twice = F.get(F.transform(F.array(ordered), of), F.lit(0))
            at = F.sort_array(F.transform(twice, lambda x: x.getField("i")))
            reach = lambda p: F.transform(p, lambda x, k: F.least(F.lit(_WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(_WINDOW))))
            lengths = F.get(F.transform(F.array(at), reach), F.lit(0))
            total = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
            return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0).cast("bigint")).otherwise(total)

        return F.get(F.transform(F.array(runs), places), F.lit(0))

    hashes = F.transform(found, lambda w: F.xxhash64(w))
    return F.get(F.transform(F.array(hashes), covered), F.lit(0))


def with_counts(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper and n_marks.

    Words are what white space (ASCII) separates; n_dup_lines counts lines with a word that equal
    an earlier line of the text; n_repeat_words counts the words in three-word windows that occur
    at least twice, the first included; n_upper counts A to Z, n_marks counts exclamation marks. A
    null text has no words. Columns with the new names are replaced; columns named __text, __words
    or __lines are lost (callers with others' columns pass them as one struct).
    """
    split = _split(docs)
    text = F.col("__text")
    return split.withColumns(
        {
            "n_words": F.size("__words").cast("bigint"),
            "word_chars": F.char_length(_without(text, _SPACES)).cast("bigint"),
            "n_symbols": _count(text, SYMBOLS),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": _repeat_words(F.col("__words")),
            "n_upper": _count_range(text, "[A-Z]"),
            "n_marks": _count(text, "!"),
        }
    ).drop("__text", "__words", "__lines")


FEATURES = ("n_words", "word_length", "symbols", "upper", "marks", "digits", "bars", "distinct_words", "same_next", "dup_lines", "line_words", "ended_lines")


def with_features(docs: DataFrame) -> DataFrame:
    """docs with the doubles named in FEATURES; all are 0 for a text without words. Names clash as in `with_counts`."""
    split = _split(docs)
    text, found, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    n, chars, rows = F.size(found), F.char_length(_without(text, _SPACES)), F.size(lines)
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    same = lambda w: F.size(F.filter(w, lambda x, i: F.get(w, i + 1).eqNullSafe(x)))
    return split.withColumns(
        {
            "n_words": n.cast("double"),
            "word_length": share(chars, n),
            "symbols": share(_count(text, SYMBOLS), chars),
            "upper": share(_count_range(text, "[A-Z]"), chars),
            "marks": share(_count(text, "!"), n),
            "digits": share(_count_range(text, "[0-9]"), chars),
            "bars": share(_count(text, "|"), n),
            "distinct_words": share(F.size(F.array_distinct(found)), n),
            "same_next": share(same(found), n),
            "dup_lines": share(rows - F.size(F.array_distinct(lines)), rows),
            "line_words": share(n, rows),
            "ended_lines": share(F.size(F.filter(lines, lambda x: x.rlike(r"[.!?:;][\x20\x09-\x0D]*$"))), rows),
        }
    ).drop("__text", "__words", "__lines")
