"""Text expressions: lists in a cell, titles, tokens, sentiment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delimiters of list cells, the year pattern and the two word lists.
DELIMITERS = {"pipe": "[|]", "mixed": r"[,\t\n]+"}
YEAR_PATTERN = r"\((\d{4})\)"
POSITIVE_WORDS = ("good", "great", "excellent", "amazing", "positive", "happy")
NEGATIVE_WORDS = ("bad", "terrible", "horrible", "negative", "sad", "angry")

# All whitespace of the Unicode BMP. Java's \s and SQL TRIM know fewer characters.
WHITESPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
WHITESPACE_CLASS = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


def strip(text: Column) -> Column:
    """Remove whitespace, Unicode included, from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def split_list(text: Column, kind: str) -> Column:
    """Parts of a list cell.

    ``pipe`` cuts at every bar and keeps parts as they are; ``mixed`` cuts at runs
    of comma, tab and newline and strips each part. Empty parts are kept.
    """
    parts = F.split(text, DELIMITERS[kind])
    return parts if kind == "pipe" else F.transform(parts, strip)


def title_year(title: Column) -> Column:
    """First parenthesised four-digit number, else null."""
    return F.regexp_extract(title, YEAR_PATTERN, 1).try_cast("int")


def _cut_at_blanks(text: Column) -> Column:
    """Lower-cased words; runs of whitespace leave empty entries between them."""
    blanked = F.translate(F.lower(text), WHITESPACE, " " * len(WHITESPACE))
    return F.split(blanked, " ")


def tokens(text: Column) -> Column:
    """Lower-cased words between runs of whitespace."""
    return F.array_remove(_cut_at_blanks(text), "")


def sentiment(
    text: Column,
    positive: Iterable[str] = POSITIVE_WORDS,
    negative: Iterable[str] = NEGATIVE_WORDS,
) -> Column:
    """``positive`` / ``negative`` when only that list has a whole-token hit.

    Both or neither give ``neutral``; null text gives null. Words must be lower case.
    """

    def label(words: Column) -> Column:
        good = F.arrays_overlap(words, F.array(*[F.lit(w) for w in positive]))
        bad = F.arrays_overlap(words, F.array(*[F.lit(w) for w in negative]))
        return (
            F.when(good & ~bad, "positive").when(bad & ~good, "negative").otherwise("neutral")
        )

    # The one-entry array binds the words, so that a text is cut once and not once for
    # every use of the words in the label.
    labelled = F.transform(F.array(_cut_at_blanks(text)), label)[0]
    return F.when(text.isNotNull(), labelled)
