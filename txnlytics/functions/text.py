"""Text preparation for the classifier."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from txnlytics.params import STOPWORDS


def words(text: Column, stopwords=STOPWORDS, min_length: int = 3) -> Column:
    """Lower-case a-z words of at least ``min_length`` letters, stopwords left out.

    One regular expression does the whole job, which keeps the expression inside
    generated code. Anything but a letter ends a word. Null text has no words.
    """
    kept = [w for w in stopwords if len(w) >= min_length]
    not_stopword = f"(?!(?:{'|'.join(kept)})(?![a-z]))" if kept else ""
    pattern = f"(?<![a-z]){not_stopword}[a-z]{{{min_length},}}"
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))


def not_blank(text: Column) -> Column:
    """True for a text with anything but (Unicode) blanks."""
    return text.rlike(r"(?U)[^\s\x1c-\x1f]")


def clean_text(text: Column) -> Column:
    """The kept words joined by single spaces; empty string for null."""
    return F.array_join(words(text), " ")
