"""Stable keys that need no global counter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def txn_key(date, amount, description) -> Column:
    """Identity of a cleaned transaction; equal rows get equal keys."""
    return F.sha2(
        F.concat_ws("|", F.col(date).cast("string"), F.col(amount).cast("string"), F.col(description)),
        256,
    )


def category_key(name) -> Column:
    """60-bit category id from the category name; null stays null."""
    name = F.col(name) if isinstance(name, str) else name
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def month_label(date) -> Column:
    return F.date_format(date, "yyyy-MM")
