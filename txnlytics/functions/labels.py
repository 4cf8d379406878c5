"""Labels, bands and display strings shared by detectors and reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from txnlytics.params import (
    CATEGORY_COLOURS,
    FALLBACK_COLOUR,
    SEVERITY_COLOURS,
    TREND_SYMBOLS,
    UNCATEGORISED,
    Params,
)


def is_expense(category: Column, p: Params) -> Column:
    """True unless income or transfer; a missing category counts as expense."""
    # Spelled so that a filter can be pushed to the scan.
    if UNCATEGORISED in p.non_expense:
        return category.isNotNull() & ~category.isin(*p.non_expense)
    return category.isNull() | ~category.isin(*p.non_expense)


def rupees(amount: Column) -> Column:
    """``Rs 1,234``; halves go to the even neighbour."""
    return F.concat(F.lit("Rs "), F.format_number(amount, 0))


def percent(share: Column) -> Column:
    return F.concat(F.format_number(share * 100, 0), F.lit("%"))


def fixed(number: Column, digits: int) -> Column:
    """Fixed-point text without thousands commas."""
    return F.regexp_replace(F.format_number(number, digits), ",", "")


def rounded(number: Column, digits: int) -> Column:
    """Rounded on the number's exact binary value, true halves to even."""
    return fixed(number, digits).cast("double")


def lookup(key: Column, table: dict[str, str], default: str) -> Column:
    """Value of a small fixed table, with a default."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def category_colour(category: Column, palette: dict[str, str] | None = None) -> Column:
    return lookup(category, palette or CATEGORY_COLOURS, FALLBACK_COLOUR)


def severity_colour(severity: Column) -> Column:
    return lookup(severity, SEVERITY_COLOURS, SEVERITY_COLOURS["medium"])


def trend_symbol(trend: Column) -> Column:
    return lookup(trend, TREND_SYMBOLS, "")


def severity_rank(severity: Column) -> Column:
    """3 high, 2 medium, 1 low, 0 otherwise."""
    return (
        F.when(severity == "high", 3).when(severity == "medium", 2).when(severity == "low", 1).otherwise(0)
    )


def zscore_severity(z: Column, p: Params) -> Column:
    return F.when(z > p.z_high, "high").when(z > p.z_medium, "medium").otherwise("low")


def forest_severity(score: Column, p: Params) -> Column:
    return F.when(score < p.forest_high, "high").when(score < p.forest_medium, "medium").otherwise("low")


def trend(slope: Column, p: Params) -> Column:
    return (
        F.when(slope > p.trend_band, "increasing").when(slope < -p.trend_band, "decreasing").otherwise("stable")
    )


def trend_note(slope: Column, p: Params) -> Column:
    size = F.format_number(F.abs(slope), 0)
    return (
        F.when(slope > p.trend_band, F.concat(F.lit("Spending is rising by ~Rs "), size, F.lit(" per month")))
        .when(slope < -p.trend_band, F.concat(F.lit("Spending is falling by ~Rs "), size, F.lit(" per month")))
        .otherwise("Spending is relatively stable month to month")
    )


def share_band(share: Column, p: Params) -> Column:
    """Bar colour of a budget share in percent."""
    return F.when(share > p.share_high, "#EF4444").when(share > p.share_medium, "#F59E0B").otherwise("#10B981")


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    pieces = F.split(F.lower(text), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )
