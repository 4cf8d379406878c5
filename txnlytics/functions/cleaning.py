"""Cleaning of raw statement cells: missing markers, dates, amounts, text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from txnlytics.params import MONEY, MONTHS, NA_TOKENS

# Java's Unicode whitespace plus the four separators Python also strips.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_SPACE_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

_TIME_SUFFIX = (
    r"[T ,]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([AaPp][Mm])?\s*(Z|[+-]\d{2}:?\d{2})?$"
)
_WEEKDAY = r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[, ]+"
_NAME = r"((?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?))"
_DAY_FIRST = rf"^(\d{{1,2}})[ /-]?{_NAME}[.,]?[ /-]?,? ?(\d{{4}}|\d{{2}})$"
_NAME_FIRST = rf"^{_NAME}[.]?[ /-]?(\d{{1,2}})(?:, ?|[ /-])(\d{{4}}|\d{{2}})$"
_MONTH_ONLY = rf"^{_NAME}[.,]?[ /-]?(\d{{4}})$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def missing_to_null(cell: Column) -> Column:
    """Null for every token that stands for a missing value."""
    return F.when(~cell.isin(*NA_TOKENS), cell)


# Each cell is cleaned in two steps, text then value. The caller keeps them in two
# projections, so that the text is computed once however often the value refers to it.


def date_text(cell: Column) -> Column:
    """Trimmed cell without a weekday before and a time of day after the date."""
    text = F.regexp_replace(missing_to_null(cell), _SPACE_ENDS, "")
    timeless = F.when(text.contains(":"), F.regexp_replace(text, _TIME_SUFFIX, "")).otherwise(text)
    return F.when(timeless.rlike("^[A-Za-z]"), F.regexp_replace(timeless, _WEEKDAY, "")).otherwise(timeless)


def _century(year: Column) -> Column:
    """Four-digit year; the POSIX pivot makes 69-99 19xx and 00-68 20xx."""
    return F.when(F.length(year) == 4, year).when(year >= "69", F.concat(F.lit("19"), year)).otherwise(F.concat(F.lit("20"), year))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _iso(year: Column, month: Column, day: Column) -> Column:
    """Cast of the parts, so invalid ones cost no parser exception."""
    return F.concat_ws("-", year, month, day).try_cast("date")


_FOUND = "="  # no date holds it


def _named_date(text: Column) -> Column:
    """``15 Jan 2024``, ``15Jan24``, ``Jan 15, 2024``, ``Jan 2024`` (its first day) and the like.

    Each shape is one regular expression, which lays the parts out as ``=year-name-day``.
    """
    months = F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS, 1) for x in (m, f"{k:02d}")])

    def laid_out(parts: Column) -> Column:
        month = F.element_at(months, F.lower(F.substring(parts[1], 1, 3)))
        return F.when(parts[0].startswith(_FOUND), _iso(_century(F.substring(parts[0], 2, 4)), F.coalesce(month, F.lit("x")), parts[2]))

    def shaped(pattern: str, layout: str) -> Column:
        return _bound(F.split(F.regexp_replace(text, pattern, _FOUND + layout), "-"), laid_out)

    return F.when(text.rlike(r"^\d"), shaped(_DAY_FIRST, "$3-$2-$1")).otherwise(
        F.coalesce(shaped(_NAME_FIRST, "$3-$1-$2"), shaped(_MONTH_ONLY, "$2-$1-01"))
    )


def _numeric_date(text: Column) -> Column:
    """d/m/Y, Y-m-d, d/m/y and Ymd; month-first only where day-first is impossible."""

    def laid_out(parts: Column) -> Column:
        a, b, c = parts[0], parts[1], parts[2]
        first, last = F.length(a), F.length(c)
        return F.when((first == 4) & (last <= 2), _iso(a, b, c)).when(
            (first <= 2) & last.isin(2, 4), F.coalesce(_iso(_century(c), b, a), _iso(_century(c), a, b))
        )

    plain = F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    return F.when(text.rlike(r"^\d{1,4}[/.-]\d{1,2}[/.-]\d{1,4}$"), _bound(F.split(F.translate(text, "/.", "--"), "-"), laid_out)).when(
        text.rlike(r"^\d{8}$"), _iso(*plain)
    )


def parse_date(text: Column) -> Column:
    """Day-first date from one text, each judged on its own; null if none.

    Accepts d/m/Y with ``/ - .``, Y-m-d with ``/ - .``, Ymd, d/m/y, and month names
    before or after the day. Month-first is only tried where day-first is impossible. A look for a letter
    decides which shapes are tried at all.
    """
    return F.when(text.rlike("[A-Za-z]"), _named_date(text)).otherwise(_numeric_date(text))


def amount_text(cell: Column) -> Column:
    """Cell stripped of currency marks and thousands commas; ``(x)`` becomes ``-x``.

    The marks are the single characters of the class below, not whole words, so
    ``Rs. 500`` keeps its dot and reads 0.50.
    """
    text = F.regexp_replace(missing_to_null(cell), _SPACE_ENDS, "")
    text = F.regexp_replace(text, r"^\((.+)\)$", "-$1")
    return F.regexp_replace(text, r"(?U)[RsPKpkr$£€₹\s\x1c-\x1f,]", "")


def parse_amount(text: Column) -> Column:
    """Non-negative amount with two decimals; null if not a number.

    Rounded as binary numbers are: scaled by a hundred, then halves to even, so 1.015 is 1.01.
    """
    number = F.abs(F.when(text.rlike(_NUMBER), text.try_cast("double")))
    return (F.bround(number * 100, 0) / 100).try_cast(MONEY)


def description_text(cell: Column) -> Column:
    """Trimmed, lower-case, single-spaced text; may be empty."""
    return F.lower(F.trim(F.regexp_replace(missing_to_null(cell), _SPACE, " ")))


def parse_description(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
