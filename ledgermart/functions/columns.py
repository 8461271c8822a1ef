"""Column expressions for cleaning, banding and guarded arithmetic.

Everything here returns a ``Column`` made of built-in functions.  Casts of free text use
``try_cast`` because ANSI mode raises on text that is not a number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_float(c: Column) -> Column:
    """Single-precision value of a number or of text; NULL when it is not a number."""
    return c.try_cast("float")


def as_int(c: Column) -> Column:
    """Integer part of a number or of text such as ``34.5``; NULL when it is not a number."""
    return c.try_cast("double").try_cast("int")


def without_underscores(c: Column) -> Column:
    return F.translate(c.cast("string"), "_", "")


def flag(condition: Column) -> Column:
    """Boolean that is False, not NULL, when the condition is unknown."""
    return F.coalesce(condition, F.lit(False))


def indicator(condition: Column) -> Column:
    """1 when the condition holds, else 0 (also when it is unknown)."""
    return F.when(condition, 1).otherwise(0)


def replace_when(c: Column, condition: Column, value: str) -> Column:
    """``value`` where the condition holds, otherwise the column itself (NULL stays NULL)."""
    return F.when(condition, F.lit(value)).otherwise(c)


PLACEHOLDER = r"^_+$"
SSN_CHARACTERS = r"^[0-9\-]+$"


def placeholder_to_unknown(c: Column) -> Column:
    return replace_when(c, c.rlike(PLACEHOLDER), "Unknown")


def _number_before(c: Column, word: str) -> Column:
    return F.regexp_extract(c, rf"(\d+)\s*{word}s?", 1).try_cast("int")


def duration_months(c: Column, missing_years: int | None = None) -> Column:
    """Months in text such as ``22 Years and 3 Months``.

    Text without a year part is NULL, or counts ``missing_years`` years when that is given.
    NULL text is always NULL.
    """
    years = _number_before(c, "Year")
    if missing_years is not None:
        years = F.when(c.isNotNull(), F.coalesce(years, F.lit(missing_years)))
    return years * 12 + F.coalesce(_number_before(c, "Month"), F.lit(0))


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` only where the denominator is above zero."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def clip(c: Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; unlike ``least``/``greatest`` a NULL stays NULL."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def any_null(cols: Sequence[str]) -> Column:
    """True when at least one of the columns is NULL; False for no columns."""
    if not cols:
        return F.lit(False)
    return reduce(add, [indicator(F.col(c).isNull()) for c in cols]) > 0


def band(c: Column, edges: Sequence[float], labels: Sequence[str], closed: str = "right") -> Column:
    """Name of the interval that holds the value; NULL outside all of them.

    ``closed`` tells which end belongs to an interval: ``(lo, hi]`` or ``[lo, hi)``.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    result = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (c > low) & (c <= high) if closed == "right" else (c >= low) & (c < high)
        result = F.when(inside, label) if result is None else result.when(inside, label)
    return result


def equal_width_bin(c: Column, low: Column, high: Column, bins: int) -> Column:
    """Index 0..bins-1 of equal-width bins over [low, high]; the last bin holds ``high``.

    When all values are equal the range is widened by half a unit on both sides.
    """
    lo = F.when(low == high, low - 0.5).otherwise(low).cast("double")
    hi = F.when(low == high, high + 0.5).otherwise(high).cast("double")
    place = F.floor((c.cast("double") - lo) * F.lit(float(bins)) / (hi - lo))
    return F.when(c == high, F.when(low == high, place).otherwise(bins - 1)).otherwise(
        F.least(place, F.lit(bins - 1))
    )


def title_words(c: Column) -> Column:
    """Capital letter at the start of every run of letters, as in ``Home-Equity Loan``."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def iso_day(c: Column) -> Column:
    """First ten characters of a date, timestamp or ISO text, as a date; NULL for other text."""
    return F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_number(c: Column) -> Column:
    """Running number of the calendar month, for differences in months."""
    return F.year(c) * 12 + F.month(c)


def exclude(columns: Sequence[str], *dropped: str) -> list[str]:
    return [c for c in columns if c not in dropped]


def with_prefix(columns: Sequence[str], prefix: str) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]
