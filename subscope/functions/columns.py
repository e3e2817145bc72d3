"""Scalar column helpers.

All helpers take and return ``Column`` objects, so they compose inside one
projection and never leave whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no id" in the click extract.
NO_ID_TEXTS = ("", "NO_ID")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- ids and text -----------------------------------------------------------


def clean_id(c) -> Column:
    """Text id to a number; the "no id" texts and anything unparsable become null."""
    text = reduce(lambda acc, s: F.nullif(acc, F.lit(s)), NO_ID_TEXTS, col(c))
    return text.try_cast("bigint")


def blank_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def digits(c, keep: str = "0-9") -> Column:
    """Drop every character outside ``keep``."""
    return F.regexp_replace(col(c), f"[^{keep}]", "")


def digits_id(c) -> Column:
    """The number left after dropping non-digits, null when nothing is left."""
    return F.nullif(digits(c), F.lit("")).try_cast("bigint")


def extract_code(c) -> Column:
    """First code in brackets; null when the label carries none."""
    return blank_to_null(F.regexp_extract(col(c), r"\(([^)]*)\)", 1))


def strip_code(c) -> Column:
    """The label without its first bracketed code (only the first is removed)."""
    return F.regexp_replace(col(c), r"^([^(]*)\([^)]*\)", "$1")


def json_field(c, name: str) -> Column:
    """One top-level field of a JSON text."""
    return F.get_json_object(col(c), f"$.{name}")


def split_part(c, sep: str, i: int) -> Column:
    """The ``i``-th piece (from 1) of a text cut at a literal separator; null past the end."""
    return F.get(F.split(col(c), _literal_pattern(sep)), F.lit(i - 1))


def _literal_pattern(text: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in text)


def paste(cols: Sequence, sep: str = " ") -> Column:
    """Join texts; a null becomes the text ``NA`` and so still separates keys."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("NA")) for c in cols])


def order_key(a, b) -> Column:
    """Two-part order number."""
    return F.concat_ws("-", col(a).cast("string"), col(b).cast("string"))


def pct_label(c, k: int = 0) -> Column:
    """A share as percent text, rounded to ``k`` places."""
    pct = F.round(col(c) * 100, k)
    text = pct.cast("bigint").cast("string") if k == 0 else F.format_string(f"%.{k}f", pct)
    return F.concat(text, F.lit("%"))


# --- nulls, conditions --------------------------------------------------------


def is_true(c) -> Column:
    """``IS TRUE``: null counts as false."""
    return col(c).eqNullSafe(F.lit(True))


def if_na(cond: Column, yes, no) -> Column:
    """Vector if-else that keeps an unknown condition unknown."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def prefer(*cols) -> Column:
    """First non-null value."""
    return F.coalesce(*[col(c) for c in cols])


def coalesce_like(columns: Sequence[str], pattern: str) -> Column:
    """First non-blank value among the columns whose name contains ``pattern``."""
    return F.coalesce(*[blank_to_null(c) for c in columns if pattern in c])


def ladder(steps: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """First matching step wins."""
    out = None
    for cond, value in steps:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if otherwise is None:
        return out
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def bucket(c, bounds: Sequence, labels: Sequence[str]) -> Column:
    """Label by upper bounds: ``c <= bounds[i]`` takes ``labels[i]``, above all takes the last."""
    assert len(labels) == len(bounds) + 1
    steps = [(col(c) <= b, lab) for b, lab in zip(bounds, labels)]
    return F.when(col(c).isNotNull(), ladder(steps, labels[-1]))


def with_order(c, levels: Sequence[str]) -> Column:
    """Position (from 1) of a category in its declared order."""
    return ladder([(col(c) == lv, i) for i, lv in enumerate(levels, 1)])


# --- dates --------------------------------------------------------------------


def parse_date(c, fmt: str) -> Column:
    """Text to date; unreadable text becomes null."""
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("date")


def parse_ts(c) -> Column:
    return F.try_to_timestamp(col(c)).cast("timestamp_ntz")


def days_between(start, end) -> Column:
    return F.datediff(col(end), col(start))


def clip_dates(start, end, lo, hi) -> tuple[Column, Column]:
    """The part of ``[start, end]`` inside ``[lo, hi]``."""
    return F.greatest(col(start), col(lo)), F.least(col(end), col(hi))


def week7(c) -> Column:
    """Week of year counted in blocks of seven days from January 1st."""
    return (F.floor((F.dayofyear(col(c)) - 1) / 7) + 1).cast("bigint")


def week_floor(c) -> Column:
    """The Sunday on or before a date."""
    d = col(c).cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1)


def is_weekend(c) -> Column:
    return F.dayofweek(col(c)).isin(1, 7)


def month_label(c) -> Column:
    return F.date_format(col(c), "MMM")


def ratio(a, b) -> Column:
    """Division that gives null, not an error, for a zero divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))
