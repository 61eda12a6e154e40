"""Column expressions for null, zero and ordering rules of panel data.

All of them are plain built-in expressions, so they stay inside whole-stage
code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_null(*cols: ColumnOrName) -> Column:
    return reduce(lambda a, b: a | b, [col(c).isNull() for c in cols])


# --- ratios -----------------------------------------------------------------


def ratio(num: ColumnOrName, den: ColumnOrName, default=None) -> Column:
    """``num / den``; null (or ``default``) where that is not a finite number."""
    out = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def nan_to_null(c: ColumnOrName) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


def is_finite(c: ColumnOrName) -> Column:
    c = col(c)
    inf = float("inf")
    return c.isNotNull() & ~F.isnan(c) & (c != F.lit(inf)) & (c != F.lit(-inf))


# --- aggregates -------------------------------------------------------------


def strict_sum(c: ColumnOrName) -> Column:
    """Sum that is null as soon as one member is null."""
    c = col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def lenient_sum(c: ColumnOrName) -> Column:
    """Sum over the known members, 0 for none."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def strict_mean(c: ColumnOrName) -> Column:
    c = col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def weighted_mean(x: ColumnOrName, w: ColumnOrName) -> Column:
    """Weighted mean; null where a value or weight is null or the weights sum to 0."""
    x, w = col(x), col(w)
    return ratio(strict_sum(x * w), strict_sum(w))


def sum_where(cond: Column, c: ColumnOrName) -> Column:
    """Sum over the rows meeting ``cond``; an empty sum is 0."""
    return F.coalesce(F.sum(F.when(cond, col(c))), F.lit(0.0))


# --- row-wise ---------------------------------------------------------------


def row_max(*cols: ColumnOrName) -> Column:
    """Largest of several columns, null if one of them is null."""
    return F.when(~any_null(*cols), F.greatest(*[col(c) for c in cols]))


def row_min(*cols: ColumnOrName) -> Column:
    return F.when(~any_null(*cols), F.least(*[col(c) for c in cols]))


def clamp(c: ColumnOrName, low=None, high=None) -> Column:
    """Limit to a range; null stays null."""
    out = col(c)
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    return F.when(col(c).isNotNull(), out)


def if_else(cond: Column, yes, no) -> Column:
    """Two-way choice whose result is null where the condition is null."""
    return F.when(cond, yes).when(~cond, no)


def is_in(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def signif(c: ColumnOrName, digits: int) -> Column:
    """Round to a number of significant digits."""
    c = col(c).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(digits - 1.0) - F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, c).otherwise(F.bround(c * scale, 0) / scale)


def align_up(c: ColumnOrName, step: int) -> Column:
    """Smallest multiple of ``step`` not below the value."""
    return (F.ceil(col(c) / F.lit(step)) * F.lit(step)).cast("int")


def bin_label(c: ColumnOrName, breaks: Sequence, labels: Sequence[str]) -> Column:
    """Label of the right-closed interval (breaks[i], breaks[i+1]] holding the value."""
    c = col(c)
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(breaks[:-1], breaks[1:], labels))):
        out = F.when((c > F.lit(low)) & (c <= F.lit(high)), F.lit(label)).otherwise(out)
    return out


def recode(c: ColumnOrName, mapping: Mapping, default: Column | None = None) -> Column:
    """Replace values by a small fixed mapping; others keep their value."""
    c = col(c)
    out = c if default is None else default
    for key, value in mapping.items():
        out = F.when(c == F.lit(key), F.lit(value)).otherwise(out)
    return out


def raise_if(cond: Column, message: Column | str) -> Column:
    """Boolean that is true, or fails the job where ``cond`` holds; for use in ``where``.

    The row number, never below 0, is no function of the row. That keeps the optimiser from combining the
    check with a later filter or moving one below it, which would silence it
    for the rows that the later filter drops.
    """
    message = F.lit(message) if isinstance(message, str) else message
    return F.when(cond, F.raise_error(message).cast("boolean")).otherwise(F.monotonically_increasing_id() >= 0)


def year_between(date: ColumnOrName, first: int, last: int | None = None) -> Column:
    """Whether a date lies in a year (or in the years up to ``last``), as bounds that reach the scan."""
    low, high = (F.lit(f"{y}-01-01").cast("date") for y in (first, (last or first) + 1))
    return (col(date) >= low) & (col(date) < high)


# --- text -------------------------------------------------------------------


def paste(*cols: ColumnOrName, sep: str = " ") -> Column:
    """Concatenate; a missing part becomes the text NA."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("NA")) for c in cols])


def replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """Replace the first match of a pattern without capture groups."""
    return F.regexp_replace(col(c), f"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def extract(c: ColumnOrName, pattern: str, group: int = 0) -> Column:
    """Text matched by a pattern, null where nothing matches."""
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))
