"""Column-level standardisation, derivations and flags (all JVM-side).

Each function takes and returns ``Column`` objects, so callers keep one
whole-stage-codegen projection per model.  Two flag styles exist on purpose:
``ci_flag`` upper-cases the raw text before comparing, ``raw_flag`` compares
the raw text as it is (the models compute some flags from the raw column even
though the projected column of the same name is upper-cased).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_clean(c: ColumnOrName) -> Column:
    """Standardise free text to upper case (NULL stays NULL)."""
    return F.upper(col(c))


def title(c: ColumnOrName) -> Column:
    """Title-case: lower-case everything, upper-case the first letter after each space."""
    return F.initcap(col(c))


def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """``first || ' ' || last``: NULL when either part is NULL (unlike concat_ws)."""
    return F.concat(col(first), F.lit(" "), col(last))


def default(c: ColumnOrName, value) -> Column:
    """Replace NULL by a default value."""
    return F.coalesce(col(c), F.lit(value))


def abs_value(c: ColumnOrName) -> Column:
    return F.abs(col(c))


def id_to_string(c: ColumnOrName) -> Column:
    """Upper-casing a numeric id turns it into text; keep that type change explicit."""
    return F.upper(col(c).cast("string"))


def year_of(ts: ColumnOrName) -> Column:
    return F.year(col(ts))


def month_of(ts: ColumnOrName) -> Column:
    return F.month(col(ts))


def hour_of(ts: ColumnOrName) -> Column:
    return F.hour(col(ts))


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """The evaluation date: explicit when given, else today's date."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end`` (NULL when either is NULL)."""
    return F.datediff(col(end), col(start))


def age_years(dob: ColumnOrName, as_of: str | _dt.date | None) -> Column:
    """Age as fractional years: days / 365, not floored."""
    return F.datediff(as_of_date(as_of), col(dob)) / F.lit(365)


def pct_of(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """part / whole * 100; NULL when either is NULL or whole is 0 (no ANSI error)."""
    return F.try_divide(col(part), col(whole)) * F.lit(100)


def utilisation_pct(balance: ColumnOrName, limit: ColumnOrName) -> Column:
    """|balance| / limit * 100 rounded half-up to 2 digits, NULL unless limit > 0."""
    b, lim = col(balance), col(limit)
    return F.when(lim > 0, F.round(F.try_divide(F.abs(b), lim) * F.lit(100), 2))


def ci_flag(c: ColumnOrName, value: str) -> Column:
    """Case-insensitive equality flag; NULL input gives false."""
    return F.coalesce(F.upper(col(c)) == F.lit(value), F.lit(False))


def raw_flag(c: ColumnOrName, value: str) -> Column:
    """Case-sensitive equality on the raw value; NULL input gives false."""
    return F.coalesce(col(c) == F.lit(value), F.lit(False))


def not_null_flag(c: ColumnOrName) -> Column:
    return col(c).isNotNull()


def bool_default_false(pred: Column) -> Column:
    """``CASE WHEN pred THEN true ELSE false END``."""
    return F.coalesce(pred, F.lit(False))


def clean_text(c: ColumnOrName) -> Column:
    """Trim surrounding blanks (clean-up template)."""
    return F.trim(col(c))


def to_timestamp_ntz(c: ColumnOrName) -> Column:
    """Cast to a zone-less timestamp (clean-up template)."""
    return col(c).cast("timestamp_ntz")
