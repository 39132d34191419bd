"""Small column expressions shared by the detectors; all run inside the JVM."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idwarden.functions.checks import positive


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds(ts) -> Column:
    """Whole seconds of an event time."""
    return F.unix_timestamp(_col(ts))


def elapsed(later, earlier) -> Column:
    """Whole seconds from ``earlier`` to ``later``."""
    return seconds(later) - seconds(earlier)


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def is_failure(status) -> Column:
    """A failed login: any status that contains FAIL, such as FAILED or MFA_FAILED."""
    return _col(status).contains("FAIL")


def labelled(label: str, c) -> Column:
    """``label: value``; the label alone when the value is missing."""
    return F.concat_ws(": ", F.lit(label), _col(c))


def any_null(*cols) -> Column:
    return reduce(Column.__or__, [_col(c).isNull() for c in cols])


def all_not_null(*cols) -> Column:
    return reduce(Column.__and__, [_col(c).isNotNull() for c in cols])


def within_rate(part, whole) -> Column:
    """``part / whole`` rounded to six places, NULL when ``whole`` is zero."""
    return F.round(F.try_divide(_col(part).cast("double"), _col(whole)), 6)


def first_rows(df: DataFrame, top: int | None) -> DataFrame:
    """The first ``top`` rows of a sorted frame, all of them for None."""
    if top is None:
        return df
    positive(top=top)
    return df.limit(top)
