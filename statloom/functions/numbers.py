"""Numbers, dates and names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def format_number(x) -> Column:
    """Text of a double: whole numbers without a fraction, no exponent below 1e15."""
    x = _c(x)
    whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
    return F.when(whole, F.floor(x).cast("string")).otherwise(x.cast("string"))


def to_number(x) -> Column:
    return _c(x).try_cast("double")


def is_number(x) -> Column:
    """Whether a text parses as a whole or floating number (also NaN, Infinity and literals such as 1d)."""
    return _c(x).rlike(r"^\s*[+-]?(NaN|Infinity|((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?))\s*$")


def is_boolean(x) -> Column:
    return F.lower(_c(x)).isin("true", "false", "1", "0")


def extract_year(date) -> Column:
    return F.substring(_c(date), 1, 4).try_cast("int")


def extract_month(date) -> Column:
    """Month of YYYY-MM..., 0 for yearly dates."""
    d = _c(date)
    return F.when(F.length(d) >= 7, F.substring(d, 6, 2).try_cast("int")).otherwise(F.lit(0))


def month_gap(a, b) -> Column:
    """Whole calendar months from timestamp a to b: a month counts once its day is reached."""
    a, b = _c(a), _c(b)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a) - F.when((b > a) & (F.dayofmonth(b) < F.dayofmonth(a)), 1).when((b < a) & (F.dayofmonth(b) > F.dayofmonth(a)), -1).otherwise(0)


def parse_date(x) -> Column:
    """Start of a year, month, day or time written in ISO 8601, null if it is none of them."""
    d = _c(x)
    full = F.when(d.rlike(r"^\d{4}$"), F.concat(d, F.lit("-01-01"))).when(d.rlike(r"^\d{4}-?\d{2}$"), F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, -2, 2), F.lit("-01"))).when(
        d.rlike(r"^\d{8}$"), F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, 5, 2), F.lit("-"), F.substring(d, 7, 2))
    ).when(d.rlike(r"^\d{4}-\d{2}-\d{2}$"), d).when(d.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"), d)
    return full.try_cast("timestamp")


def strip_namespace(x) -> Column:
    """Text after the first colon."""
    return F.regexp_replace(_c(x), r"^[^:]*:", "")


def strip_schema_prefix(x) -> Column:
    """Without a leading dcid:, dcs: or schema:."""
    return F.regexp_replace(_c(x), r"^(dcid|dcs|schema):", "")


def format_name(x) -> Column:
    """Readable form of an identifier: spaces at underscores, changes of case and of digits; first letter upper-case."""
    v = F.translate(_c(x), "_", " ")
    for pattern in (r"([a-z])([A-Z])", r"([A-Z])([A-Z][a-z])", r"([A-Za-z])([0-9])", r"([0-9])([A-Za-z])"):
        v = F.regexp_replace(v, pattern, "$1 $2")
    v = F.trim(v)
    return F.concat(F.upper(F.substring(v, 1, 1)), F.substring(v, 2, 1_000_000))
