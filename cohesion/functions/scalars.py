"""Scalar functions of the spec language as Spark Column expressions.

Every function here is a pure Column -> Column builder: no Python runs per
row, everything stays inside whole-stage codegen. ANSI mode is on in Spark 4,
so every cast or parse goes through a ``try_`` form or a guard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import types as TY

# Fixed values of the spec language (they must equal the reference's rules):
# date formats tried in this order, slash dates month-first before day-first;
# partial year-month dates fall on this day of the month.
PARTIAL_DATE_DAY = 15
# Age units: days per year, per month, per week; the age range in years and days.
DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30.44
DAYS_PER_WEEK = 7
MAX_AGE_YEARS = 120
MAX_AGE_DAYS = MAX_AGE_YEARS * DAYS_PER_YEAR
# Default bounds of the age validation rule, in days.
VALID_AGE_MIN = 0
VALID_AGE_MAX = 120 * 365

_WS = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    """Python ``str.strip()``: Spark's ``trim`` only removes spaces."""
    return F.regexp_replace(c, _WS, "")


def parse_date(c: Column, fam: str = TY.STRING, assume_mid_month: bool = True) -> Column:
    """Text date -> DateType: ``Y-m-d``, ``Y/m/d``, ``Ymd``, ``m/d/Y``, ``d/m/Y``,
    then ``Y-m``/``Y/m`` as the 15th. Unparsable or impossible dates -> null."""
    if fam == TY.DATETIME:
        return F.to_date(c)
    if fam not in (TY.STRING, TY.NULL):
        c = TY.py_str(c, fam)
    s = strip(c.cast("string"))
    branches = [
        (r"^\d{4}-\d{1,2}-\d{1,2}$", F.try_to_date(s, "yyyy-M-d")),
        (r"^\d{4}/\d{1,2}/\d{1,2}$", F.try_to_date(s, "yyyy/M/d")),
        (r"^\d{8}$", F.try_to_date(s, "yyyyMMdd")),
        (
            r"^\d{1,2}/\d{1,2}/\d{4}$",
            F.coalesce(F.try_to_date(s, "M/d/yyyy"), F.try_to_date(s, "d/M/yyyy")),
        ),
    ]
    if assume_mid_month:
        mid = F.concat(F.regexp_replace(s, "/", "-"), F.lit(f"-{PARTIAL_DATE_DAY}"))
        branches.append((r"^\d{4}[-/]\d{1,2}$", F.try_to_date(mid, "yyyy-M-d")))
    return F.coalesce(*[F.when(s.rlike(rx), d) for rx, d in branches])


def format_date(c: Column, fam: str = TY.STRING) -> Column:
    """Any accepted date text -> ``YYYY-MM-DD`` text (null when unparsable)."""
    return F.date_format(parse_date(c, fam), "yyyy-MM-dd")


def to_int_trunc(c: Column, fam: str) -> Column:
    """Python ``int(float(x))``: truncate toward zero; null when not a number."""
    if fam == TY.INT:
        return c.cast("long")
    if fam == TY.BOOL:
        return c.cast("long")
    if fam == TY.FLOAT:
        return c.try_cast("long")
    return TY.text_double(c).try_cast("long")


def clean_numeric_string(c: Column) -> Column:
    """Drop thousands separators and outer whitespace; empty -> null."""
    return F.nullif(strip(F.regexp_replace(c.cast("string"), ",", "")), F.lit(""))


def safe_int(c: Column, fam: str = TY.STRING, default=None) -> Column:
    """``2,019`` -> 2019, ``3.7`` -> 3, unparsable -> default."""
    if fam in (TY.INT, TY.BOOL, TY.FLOAT):
        v = to_int_trunc(c, fam)
    else:
        v = to_int_trunc(clean_numeric_string(c), TY.STRING)
    if default is None:
        return v
    return F.coalesce(v, F.lit(int(default)).cast("long"))


def age_with_units(c: Column, fam: str) -> Column:
    """Numbers are years (0..120); text ``n years|months|weeks|days``. Result in days."""
    if fam == TY.NULL:
        return F.lit(None).cast("long")
    if fam in (TY.INT, TY.FLOAT, TY.BOOL):
        y = c.cast("double")
        return F.when((y >= 0) & (y <= MAX_AGE_YEARS), (y * DAYS_PER_YEAR).cast("long"))
    s = F.lower(strip(c.cast("string")))
    plain = TY.text_double(s)
    in_years = F.when(
        ~F.isnan(plain) & (plain >= 0) & (plain <= MAX_AGE_YEARS), (plain * DAYS_PER_YEAR).cast("long")
    )
    rx = r"^(\d+\.?\d*)\s*(years?|months?|weeks?|days?)$"
    num = F.regexp_extract(s, rx, 1).try_cast("double")
    unit = F.regexp_extract(s, rx, 2)
    factor = (
        F.when(unit.startswith("year"), F.lit(DAYS_PER_YEAR))
        .when(unit.startswith("month"), F.lit(DAYS_PER_MONTH))
        .when(unit.startswith("week"), F.lit(float(DAYS_PER_WEEK)))
        .when(unit.startswith("day"), F.lit(1.0))
    )
    prod = num * factor
    days = F.when(s.rlike(rx) & (prod < F.lit(9.2e18)), prod.cast("long"))
    with_unit = F.when((days >= 0) & (days <= F.lit(MAX_AGE_DAYS)), days)
    return F.coalesce(in_years, with_unit)


def age_in_days(
    birth: tuple[Column, str] | None,
    event: tuple[Column, str] | None,
    fallback: tuple[Column, str] | None = None,
    offset: tuple[Column, str] | None = None,
) -> Column:
    """Event date minus birth date (+ offset days); negative -> null with no
    fallback; a missing or unparsable date -> age from the fallback field."""
    fb = age_with_units(*fallback) if fallback is not None else F.lit(None).cast("long")
    if birth is None or event is None:
        return fb
    return age_from_dates(birth, event, parse_date(*birth), parse_date(*event), fb, offset)


def age_from_dates(birth: tuple[Column, str], event: tuple[Column, str], born: Column, when: Column, fallback: Column,
                   offset: tuple[Column, str] | None = None) -> Column:
    """``age_in_days`` of dates that are parsed already, with the age that stands in for a missing one."""
    present = ~TY.is_missing(*birth) & ~TY.is_missing(*event)
    diff = F.datediff(when, born).cast("long")
    if offset is not None:
        diff = diff + F.coalesce(to_int_trunc(*offset), F.lit(0).cast("long"))
    return F.when(present & born.isNotNull() & when.isNotNull(), F.when(diff >= 0, diff)).otherwise(fallback)


def duration_in_days(start: tuple[Column, str] | None, end: tuple[Column, str] | None) -> Column:
    """End minus start in days; null if either is missing/unparsable or negative."""
    if start is None or end is None:
        return F.lit(None).cast("long")
    d = F.datediff(parse_date(*end), parse_date(*start)).cast("long")
    return F.when(d >= 0, d)


def construct_date(
    year: tuple[Column, str] | None,
    month: tuple[Column, str] | None,
    day: tuple[Column, str] | None,
    default_day: int = PARTIAL_DATE_DAY,
) -> Column:
    """``Y-MM-DD`` text from parts; zero or out-of-range parts -> null.
    Month 1-12 and day 1-31 only: ``2020-02-31`` is produced as text."""
    if year is None or month is None:
        return F.lit(None).cast("string")
    y = safe_int(*year)
    m = safe_int(*month)
    if day is None:
        d = F.lit(int(default_day) if default_day else 0).cast("long")
    else:
        dc, df_ = day
        d = F.when(TY.is_missing(dc, df_), F.lit(int(default_day) if default_day else 0).cast("long")).otherwise(
            safe_int(dc, df_)
        )
    ok = (y.isNotNull() & (y != 0)) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= 31)
    return F.when(
        ok,
        F.concat(y.cast("string"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-"),
                 F.lpad(d.cast("string"), 2, "0")),
    )


def record_id(prefix: Column | None, record_type, suffix: Column | None) -> Column:
    """``{prefix}_{type}_{suffix}``; null prefix / empty suffix drop out; no type -> null."""
    if not record_type:
        return F.lit(None).cast("string")
    parts = []
    if prefix is not None:
        parts.append(prefix)
    parts.append(F.lit(str(record_type)))
    if suffix is not None:
        parts.append(F.nullif(suffix, F.lit("")))
    return F.concat_ws("_", *parts)


def valid_participant_id(c: Column, fam: str) -> Column:
    return ~TY.is_missing(c, fam) & (F.length(strip(TY.py_str(c, fam))) > 0)


def valid_age(c: Column, fam: str, min_age=VALID_AGE_MIN, max_age=VALID_AGE_MAX, allow_none=True) -> Column:
    if fam in (TY.INT, TY.FLOAT, TY.BOOL):
        v = to_int_trunc(c, fam)
        # NaN in a float column is not None in the reference: counted invalid
        none_ok = c.isNull() if allow_none else F.lit(False)
        return none_ok | (v.isNotNull() & (v >= min_age) & (v <= max_age))
    v = strip(c.cast("string"))  # int("12.5") raises, so a text is an age only as a whole number
    v = F.when(v.rlike(r"^[+-]?\d+$"), v.try_cast("bigint"))
    none_ok = c.isNull() if allow_none else F.lit(False)
    return none_ok | (v.isNotNull() & (v >= min_age) & (v <= max_age))
