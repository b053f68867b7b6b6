"""Dates: strict ``YYYY-MM-DD`` parsing (C3), UTC+3 today/yesterday (I5), range clamp.

Column forms work over whole tables of requests; scalar forms validate the
arguments of one load before any job starts.
"""

from __future__ import annotations

import datetime as _dt
import logging
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The business day is counted at UTC+3.
BUSINESS_TZ = "+03:00"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
_ISO_DAY_RE = re.compile(r"\d{4}-\d{2}-\d{2}")
log = logging.getLogger(__name__)


def strict_date(c: Column) -> Column:
    """Exactly ``YYYY-MM-DD`` (after trim) and a real calendar day, else NULL."""
    t = F.trim(c)
    return F.when(t.rlike(ISO_DAY), F.try_to_date(t, "yyyy-MM-dd"))


def parse_date(value: str) -> _dt.date:
    """Scalar C3: raise on anything but a real ``YYYY-MM-DD``."""
    text = value.strip()
    if not _ISO_DAY_RE.fullmatch(text):
        raise ValueError(f"date must be YYYY-MM-DD, got {value!r}")
    try:
        return _dt.date.fromisoformat(text)
    except ValueError:
        raise ValueError(f"not a calendar day: {value!r}") from None


def business_today(now: _dt.datetime | None = None) -> _dt.date:
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return (now.astimezone(_dt.timezone(_dt.timedelta(hours=3)))).date()


def business_yesterday(now: _dt.datetime | None = None) -> _dt.date:
    return business_today(now) - _dt.timedelta(days=1)


def business_today_col() -> Column:
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), BUSINESS_TZ))


def clamp_range(d1: _dt.date, d2: _dt.date, today: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """``d2`` after yesterday -> yesterday; ``d1 > d2`` after the clamp -> error."""
    ceiling = (today or business_today()) - _dt.timedelta(days=1)
    d2c = min(d2, ceiling)
    if d2c != d2:
        log.info("date2 %s clamped to %s (yesterday at UTC+3)", d2, d2c)
    if d1 > d2c:
        raise ValueError(f"empty or inverted range: {d1} > {d2c} (yesterday is {ceiling})")
    return d1, d2c


def clamp_columns(d1: Column, d2: Column, today: Column | None = None) -> tuple[Column, Column, Column]:
    """C2 over a table of requests: (date1, clamped date2, valid)."""
    ceiling = F.date_sub(today if today is not None else business_today_col(), 1)
    d2c = F.least(d2, ceiling)
    return d1, d2c, d1 <= d2c


def register_today(spark: SparkSession) -> None:
    """``today()`` in SQL, so ``WHERE date >= today() - 30`` works as written."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION today() RETURNS DATE RETURN current_date()")
