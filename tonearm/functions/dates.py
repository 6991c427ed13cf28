"""Date keys, date parts and timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: where year, month and day stand in a release date ----------------------
RELEASE_YEAR = r"(\d{4})"
RELEASE_MONTH = r"\d{4}-(\d{2})"
RELEASE_DAY = r"\d{4}-\d{2}-(\d{2})"
# the two spellings of a timestamp in documents, without and with a fraction
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssX"
ISO_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"
# ------------------------------------------------------------------------------------------


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def partial_date_key(text: Column | str) -> Column:
    """``YYYYMMDD`` of a full or partial date; ``00`` for a missing part, 0 for no date."""
    text = _col(text)

    def part(pattern: str) -> Column:
        return F.coalesce(F.regexp_extract(text, pattern, 1).try_cast("int"), F.lit(0))

    return part(RELEASE_YEAR) * 10000 + part(RELEASE_MONTH) * 100 + part(RELEASE_DAY)


def day_key(date: Column | str) -> Column:
    """``YYYYMMDD`` of a date."""
    date = _col(date)
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def month_key(date: Column | str) -> Column:
    """``YYYYMM00`` of a date."""
    return F.year(_col(date)) * 10000 + F.month(_col(date)) * 100


def year_key(date: Column | str) -> Column:
    """``YYYY0000`` of a date."""
    return F.year(_col(date)) * 10000


def date_of_text(text: Column | str) -> Column:
    """Date at the start of a timestamp text; NULL where there is none."""
    return _col(text).try_cast("date")


def on_date(timestamp: Column | str, date: dt.date) -> Column:
    """True where the timestamp falls on the date; a range, so that scans can use it."""
    timestamp = _col(timestamp)
    start = dt.datetime.combine(date, dt.time())
    return (timestamp >= F.lit(start)) & (timestamp < F.lit(start + dt.timedelta(days=1)))


def micros_to_timestamp(micros: Column | str) -> Column:
    """Timestamp, cut to seconds, of microseconds since 1970."""
    return F.timestamp_seconds(F.call_function("div", _col(micros), F.lit(1_000_000)))


def iso_timestamp(text: Column | str) -> Column:
    """Timestamp of an ISO text with or without a fraction; NULL for anything else."""
    text = _col(text)
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(ISO_SECONDS)), F.try_to_timestamp(text, F.lit(ISO_FRACTION))
    )


def date_parts(date: Column | str) -> dict[str, Column]:
    """The calendar columns of the date dimension; Sunday is day 1 of the week."""
    date = _col(date)
    weekday = F.dayofweek(date)
    return {
        "day_of_week": weekday,
        "day_of_month": F.dayofmonth(date),
        "day_of_year": F.dayofyear(date),
        "month_of_year": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "is_weekend": weekday.isin(1, 7),
    }


def audit_stamps(as_of: dt.datetime) -> dict[str, Column]:
    """Creation and change time of rows written by a run; given, never the wall clock."""
    return {"created_at": F.lit(as_of), "updated_at": F.lit(as_of)}
