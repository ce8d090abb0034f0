"""Calendar expressions over epoch seconds in UTC, and the month arithmetic of the collection windows."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(created: Column) -> Column:
    return F.to_date(F.timestamp_seconds(created))


def month_of(created: Column) -> Column:
    return F.date_format(F.timestamp_seconds(created), "yyyy-MM")


def year_of(created: Column) -> Column:
    return F.date_format(F.timestamp_seconds(created), "yyyy")


def week_of(day: Column) -> Column:
    """The Monday of a day's week."""
    return F.to_date(F.date_trunc("week", day))


def between_days(created: Column, first: str, beyond: str) -> Column:
    """``first <= day < beyond`` as a range of epoch seconds, which reaches the scan where a date function would not."""
    seconds = [int(datetime.fromisoformat(d).replace(tzinfo=timezone.utc).timestamp()) for d in (first, beyond)]
    return (created >= seconds[0]) & (created < seconds[1])


@dataclass(frozen=True)
class Window:
    """Exclusive bounds in epoch seconds, with the month they lie in if they cover one."""

    after: int
    before: int
    label: str | None = None


def parse_month(label: str) -> tuple[int, int] | None:
    found = re.fullmatch(r"(\d{4})-(\d{2})", label)
    return (int(found[1]), int(found[2])) if found and 1 <= int(found[2]) <= 12 else None


def month_number(year: int, month: int) -> int:
    """Months since year 0, so that two can be compared and subtracted."""
    return year * 12 + month - 1


def month_start(number: int) -> int:
    year, month = divmod(number, 12)
    return int(datetime(year, month + 1, 1, tzinfo=timezone.utc).timestamp())


def month_label(number: int) -> str:
    year, month = divmod(number, 12)
    return f"{year:04d}-{month + 1:02d}"


def settled_months(year: int, cutoff: int) -> list[Window]:
    """The year's months before ``cutoff``; the one that straddles it is cut there."""
    out = []
    for number in range(year * 12, year * 12 + 12):
        start, before = month_start(number), min(month_start(number + 1), cutoff)
        if before > start:
            out.append(Window(start - 1, before, month_label(number)))
    return out


def settled_month(label: str, cutoff: int) -> Window | None:
    parsed = parse_month(label)
    return next((w for w in settled_months(parsed[0], cutoff) if w.label == label), None) if parsed else None


def recent_months(at: int, count: int) -> list[str]:
    """The month of ``at`` and those before it, newest first."""
    now = datetime.fromtimestamp(at, timezone.utc)
    top = month_number(now.year, now.month)
    return [month_label(top - back) for back in range(count)]


def trailing_window(at: int, hours: int) -> Window:
    return Window(at - hours * 3600 - 1, at + 1)


def hour_stamp(at: int) -> str:
    return datetime.fromtimestamp(at, timezone.utc).strftime("%Y%m%dT%H")


def backfill_cutoff(now: int, hours: int = 48) -> int:
    return now - hours * 3600


def range_start(last: Column, preset: str) -> Column:
    """First day of a display range that ends on ``last``: 1M, 3M, 6M, 1Y or ALL (NULL), by calendar months."""
    months = {"1M": 1, "3M": 3, "6M": 6, "1Y": 12}.get(preset)
    return F.add_months(last, -months) if months else F.lit(None).cast("date")
