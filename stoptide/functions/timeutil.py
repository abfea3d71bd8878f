"""Service-day time: noon-anchored schedule times, local hours, offset changes, and date selection."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Europe/Stockholm"


def scheduled_epoch(day: Column, hms: Column, zone: str = ZONE) -> Column:
    """Epoch of an HH:MM:SS text on a service day, hours over 23 allowed.

    Counted from twelve hours before local noon, which is right on days that change the clock; null
    or malformed text gives null. The session's time zone must be UTC.
    """
    parts = F.split(hms, ":")
    ok = hms.rlike(r"^\d{1,3}:\d{2}:\d{2}$")
    noon = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(F.unix_date(day) * 86400 + 43200), zone))
    clock = sum((F.try_element_at(parts, F.lit(k)).try_cast("long") * f for k, f in ((1, 3600), (2, 60), (3, 1))), F.lit(0))
    return F.when(ok, noon - 43200 + clock)


def ambiguous_flag(hms: Column, day_changes: bool, next_changes: bool) -> Column:
    """Whether a nominal time falls at 2 or 3 o'clock of a day that changes the clock."""
    hour = F.split_part(hms, F.lit(":"), F.lit(1)).try_cast("int")
    changes = F.when(hour >= 24, F.lit(next_changes)).otherwise(F.lit(day_changes))
    return F.coalesce(changes & (hour % 24).isin(2, 3), F.lit(False))


def changes_clock(day: date, zone: str = ZONE) -> bool:
    """Whether the UTC offset differs between a day's two midnights."""
    tz = ZoneInfo(zone)
    a, b = (datetime.combine(x, time(), tz).utcoffset() for x in (day, day + timedelta(1)))
    return a != b


def local_hours(day: date, zone: str = ZONE) -> list[int]:
    """The hours that a local day's clock shows: 23, 24 or 25 of them in UTC, each label once."""
    tz = ZoneInfo(zone)
    now = datetime.combine(day, time(), tz).astimezone(timezone.utc)
    end = datetime.combine(day + timedelta(1), time(), tz).astimezone(timezone.utc)
    seen: list[int] = []
    while now < end:
        if (hour := now.astimezone(tz).hour) not in seen:
            seen.append(hour)
        now += timedelta(hours=1)
    return seen


def next_day_hours(day: date, last_arrival: str | None, margin_h: int = 2, zone: str = ZONE) -> list[int]:
    """The local hours of the next day to read for a day's late trips: up to its last arrival and a margin."""
    if not last_arrival or int(last_arrival.split(":")[0]) < 24:
        return []
    h, m, s = map(int, last_arrival.split(":"))
    tz = ZoneInfo(zone)
    noon = datetime.combine(day, time(12), tz).astimezone(timezone.utc)
    end = noon + timedelta(hours=h - 12 + margin_h, minutes=m, seconds=s)
    local = end.astimezone(tz)
    if local.date() > day + timedelta(1):
        raise ValueError(f"{last_arrival} on {day} reaches beyond the next day")
    if local.date() <= day:
        return []
    return [x for x in local_hours(day + timedelta(1), zone) if x <= local.hour]


def hour_spec(text: str) -> list[int]:
    """Hours of a text such as ``0-3,5,7-9``; ValueError for what isn't an hour."""
    out: set[int] = set()
    for part in text.split(","):
        lo, _, hi = part.strip().partition("-")
        a, b = int(lo), int(hi or lo)
        if not 0 <= a <= b <= 23:
            raise ValueError(f"not hours: {part!r}")
        out |= set(range(a, b + 1))
    return sorted(out)


def dates_to_build(present: set[date], today: date, floor: date, lag_days: int = 2, most: int = 7) -> list[date]:
    """The oldest missing dates from the floor to ``lag_days`` ago, at most ``most``."""
    days = (today - timedelta(lag_days) - floor).days + 1
    return [d for d in (floor + timedelta(k) for k in range(max(0, days))) if d not in present][:most]
