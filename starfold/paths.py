"""Where things live: one object used by every job."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

ALL_DATES = "*"


def parse_day(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def dated(base: str, day: str | date) -> str:
    """``base/yyyy/MM/dd`` for one day, ``base/*/*/*`` for all days (to be read, not written)."""
    if day == ALL_DATES:
        return f"{base}/*/*/*"
    return f"{base}/{parse_day(day):%Y/%m/%d}"


def one_day(base: str, day: str | date) -> str:
    """The folder of one day, for writers."""
    if day == ALL_DATES:
        raise ValueError("a day folder is written one day at a time")
    return dated(base, day)


# Finds the day in the path of a file, or of a folder, below a base laid out by day.
DAY_IN_PATH = r".*/(\d{4})/(\d{2})/(\d{2})(?:/.*)?$"


def day_of(path: str) -> date | None:
    found = re.fullmatch(DAY_IN_PATH, path)
    return date(*map(int, found.groups())) if found else None


def days_between(start: str | date, end: str | date) -> list[date]:
    """Days from ``start`` (included) to ``end`` (excluded)."""
    first, stop = parse_day(start), parse_day(end)
    return [first + timedelta(days=n) for n in range((stop - first).days)]


def dated_range(base: str, start: str | date, end: str | date) -> str:
    """One glob over the day folders of ``[start, end)``; days never loaded are skipped."""
    folders = ",".join(f"{day:%Y/%m/%d}" for day in days_between(start, end))
    return f"{base}/{{{folders}}}"


def dated_days(base: str, days: Iterable[date]) -> str:
    """One glob over the folders of some days."""
    folders = ",".join(f"{day:%Y/%m/%d}" for day in sorted(days))
    return f"{base}/{{{folders}}}"


@dataclass(frozen=True)
class LakePaths:
    """Folders of the landing zone, of silver and of gold below one root."""

    root: str
    feed: str = "vacinacao"
    # Form of the gold tables: snapshots or delta. A lake keeps the form it was begun with.
    gold_form: str = "snapshots"

    @property
    def landing_csv(self) -> str:
        return f"{self.root}/bronze/{self.feed}/csv"

    @property
    def landing_json(self) -> str:
        return f"{self.root}/bronze/{self.feed}/json"

    @property
    def rejected(self) -> str:
        """Landed records that could not be read."""
        return f"{self.root}/rejected/{self.feed}"

    @property
    def silver(self) -> str:
        """Silver by run date, all in the declared types."""
        return f"{self.root}/silver/{self.feed}"

    @property
    def untyped(self) -> str:
        """Silver by run date in the types it was read with."""
        return f"{self.root}/untyped/{self.feed}"

    @property
    def trusted(self) -> str:
        """Silver laid out by dose date instead of run date."""
        return f"{self.root}/trusted/{self.feed}"

    @property
    def ledger(self) -> str:
        """Which landed files each day was loaded from."""
        return f"{self.root}/ledger/{self.feed}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"
