"""What a deployment sets: statuses and their roles, the business calendar, scope rules."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StatusModel:
    """Roles of statuses; one that is in no list is unknown."""

    intake: str = "Intake"
    work: tuple[str, ...] = ("Intake", "Drafting", "In review")
    waiting: tuple[str, ...] = ("Waiting on brand",)
    standby: tuple[str, ...] = ("Standby",)
    delivery: tuple[str, ...] = ("Awaiting feedback",)
    terminal: tuple[str, ...] = ("Closed", "Approved", "Declined", "No return")
    #: What a terminal status says about a delivery before it; any other is a closing without an answer.
    answers: tuple[tuple[str, str], ...] = (("Approved", "approved"), ("Declined", "declined"), ("No return", "no_return"))

    def role(self, status: Column) -> Column:
        out = F.when(status.isin(*self.delivery), "delivery").when(status.isin(*self.standby), "standby")
        out = out.when(status.isin(*self.waiting), "waiting").when(status.isin(*self.terminal), "terminal")
        return out.when(status.isin(*self.work), "work").otherwise("unknown")


def easter(year: int) -> date:
    """Easter Sunday of the Gregorian calendar."""
    golden, century = year % 19, year // 100
    shift = (19 * golden + century - century // 4 - (century - (century + 8) // 25 + 1) // 3 + 15) % 30
    week = (32 + 2 * (century % 4) + 2 * (year % 100 // 4) - shift - year % 100 % 4) % 7
    late = (golden + 11 * shift + 22 * week) // 451
    month, day = divmod(shift + week - 7 * late + 114, 31)
    return date(year, month, day + 1)


# Month and day of the national holidays, and the first year of the latest.
FIXED_HOLIDAYS = {(1, 1): "New Year", (4, 21): "Tiradentes", (5, 1): "Labour Day", (9, 7): "Independence", (10, 12): "Our Lady of Aparecida", (11, 2): "All Souls", (11, 15): "Republic", (12, 25): "Christmas"}
LATEST_HOLIDAY = (11, 20, 2024)


@dataclass(frozen=True)
class CalendarSpec:
    """Monday to Friday, in windows of local hours, but for holidays; outside the years nothing is known."""

    zone: str = "America/Sao_Paulo"
    windows: tuple[tuple[int, int], ...] = ((10, 13), (14, 19))
    years: tuple[int, int] = (1970, 2100)
    extra: tuple[date, ...] = field(default=())

    def named_holidays(self) -> dict[date, str]:
        days = {d: "extra" for d in self.extra if self.years[0] <= d.year <= self.years[1]}
        for year in range(self.years[0], self.years[1] + 1):
            days |= {date(year, m, d): name for (m, d), name in FIXED_HOLIDAYS.items()}
            days[easter(year) - timedelta(days=2)] = "Good Friday"
            if year >= LATEST_HOLIDAY[2]:
                days[date(year, *LATEST_HOLIDAY[:2])] = "Black Consciousness Day"
        return days

    def holidays(self) -> list[date]:
        return sorted(self.named_holidays())

    def version(self) -> str:
        """A key of all that the calendar consists of."""
        facts = [self.zone, self.windows, [f"{d}:{n}" for d, n in sorted(self.named_holidays().items())]]
        return hashlib.sha256(json.dumps(facts).encode()).hexdigest()


# What separates names in one text.
SEPARATORS = r"[,;\n\r+]|\s[&/]\s"


@dataclass(frozen=True)
class ScopeRules:
    """Titles that are out of scope: words anywhere, and prefixes past opening brackets."""

    words: tuple[str, ...] = ("test", "duplicate", "template")
    prefixes: tuple[str, ...] = ("internal",)
