"""Parameters of the two customer models, with their published defaults."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date

# Labels and their display order.
CATEGORIES = ("device", "consumable", "accessories", "spare_parts")
STATUSES = ("Active", "Not Active")
VALUE_TIERS = ("Diamond", "Platinum", "Gold", "Silver", "Bronze", "Passive")
EVENTS = ("New", "Lost", "Reactivated")
SPEND_TIERS = ("VIP", "XXL", "XL", "L", "M", "S", "XS", "XXS")
SPEND_MINIMA = (60000, 30000, 15000, 8000, 4000, 2000, 1000, 0)
WINDOW_MONTHS = (1, 6, 12, 13, 24, 25)
ORDER_WINDOW = 6
NO_LABEL = "<none>"


def month_number(day: date) -> int:
    """Months since year 0, so that neighbouring months differ by one."""
    return day.year * 12 + day.month - 1


def month_last_day(number: int) -> date:
    year, month = divmod(number, 12)
    return date(year, month + 1, calendar.monthrange(year, month + 1)[1])


@dataclass(frozen=True)
class SnapshotParams:
    """Volume model: report months, anonymous marker and tier gates."""

    latest: date
    months: int = 12
    anonymous_group: str = "general"
    t_high: float = 1000.0
    t_mid_high: float = 200.0
    t_mid: float = 50.0
    a_high: float = 1500.0
    f_high: int = 6
    f_mid: int = 3

    @property
    def last_month(self) -> int:
        return month_number(self.latest)

    @property
    def first_month(self) -> int:
        return self.last_month - self.months + 1

    @property
    def latest_eom(self) -> date:
        return month_last_day(self.last_month)


@dataclass(frozen=True)
class LadderParams:
    """Spend model: as-of day, tier minima from the top, activity cut."""

    as_of: date
    minima: tuple[int, ...] = SPEND_MINIMA
    active_days: int = 180
    series_months: int = 18

    @property
    def tiers(self) -> tuple[tuple[str, int], ...]:
        return tuple(zip(SPEND_TIERS, self.minima, strict=True))

    @property
    def last_full_month(self) -> int:
        """The last month that has ended by the as-of day."""
        number = month_number(self.as_of)
        return number if self.as_of == month_last_day(number) else number - 1
