"""Job parameters. The reference edits literals inside each script; here they are values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SiteUrls:
    """URLs of the reading site. Only the host is configurable; the paths are fixed."""

    base: str = "https://www.example.com"

    @property
    def register_prefix(self) -> str:
        return f"{self.base}/group-register?orgt1="

    # Page paths flagged before/after the register page, and the marker text.
    REGISTER_MARKER = "group-register"
    CODE_PARAM = "orgt1="
    POSITION_TOKEN = "orgt1"

    def pages(self) -> dict[str, tuple[str, ...]]:
        b = self.base
        return {
            "homepage": (f"{b}/", f"{b}/home"),
            "search": (f"{b}/search",),
            "pricing": (f"{b}/pricing",),
            "login": (f"{b}/login",),
            "signup": (f"{b}/sign-up",),
            "mission": (f"{b}/mission",),
        }


@dataclass(frozen=True)
class DlpRates:
    """GBP conversion of list prices. ``fix_eur`` divides the euro price instead of the
    dollar price in the euro branch (the literal branch is always NULL)."""

    usd_divisor: float = 1.25
    eur_divisor: float = 1.15
    fix_eur: bool = False


@dataclass(frozen=True)
class RfiWindow:
    """Monthly RFI: reading window [start, cut_off] and minimum age in days at the cut-off."""

    start: dt.date = dt.date(2022, 2, 1)
    cut_off: dt.date = dt.date(2022, 2, 28)
    min_days: int = 30
    subscribed_from: dt.date = dt.date(2017, 1, 1)


@dataclass(frozen=True)
class RfiAverageParams:
    cut_off: dt.date = dt.date(2022, 2, 28)
    active_from: dt.date = dt.date(2022, 2, 1)
    as_of: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    subscribed_from: dt.date = dt.date(2017, 1, 1)


@dataclass(frozen=True)
class RfiBands:
    """Band edges of the recency / frequency / intensity levels (fixed values)."""

    recency_edges: tuple[int, int, int] = (7, 30, 90)
    frequency_edges: tuple[float, float] = (5, 2)
    intensity_edges: tuple[float, float] = (60, 10)
    # Monthly job: the zero-day frequency level is written `x = 0 is null`, never true,
    # so the level is NULL; set to "D" for the intent (as in the average job).
    monthly_zero_frequency_label: str | None = None


# Texts of the average job's levels A to D, by measure (fixed values).
LEVEL_TEXTS = {
    "recency": ("< One Week Since Last Login", "< One Month Since Last Login",
                "< Three Months Since Last Login", "Three Months+ Since Last Login"),
    "frequency": ("5+ AVG Active Reading Days Per Month", "2-5 AVG Active Reading Days Per Month",
                  "< 2 AVG Active Reading Days Per Month", "0 AVG Active Reading Days Per Month"),
    "intensity": ("60+ AVG Reading Minutes Per Month", "10 - 60 AVG Reading Minutes Per Month",
                  "< 10 AVG Reading Minutes Per Month", "0 AVG Reading Minutes Per Month"),
}

# Event names removed before last-active and session calculations (fixed values,
# spelling of "recieved" as in the data).
BACKEND_EVENTS = ("payment failed", "payment recieved", "payment refunded", "page close")

# Organisations excluded by the by-date register funnel (fixed values).
EXCLUDED_ORGANISATIONS = (50, 51, 6, 1, 7, 90, 55, 98, 197, 58, 99, 92, 188, 204, 253, 28,
                          148, 187, 186, 48)


@dataclass(frozen=True)
class Period:
    """Half-open event period [start, end) and the label written with the results."""

    start: dt.date = dt.date(2022, 3, 1)
    end: dt.date = dt.date(2022, 3, 7)
    label: dt.date | None = None

    @property
    def period_start(self) -> dt.date:
        return self.label or self.start


@dataclass(frozen=True)
class FixtureParams:
    """Parameters used against the driver-generated tables (see FIXTURES.md)."""

    window_start: dt.date = dt.date(2024, 1, 1)
    window_end: dt.date = dt.date(2024, 1, 31)
    cut_off: dt.date = dt.date(2024, 1, 31)
    as_of: dt.datetime = dt.datetime(2024, 2, 15)
    summary_split: dt.datetime = dt.datetime(2024, 1, 16)
    urls: SiteUrls = field(default_factory=SiteUrls)

    def period(self) -> Period:
        return Period(self.window_start, self.window_end)

    def rfi_window(self) -> RfiWindow:
        return RfiWindow(start=self.window_start, cut_off=self.cut_off)

    def rfi_average(self) -> RfiAverageParams:
        return RfiAverageParams(cut_off=self.cut_off, active_from=self.window_start, as_of=self.as_of)
