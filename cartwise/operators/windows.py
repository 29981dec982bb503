"""Time windows: candidate days, label days and the recent n-day ranges."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Lengths of the recent ranges used by the features, in days up to the window end: fixed values.
RECENT_DAYS = (1, 3, 5, 7, 10)


@dataclass(frozen=True)
class WindowSpec:
    """Everything that follows from the last observed day ``end``.

    ``history_start`` bounds the "whole history" features from below; ``None`` leaves them unbounded.
    """

    end: dt.date
    days: int = 14
    label_days: int = 7
    history_start: dt.date | None = None

    @property
    def start(self) -> dt.date:
        return self.recent(self.days)

    @property
    def label_start(self) -> dt.date:
        return self.end + dt.timedelta(days=1)

    @property
    def label_end(self) -> dt.date:
        return self.end + dt.timedelta(days=self.label_days)

    def recent(self, n: int) -> dt.date:
        """First day of the n days that end at ``end``."""
        return self.end - dt.timedelta(days=n - 1)


# End days of the published window sets: fixed values.
PUBLISHED_ENDS = {
    "1": dt.date(2018, 3, 25),
    "2": dt.date(2018, 4, 1),
    "3": dt.date(2018, 4, 8),
    "a": dt.date(2018, 4, 8),
    "test": dt.date(2018, 4, 15),
}
