"""Pipeline parameters: windows, codes and event names."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@dataclass(frozen=True)
class Params:
    # history read for "seen before" features, inclusive days
    history_start: dt.date
    history_end: dt.date
    # days that receive a feature row
    feature_start: dt.date
    feature_end: dt.date
    # order days that carry fraud labels
    label_start: dt.date
    label_end: dt.date
    # days of the daily activity totals (basic features)
    basic_start: dt.date
    basic_end: dt.date
    # last training day; later days are test days
    train_end: dt.date
    # evaluation period for confusion counts: 'week' | 'month' | 'day'
    period: str = "month"
    # timestamp ranges end at midnight of the last day (the warehouse's
    # ``ts BETWEEN .. AND 'yyyy-mm-dd'``) instead of covering the whole day
    end_inclusive_midnight: bool = False
    # fixed values: codes of the source systems
    delivered_status: str = "D"
    not_set_city: str = "(not set)"
    click_action: str = "productClick"
    page_type: str = "PAGE"
    extra: dict = field(default_factory=dict)

    @staticmethod
    def reference() -> "Params":
        """Windows of the original production run."""
        return Params(
            history_start=_d("2019-07-01"), history_end=_d("2021-05-31"),
            feature_start=_d("2020-12-06"), feature_end=_d("2021-05-31"),
            label_start=_d("2020-12-06"), label_end=_d("2021-05-29"),
            basic_start=_d("2020-12-06"), basic_end=_d("2021-05-31"),
            train_end=_d("2021-01-31"), period="month",
            end_inclusive_midnight=True,
        )

    @staticmethod
    def testdata() -> "Params":
        """Windows for the driver's tables (one month of events, January 2024)."""
        return Params(
            history_start=_d("2024-01-01"), history_end=_d("2024-01-30"),
            feature_start=_d("2024-01-10"), feature_end=_d("2024-01-30"),
            label_start=_d("2024-01-10"), label_end=_d("2024-01-30"),
            basic_start=_d("2024-01-10"), basic_end=_d("2024-01-30"),
            train_end=_d("2024-01-19"), period="week",
        )
