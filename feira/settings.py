"""Parameters of the models and reports.

The defaults are the published analysis constants; pass another ``Settings``
to run the same jobs on another calendar.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Settings:
    # calendar dimension, both ends included
    calendar_start: date = date(2016, 1, 1)
    calendar_end: date = date(2018, 12, 31)
    # years the holiday feed covers; elsewhere is_holiday is unknown (NULL)
    holiday_years: tuple[int, ...] = (2017, 2018)
    # day the customer recency is measured from
    analysis_date: date = date(2018, 10, 18)
    # report window in whole months, both ends included: (year, month)
    report_start: tuple[int, int] = (2017, 1)
    report_end: tuple[int, int] = (2018, 6)
    # spike drill-down
    spike_year: int = 2017
    spike_months: tuple[int, ...] = (10, 11, 12)
    spike_base_month: int = 10
    spike_month: int = 11
    # category and region comparison of two years
    compare_years: tuple[int, int] = (2017, 2018)
    last_compared_month: int = 6
    # list lengths
    top_customers: int = 100
    top_categories: int = 10
    # days looked at before and after a holiday
    pad_days: int = 7
