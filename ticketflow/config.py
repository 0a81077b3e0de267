"""Run configuration: one explicit as-of date and every knob the metrics use.

Operators never call ``current_date()``; the date a report is "as of" is a
parameter, so a rerun for a past day gives the same answer.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Codes, labels, JSON values and thresholds, stated as they appear there.
# ---------------------------------------------------------------------------
TICKET_TYPE = "ROUTER_PICKUP"
ASSIGN_EVENT = "ASSIGN_TICKET_ROUTER_PICKUP"

STATUS_OPEN = (0, 1)
STATUS_SUCCESS = 2
STATUS_FAILED = 3
SCORE_RECOVERED = 1
SCORE_FAILED = 0

RES_ROUTER = "ROUTER_RECOVERED"
RES_CUSTOMER = "CUSTOMER_RECOVERED"
RES_GENERAL = "GENERAL"

OTP_DONE = "DONE"
RA_RETURNED_BY = "RA"
RA_ROUTER_STATE = "returned_in_office"

# (label, low, high) inclusive; the last label is the ELSE branch.
OPEN_BUCKETS = (
    ("0-7 days", 0, 7),
    ("8-14 days", 8, 14),
    ("15-21 days", 15, 21),
    ("21+ days", None, None),
)
RA_BUCKETS = (
    ("0-7 days", 0, 7),
    ("8-14 days", 8, 14),
    ("15-21 days", 15, 21),
    ("22-30 days", 22, 30),
    ("30+ days", None, None),
)

# Open-ticket signal per bucket: (bad above, warn above, level otherwise).
OPEN_SIGNAL_RULES = {
    "0-7 days": (None, None, "good"),
    "8-14 days": (None, 2000, "neutral"),
    "15-21 days": (1000, 500, "neutral"),
    "21+ days": (50, 10, "good"),
}
# RA-pending signal per bucket: (bad above, warn above, level otherwise).
RA_SIGNAL_RULES = {
    "0-7 days": (None, None, "neutral"),
    "8-14 days": (None, None, "neutral"),
    "15-21 days": (None, 1000, "neutral"),
    "22-30 days": (500, 200, "neutral"),
    "30+ days": (300, 100, "neutral"),
}
PICKUP_GOOD_ABOVE = 30
PICKUP_BAD_BELOW = 15
TREND_FLAT_PCT = 3.0

# Summary row captions.
M_MISSED = "Churned without PUT (daily avg)"
M_ASSIGNED = "PUT Assigned (daily avg)"
M_SUCCESS = "Success / Total Closed"
M_ROUTER = "Router Recovered / Total Closed"
M_CUSTOMER = "Customer Recovered / Total Closed"
M_GENERAL = "General (unclassified) / Total Closed"
M_FAILED = "Failed / Total Closed"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    as_of: date
    offset_minutes: int = 330  # UTC wall time -> IST
    cohort_start: date = date(2025, 11, 1)
    maturity_days: int = 21
    lookback_days: int = 120  # assignments, closures, failures, RA returns
    puts_lookback_days: int = 120  # tickets searched for a pickup
    audit_lookback_days: int = 90  # device location audit
    ra_lookback_days: int = 180  # RA return audit
    expiry_lookback_days: int = 90
    churn_grace_days: int = 15
    expected_after_days: int = 16
    expected_window_days: int = 60
    baseline_start: date = date(2025, 11, 1)
    baseline_end: date = date(2025, 12, 31)
    rolling_rows: int = 7
    n_weeks: int = 3
    after_success_days: int = 60

    def replace(self, **kw) -> "Config":
        return dataclasses.replace(self, **kw)


# The configuration the test tables are checked with (see FIXTURES.md).
FIXTURE = Config(
    as_of=date(2001, 8, 2),
    cohort_start=date(2001, 1, 1),
    baseline_start=date(2001, 5, 1),
    baseline_end=date(2001, 6, 30),
)

# A later report date: its baseline ended long before the lookback begins.
FIXTURE_LATE = FIXTURE.replace(as_of=date(2001, 12, 20), baseline_start=date(2001, 7, 1), baseline_end=date(2001, 7, 31))

# A baseline whose first month lies before the daily panels begin.
FIXTURE_PARTIAL = FIXTURE.replace(baseline_start=date(2001, 3, 1), baseline_end=date(2001, 4, 30))
