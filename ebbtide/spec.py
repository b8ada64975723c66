"""What is observed, when, and which columns a feature row carries."""

from __future__ import annotations

from calendar import monthrange
from dataclasses import dataclass
from datetime import date

# Relation names, feature names, vocabularies and cut-offs every consumer relies on.
TABLES = ("customers", "usage", "payments", "tickets", "service_calls")

CATEGORICAL = ("contract", "plan", "internet_service", "payment_method", "region")

USAGE_FEATURES = (
    "avg_call_minutes", "avg_data_gb", "avg_sms", "avg_app_logins",
    "minutes_trend", "data_trend", "logins_trend",
)
PAYMENT_FEATURES = (
    "late_payments", "late_payment_ratio", "avg_days_late", "max_days_late", "late_payments_recent",
)
TICKET_FEATURES = (
    "ticket_count", "complaint_count", "escalated_count", "billing_tickets", "network_tickets",
    "cancellation_inquiries", "avg_resolution_hours", "avg_satisfaction", "tickets_last_30d",
)
CALL_FEATURES = (
    "call_count", "avg_call_duration", "unresolved_calls", "avg_sentiment", "calls_last_30d",
)
NUMERIC = (
    ("age", "tenure_months", "monthly_charges", "total_charges")
    + USAGE_FEATURES + PAYMENT_FEATURES + TICKET_FEATURES + CALL_FEATURES
    + ("contacts_per_month",)
)

# Value of a history feature for a customer without rows in that history; everything else reads 0.
NEUTRAL = {"minutes_trend": 1.0, "data_trend": 1.0, "logins_trend": 1.0, "avg_satisfaction": 3.0}

BANDS = ("Low", "Medium", "High")
HIGH_CUTOFF = 0.50
MEDIUM_CUTOFF = 0.25

TRAIN_SHARE = 70
VALIDATION_SHARE = 15

SEED = 42


@dataclass(frozen=True)
class ObservationSpec:
    """Point-in-time window: history after ``snapshot - obs_months`` up to and including ``snapshot``.

    The last ``recent_months`` of it are "recent", the rest "prior"; ``recent_days`` is the short look-back
    of the ``*_last_30d`` counters.
    """

    snapshot: date = date(2025, 12, 31)
    obs_months: int = 6
    recent_months: int = 3
    recent_days: int = 30

    @property
    def first_day_before(self) -> date:
        """The last day before the window: the snapshot's day ``obs_months`` earlier, or the end of a shorter month."""
        months = self.snapshot.year * 12 + self.snapshot.month - 1 - self.obs_months
        year, month = months // 12, months % 12 + 1
        return date(year, month, min(self.snapshot.day, monthrange(year, month)[1]))
