"""Declared layouts of the raw sources.

Raw files are read as text and typed once, when they are landed: nothing is
inferred from a sample of the data, and money never passes through a float.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


CUSTOMERS = _text(
    "customer_id", "first_name", "last_name", "email", "signup_date", "country",
    "acquisition_channel", "segment", "is_active",
)
EVENTS = _text(
    "event_id", "customer_id", "event_timestamp", "event_type", "platform", "session_id"
)
PAYMENTS = _text(
    "payment_id", "customer_id", "payment_timestamp", "amount", "currency", "status", "plan"
)

# Columns landed with a type; a text that has none stays beside it.
TYPES = {
    "raw_crm_customers": {"signup_date": "timestamp_ntz"},
    "raw_app_events": {"event_timestamp": "timestamp_ntz"},
    "raw_payments": {"payment_timestamp": "timestamp_ntz", "amount": "decimal(12,2)"},
}

RAW = {"raw_crm_customers": CUSTOMERS, "raw_app_events": EVENTS, "raw_payments": PAYMENTS}
