"""Names, lists, rates and limits the results depend on."""

from __future__ import annotations

# Customer segments, their share of customers, and the ones that pay.
SEGMENTS = ["Free", "Pro", "Business", "Enterprise"]
SEGMENT_WEIGHTS = [0.55, 0.25, 0.15, 0.05]
PAYING_SEGMENTS = ["Pro", "Business", "Enterprise"]
PLAN_PRICES = {"Pro": 19, "Business": 49, "Enterprise": 199}
PRICE_MULTIPLES = [1, 1, 1, 12]

# Share of customers marked inactive.
INACTIVE_SHARE_FREE = 0.15
INACTIVE_SHARE_OTHER = 0.05

# Customer attributes, each drawn with equal weight.
COUNTRIES = ["US", "GB", "IN", "DE", "BR", "JP", "CA", "AU", "FR", "NG"]
CHANNELS = ["organic", "paid_search", "paid_social", "referral", "direct", "email"]
FIRST_NAMES = [
    "Alex", "Maya", "Jordan", "Sam", "Priya", "Liam", "Aisha", "Noah", "Wei", "Sofia",
    "Kai", "Rohan", "Emma", "Diego", "Yara", "Marcus", "Lena", "Omar", "Ines", "Theo",
]
LAST_NAMES = [
    "Chen", "Patel", "Kim", "Garcia", "Singh", "Johnson", "Nakamura", "Silva", "Diallo",
    "Schmidt", "O'Brien", "Ahmed", "Rossi", "Park", "Hassan", "Lopez", "Andersen", "Khan",
]

# Event types with their share of events, and the platforms.
EVENT_TYPES = [
    "page_view", "feature_used", "sign_up_started", "sign_up_completed",
    "activated", "upgraded", "churned",
]
EVENT_WEIGHTS = [0.40, 0.25, 0.10, 0.08, 0.10, 0.04, 0.03]
PLATFORMS = ["web", "ios", "android"]
PLATFORM_WEIGHTS = [0.55, 0.25, 0.20]

# Ordinal of an event type in the signup funnel; other types have none.
FUNNEL_STEPS = {
    "page_view": 1,
    "sign_up_started": 2,
    "sign_up_completed": 3,
    "activated": 4,
    "upgraded": 5,
}

# Payment outcomes and currencies with their shares.
STATUSES = ["succeeded", "failed", "refunded"]
STATUS_WEIGHTS = [0.92, 0.05, 0.03]
CURRENCIES = ["USD", "EUR", "GBP", "INR", "JPY"]
CURRENCY_WEIGHTS = [0.60, 0.15, 0.10, 0.10, 0.05]

# US dollars per unit of currency.
USD_RATES = {"USD": "1.00", "EUR": "1.08", "GBP": "1.27", "INR": "0.012", "JPY": "0.0067"}

# Text read as a true flag, compared in lower case.
TRUE_WORDS = ["true", "1", "t"]

# Hours after which a source is late: (warn, error).
FRESHNESS_HOURS = {"events": (12, 24), "payments": (6, 12)}

# Lines of the summary report.
REPORT_LINES = {
    "customers": "unique customer_id",
    "payments": "unique payment_id",
    "events": "no orphan event customer_sk",
}

# Calendar dimension bounds, first and last day.
CALENDAR_FIRST_DAY = "2023-01-01"
CALENDAR_LAST_DAY = "2027-12-31"

# First day of the activity report, and trailing windows in days.
REPORT_START = "2025-01-01"
WEEK_DAYS = 7
MONTH_DAYS = 30

# Synthetic data: sizes, seeds and time ranges.
SYNTHETIC_CUSTOMERS = 5_000
SYNTHETIC_EVENTS = 150_000
SYNTHETIC_PAYMENTS = 40_000
CUSTOMER_SEED = 42
EVENT_SEED = 7
PAYMENT_SEED = 11
SIGNUP_START = "2024-01-01 00:00:00"
SIGNUP_MAX_DAYS = 730
ACTIVITY_START = "2025-01-01 00:00:00"
ACTIVITY_END = "2026-05-01 00:00:00"
SESSION_COUNT = 200_000

# Key formats.
CUSTOMER_KEY = "C%06d"
EVENT_KEY = "E%09d"
SESSION_KEY = "S%08d"
PAYMENT_KEY = "PAY%09d"
