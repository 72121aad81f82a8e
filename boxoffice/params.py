"""Fixed values and run parameters.

Fixed values that must equal the reference's for right results are kept
together here, as plain text, in their natural order.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values ----------------------------------------------------------
# The seven normalised fee columns, in their fixed order.
FEE_TYPES = [
    "ticketing_fee",
    "surcharge",
    "let_tax",
    "sales_tax",
    "venue_fee",
    "admin_fee_not_a_gratuity_",
    "gratuity",
]

# Control-table report statuses.
CONTROL_INITIALIZED = "initialized"
PRELIM_SENT = "prelim_sent"
REPORT_CANCELED = "report_canceled"
FINAL_SENT = "final_sent"
CONTROL_ROW_DOES_NOT_EXIST = "control_row_does_not_exist"

# Report variants: name, label as final, has pdf, has surcharge csv, has final csv.
REPORT_VARIANTS = [
    ("preliminary", False, True, True, False),
    ("final", True, True, False, True),
    ("accounting", True, False, True, False),
]

# Bar-card ticket names (case-sensitive) and the per-ticket bar-card amount.
BAR_CARD_PATTERN = "VIP.*Bar.*Card"
BAR_CARD_AMOUNT = "100.00"

# A start is "due" this many minutes after it begins.
DUE_DELAY_MINUTES = 6

# Pacific zone used for cutoffs in local time.
PACIFIC = "America/Los_Angeles"

# Surcharge CSV header (13 columns); the final CSV drops total_surcharge.
SURCHARGE_CSV_COLUMNS = [
    "venue", "event", "event_date", "ticket", "price", "per_ticket_let",
    "sold", "total_bar_card", "total_face_value", "total_let",
    "total_surcharge", "total_sales_tax", "total_service_charge",
]
FINAL_CSV_COLUMNS = [c for c in SURCHARGE_CSV_COLUMNS if c != "total_surcharge"]

# Event time-range presets: (days before as_of, days after as_of); None = open.
EVENT_RANGE_PRESETS = {
    "current": (-1, 2),
    "upcoming": (-1, None),
    "recent": (-45, -1),
}
# The fixed "test" preset is two absolute dates.
EVENT_RANGE_TEST = ("2023-12-31", "2024-01-03")

# Charge look-back in days by preset; anything else looks back 365 days.
CHARGE_LOOKBACK_DAYS = {"current": 1, "upcoming": 1, "recent": 90}
CHARGE_LOOKBACK_DEFAULT = 365

# Daily report horizon and "recent sales" window.
REPORT_HORIZON_DAYS = 60
RECENT_SALES_HOURS = 24

# Candidate window around the reference time (days) and preliminary lead (days).
CANDIDATE_WINDOW_DAYS = 2
PRELIM_LEAD_DAYS = 1

# Preview instant of the daily schedule in Pacific wall-clock time.
PREVIEW_HOUR, PREVIEW_MINUTE = 22, 31

# Rows of a full page of the order list and of the check-in list.
ORDERS_PER_PAGE, CHECKINS_PER_PAGE = 100, 5000

# Literal output values of the facts.
PAYMENT_GATEWAY = "Stripe"
VOID_TEXT = "false"
# Card charges whose statement descriptor matches this (case-insensitive) are excluded.
EXCLUDED_DESCRIPTOR = "ticket driver"
# Landing table names used in partition paths.
EVENTS_TABLE = "events"
CHARGES_TABLE = "stripe_charges"
UNKNOWN_VENUE = "unknown"

# --- run parameters used with the driver tables ----------------------------
AS_OF = dt.datetime(2024, 1, 15, 12, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-01-15 12:00:00'"
VENUE_IDS = [f"org-{i}" for i in range(10)]
