"""Fixed values that must equal the reference's for the results to match.

Kept together, in the reference's natural order, as plain text.
"""

# Transaction types (compared case-insensitively).
CREDIT = "Credit"
DEPOSIT = "Deposit"

# Alert message and its factor.
ANOMALY_FACTOR = 3
ALERT_MESSAGE = "Credit >= 3 * avg_check_5min"

# Amounts are kept exactly in units of 1/UNITS; a window total stays below 2**63
# units for over 900,000 amounts of MAX_AMOUNT. Times lie in the years 1 to 9999.
UNITS = 10_000
MAX_AMOUNT = 1e9
MIN_TIME_MS = -62_135_596_800_000
MAX_TIME_MS = 253_402_300_799_999

# Windows and expiries, in milliseconds.
ANOMALY_WINDOW_MS = 5 * 60 * 1000  # 5 minutes
RFM_WINDOW_MS = 24 * 60 * 60 * 1000  # 24 hours
SNAPSHOT_TTL_MS = 604_800 * 1000  # 604 800 seconds = 7 days

# Segment rules, in evaluation order.
NEWCOMER_MS = 5 * 60 * 1000  # tenure below 5 minutes
VIP_MIN_M = 10000  # m > 10000 and f > 5
VIP_MIN_F = 5
ACTIVE_MIN_M = 1000  # m > 1000 and f > 1
ACTIVE_MIN_F = 1
SLEEPING_MIN_R_MINUTES = 30  # r_minutes > 30

# Segment labels, in the same order.
SEGMENT_NEWCOMER = "Новичок"
SEGMENT_VIP = "VIP"
SEGMENT_ACTIVE = "Активный"
SEGMENT_SLEEPING = "Спящий"
SEGMENT_STANDARD = "Стандартный"

# JSON key order of the output events (alphabetical bean order).
ALERT_FIELDS = ("avg_check_5min", "event_time", "message", "sum", "type", "user_id")
SEGMENT_FIELDS = ("f", "m", "r_minutes", "segment", "updated_at", "user_id")
