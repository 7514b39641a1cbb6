"""Vocabularies, thresholds and patterns of the delivery domain.

Every business rule that has a number or a word in it is stated here once, as
data. The models read these tables; they contain no literals of their own.
"""

from __future__ import annotations

from typing import NamedTuple


class Tiers(NamedTuple):
    """First matching bound wins; a null value matches none and gets the default."""

    op: str
    bounds: tuple
    default: str


# --- fixed values: numeric tiers -------------------------------------------
USAGE_TIERS = Tiers(">", ((1000, "HIGH"), (500, "MEDIUM")), "LOW")
MAINTENANCE_AGE_TIERS = Tiers(">", ((90, "OVERDUE"), (60, "DUE_SOON")), "CURRENT")
MAINTENANCE_UNKNOWN = "UNKNOWN"
DEPOT_SIZES = Tiers(">=", ((20, "LARGE"), (10, "MEDIUM")), "SMALL")
ROUTE_CATEGORIES = Tiers(">", ((50, "LONG"), (20, "MEDIUM")), "SHORT")
STOCK_FACTORS = Tiers("<=", ((1.0, "REORDER_NEEDED"), (1.5, "LOW_STOCK")), "IN_STOCK")
SENTIMENT_BOUND = 0.3
SENTIMENT_LABELS = ("POSITIVE", "NEGATIVE", "NEUTRAL")

# --- fixed values: telemetry alarms ----------------------------------------
LOW_BATTERY_PCT = 10
OVERSPEED_KMH = 120
HIGH_ALTITUDE_M = 400

# --- fixed values: weather limits (wind above, visibility below, rain above)
WEATHER_LIMITS = {
    "SEVERE": (50, 1, 20),
    "MODERATE": (30, 3, 10),
    "MILD": (15, 5, 5),
}
WEATHER_DEFAULT = "CLEAR"
WEATHER_SEVERITIES = ("CLEAR", "MILD", "MODERATE", "SEVERE")

# --- fixed values: word classes --------------------------------------------
EVENT_SEVERITIES = {
    "CRITICAL": ("CRASH", "EMERGENCY_LANDING", "COLLISION", "SYSTEM_FAILURE"),
    "WARNING": ("LOW_BATTERY", "WEATHER_ABORT", "REROUTE", "SIGNAL_LOST"),
    "INFO": ("TAKEOFF", "LANDING", "WAYPOINT", "DELIVERED"),
}
EVENT_SEVERITY_DEFAULT = "UNKNOWN"
MAINTENANCE_URGENCIES = {
    "CRITICAL": ("ENGINE_OVERHAUL", "STRUCTURAL_REPAIR", "EMERGENCY"),
    "ROUTINE": ("INSPECTION", "CALIBRATION", "SCHEDULED"),
}
MAINTENANCE_URGENCY_DEFAULT = "STANDARD"
DEFAULT_PRIORITY = "STANDARD"
# CRITICAL occurs in the data, so it belongs to the accepted vocabulary
ACCEPTED_PRIORITIES = ("STANDARD", "EXPRESS", "URGENT", "PREMIUM", "CRITICAL")
MISSION_STATUS_BY_ORDER = {
    "DELIVERED": "COMPLETED",
    "CANCELLED": "ABORTED",
    "FAILED": "FAILED",
}
MISSION_STATUS_DEFAULT = "COMPLETED"
PENDING_MISSION_STATUSES = ("ASSIGNED", "IN_FLIGHT")
AIRCRAFT_STATUSES = ("ACTIVE", "IN_MAINTENANCE", "GROUNDED")

# --- fixed values: text patterns -------------------------------------------
PHONE_STRIP = "[^0-9+]"
# a sentence ends at a period before a blank or the end; a period inside a number or name is part of it
ROOT_CAUSE = r"Root cause: ((?:[^.\n]|\.[^\s.])+)"
SENTENCE_END = r"\.(?:\s+|$)"

# --- fixed values: geometry ------------------------------------------------
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE_LAT = 111.0
KM_PER_DEGREE_LON = 85.0
ROUTE_LEGS = ((1, 0.0, 0.25), (2, 0.25, 0.5), (3, 0.5, 0.75), (4, 0.75, 1.0))
WAYPOINT_FRACTIONS = (0.25, 0.5, 0.75)
# milestone number, event type, share of the mission's duration
MILESTONES = (
    (1, "PREFLIGHT_CHECK", 0.0),
    (2, "LAUNCHED", 0.05),
    (3, "CRUISING", 0.15),
    (4, "APPROACHING_PICKUP", 0.30),
    (5, "PACKAGE_LOADED", 0.35),
    (6, "EN_ROUTE_DELIVERY", 0.50),
    (7, "PACKAGE_DELIVERED", 0.85),
    (8, "RETURNED_TO_DEPOT", 1.0),
)
OPEN_MISSION_MINUTES = 45

# --- fixed values: sentiment lexicon, weights in tenths ---------------------
SENTIMENT_LEXICON = {
    10: (
        "amazing", "best", "careful", "delighted", "excellent", "fast", "good", "great", "happy",
        "helpful", "love", "outstanding", "perfect", "pleasant", "quick", "reliable", "smooth", "wonderful",
    ),
    -10: (
        "awful", "bad", "broken", "crashed", "damaged", "delayed", "disappointed", "frustrating", "idiot",
        "late", "noisy", "pathetic", "poor", "stupid", "terrible", "unpleasant", "worst", "worthless", "wrong",
    ),
}

# --- fixed values: maintenance text categories ------------------------------
TEXT_CATEGORIES = {
    "ELECTRICAL": ("battery", "cable", "connector", "voltage", "wiring"),
    "MECHANICAL": ("bearing", "gear", "motor", "propeller", "rod"),
    "SOFTWARE": ("calibration", "firmware", "sensor", "software"),
    "STRUCTURAL": ("arm", "crack", "frame", "plate"),
}
TEXT_CATEGORY_DEFAULT = "OTHER"

# --- fixed values: categories of customer feedback and of mission events -------
FEEDBACK_CATEGORIES = {
    "SPEED": ("delayed", "fast", "late", "quick", "slow", "waiting"),
    "CONDITION": ("broken", "crashed", "damaged", "dented", "wet"),
    "SERVICE": ("helpful", "rude", "staff", "support"),
}
EVENT_CATEGORIES = {
    "WEATHER": ("fog", "storm", "wind"),
    "TECHNICAL": ("battery", "failure", "fault", "signal"),
    "ROUTE": ("arrived", "departed", "launched", "reported", "returned"),
}

# --- fixed values: inventory risk -------------------------------------------
USAGE_WINDOW_DAYS = 90
RISK_TIERS = Tiers("<=", ((0, "CRITICAL"), (30, "HIGH"), (90, "MEDIUM")), "LOW")
