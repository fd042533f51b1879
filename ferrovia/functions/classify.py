"""Classification expressions: ordered rule lists compiled to CASE chains.

Every function returns a ``Column`` built from JVM-side expressions only, so
it stays inside whole-stage codegen wherever it is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the source system's business rules.
# Operator-type rules: (substring, label), checked in this order, first hit wins.
OPERATOR_RULES = [
    ("Dublin Bus", "Dublin Bus"),
    ("Bus Éireann", "Bus Éireann"),
    ("Iarnród", "Irish Rail"),
    ("Luas", "Luas"),
    ("Go-Ahead", "Go-Ahead Ireland"),
    ("Transport", "TFI"),
]
OPERATOR_DEFAULT = "Other"
# Route-type codes.
ROUTE_TYPE_NAMES = {0: "Tram", 1: "Metro", 2: "Rail", 3: "Bus", 4: "Ferry"}
ROUTE_TYPE_DEFAULT = "Unknown"
ROUTE_TYPE_FALLBACK_CODE = 3
# Route-name flags.
CROSS_CITY_WORDS = ["City Centre", "Cross City"]
COMMUTER_WORDS = ["Commuter", "Express"]
COMMUTER_ROUTE_TYPE = 2
# Region boxes: (label, lat_lo, lat_hi, lon_lo, lon_hi), inclusive, first wins.
REGION_BOXES = [
    ("Dublin", 53.25, 53.45, -6.45, -6.05),
    ("Cork", 51.85, 52.10, -8.65, -8.35),
    ("Galway", 53.25, 53.30, -9.10, -8.95),
    ("Limerick", 52.63, 52.70, -8.70, -8.58),
    ("Waterford", 52.24, 52.28, -7.15, -7.08),
]
REGION_DEFAULT = "Other"
CITY_CENTRE_BOX = (53.33, 53.36, -6.28, -6.22)
# Minute-of-day periods (inclusive minute ranges), first wins.
MINUTE_PERIODS = [("AM Peak", 420, 570), ("PM Peak", 1020, 1170), ("Night", 0, 359)]
# Departure-hour periods (inclusive hour ranges), first wins.
HOUR_PERIODS = [("AM Peak", 7, 9), ("PM Peak", 17, 19), ("Night", 0, 5)]
PERIOD_DEFAULT = "Off-Peak"
# Delay bands in seconds.
ON_TIME_SECS = 60
MINOR_MAX_SECS = 300
MODERATE_MAX_SECS = 900
# Score tiers on pct_on_time: lower bounds 90 / 75 / 60, else the last label.
TIER_BOUNDS = [90, 75, 60]
PERFORMANCE_TIERS = ["Excellent", "Good", "Fair", "Poor"]
TIER_COLOURS = ["#2ECC71", "#F39C12", "#E67E22", "#E74C3C"]
DELAY_LABELS = ["On-Time", "Minor delays", "Moderate delays", "Severe delays"]
# Reliability score weights.
SCORE_ON_TIME_WEIGHT = "0.7"
SCORE_SEVERE_WEIGHT = "0.3"
# Trend labels.
TREND_WORSENING = "↑ Worsening"
TREND_IMPROVING = "↓ Improving"
TREND_STABLE = "→ Stable"
# Bank holidays of the default calendar.
DEFAULT_BANK_HOLIDAYS = [
    "2025-01-01", "2025-02-03", "2025-04-18", "2025-04-21", "2025-05-05",
    "2025-06-02", "2025-08-04", "2025-10-27", "2025-12-25", "2025-12-26",
]
DEFAULT_PERIOD_LABEL = "Weekday"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _contains_ci(c: Column, needle: str) -> Column:
    """Case-insensitive, accent-sensitive substring test (``ILIKE '%x%'``)."""
    return c.ilike(f"%{needle}%")


def classify_contains(c, rules, default) -> Column:
    """Ordered case-insensitive substring rules -> label; first hit wins."""
    c = _col(c)
    expr = None
    for needle, label in rules:
        cond = _contains_ci(c, needle)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def operator_type(agency_name) -> Column:
    return classify_contains(agency_name, OPERATOR_RULES, OPERATOR_DEFAULT)


def decode_route_type(raw_type) -> Column:
    """Description of the *raw* route type: NULL or unknown code -> Unknown."""
    c = _col(raw_type)
    expr = None
    for code, name in ROUTE_TYPE_NAMES.items():
        expr = F.when(c == code, name) if expr is None else expr.when(c == code, name)
    return expr.otherwise(F.lit(ROUTE_TYPE_DEFAULT))


def any_contains(c, words) -> Column:
    c = _col(c)
    return reduce(lambda a, b: a | b, [_contains_ci(c, w) for w in words])


def is_cross_city(long_name) -> Column:
    return F.coalesce(any_contains(long_name, CROSS_CITY_WORDS), F.lit(False))


def is_commuter(raw_type, long_name) -> Column:
    """Rail type OR a commuter word; three-valued OR, unknown -> false."""
    cond = (_col(raw_type) == COMMUTER_ROUTE_TYPE) | any_contains(long_name, COMMUTER_WORDS)
    return F.coalesce(cond, F.lit(False))


def in_bbox(lat, lon, box) -> Column:
    lat_lo, lat_hi, lon_lo, lon_hi = box
    return _col(lat).between(lat_lo, lat_hi) & _col(lon).between(lon_lo, lon_hi)


def classify_bbox(lat, lon, boxes=REGION_BOXES, default=REGION_DEFAULT) -> Column:
    """First inclusive box containing the point; NULL coordinates -> default."""
    expr = None
    for label, *box in boxes:
        cond = in_bbox(lat, lon, box)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(default))


def is_city_centre(lat, lon) -> Column:
    return F.coalesce(in_bbox(lat, lon, CITY_CENTRE_BOX), F.lit(False))


def _range_chain(c, ranges, default) -> Column:
    c = _col(c)
    expr = None
    for label, lo, hi in ranges:
        cond = c.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(default))


def period_from_minute(minute_of_day) -> Column:
    return _range_chain(minute_of_day, MINUTE_PERIODS, PERIOD_DEFAULT)


def period_from_hour(hour, wrap: bool = False) -> Column:
    """Schedule period from a service hour; hours >= 24 are Off-Peak unless
    ``wrap`` folds them back onto the clock (hour % 24)."""
    h = _col(hour)
    if wrap:
        h = F.pmod(h, F.lit(24))
    return _range_chain(h, HOUR_PERIODS, PERIOD_DEFAULT)


def delay_band(secs) -> Column:
    """On-Time / Minor / Moderate / Severe / Early / Unknown, in that order."""
    s = _col(secs)
    return (F.when(F.abs(s) <= ON_TIME_SECS, "On-Time")
            .when(s.between(ON_TIME_SECS, MINOR_MAX_SECS), "Minor")
            .when(s.between(MINOR_MAX_SECS, MODERATE_MAX_SECS), "Moderate")
            .when(s > MODERATE_MAX_SECS, "Severe")
            .when(s < -ON_TIME_SECS, "Early")
            .otherwise("Unknown"))


def tier(pct, labels=PERFORMANCE_TIERS) -> Column:
    """Score band on a percentage: >=90, >=75, >=60, else (NULL included)."""
    p = _col(pct)
    expr = None
    for bound, label in zip(TIER_BOUNDS, labels):
        expr = F.when(p >= bound, label) if expr is None else expr.when(p >= bound, label)
    return expr.otherwise(F.lit(labels[len(TIER_BOUNDS)]))


def reliability_score(pct_on_time, pct_severe) -> Column:
    """on_time*0.7 + (100 - coalesce(severe, 0))*0.3 in exact decimals."""
    on_time = _col(pct_on_time)
    severe = F.coalesce(_col(pct_severe), F.lit(0).cast("decimal(5,2)"))
    w_on = F.lit(SCORE_ON_TIME_WEIGHT).cast("decimal(2,1)")
    w_sev = F.lit(SCORE_SEVERE_WEIGHT).cast("decimal(2,1)")
    hundred = F.lit(100).cast("decimal(3,0)")
    return (on_time * w_on + (hundred - severe) * w_sev).cast("decimal(5,2)")


def severity_index(pct_on_time) -> Column:
    hundred = F.lit(100).cast("decimal(3,0)")
    return (hundred - F.coalesce(_col(pct_on_time), hundred)).cast("decimal(5,2)")


def hour_label(hour) -> Column:
    return F.concat(F.lpad(_col(hour).cast("string"), 2, "0"), F.lit(":00"))


def trend_label(current, previous) -> Column:
    cur, prev = _col(current), _col(previous)
    return (F.when(cur > prev, TREND_WORSENING)
            .when(cur < prev, TREND_IMPROVING)
            .otherwise(TREND_STABLE))
