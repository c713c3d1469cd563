"""Classification and scoring expressions used by staging and marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names by day_of_week (0 = Sunday), and the dashboard's row order.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONDAY_FIRST = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Magnitude class lower bounds, depth class bounds (km),
# points for the largest magnitude, risk category lower bounds, score cap.
MAGNITUDE_CLASSES = [(8.0, "great"), (7.0, "major"), (6.0, "strong"), (5.0, "moderate"), (4.0, "light"), (2.0, "minor")]
MAGNITUDE_BELOW_ALL = "micro"
DEPTH_INTERMEDIATE_KM, DEPTH_DEEP_KM = 70.0, 300.0
MAX_MAGNITUDE_POINTS = [(6.0, 20), (5.0, 10), (4.0, 5)]
MAX_MAGNITUDE_POINTS_ELSE = 1
RISK_CATEGORIES = [(50.0, "high"), (25.0, "moderate"), (10.0, "low")]
RISK_CATEGORY_ELSE = "minimal"
RISK_SCORE_CAP = 100.0
UNKNOWN = "unknown"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def magnitude_category(mag: Column | str) -> Column:
    m = _c(mag)
    expr = F.when(m < MAGNITUDE_CLASSES[-1][0], MAGNITUDE_BELOW_ALL)
    for bound, name in MAGNITUDE_CLASSES:
        expr = expr.when(m >= bound, name)
    return expr.otherwise(UNKNOWN)


def depth_category(depth: Column | str) -> Column:
    d = _c(depth)
    return (
        F.when(d < DEPTH_INTERMEDIATE_KM, "shallow")
        .when(d < DEPTH_DEEP_KM, "intermediate")
        .when(d >= DEPTH_DEEP_KM, "deep")
        .otherwise(UNKNOWN)
    )


def region_from_place(place: Column | str) -> Column:
    """Text after the first ' of ' (trimmed); otherwise the place as is."""
    p = _c(place)
    pos = F.locate(" of ", p)
    return F.when(pos > 0, F.trim(F.substr(p, pos + F.lit(4)))).otherwise(p)


def tsunami_warning(flag: Column | str) -> Column:
    """flag = 1 -> true; anything else, null included -> false."""
    return F.coalesce(_c(flag) == 1, F.lit(False))


def day_name(dow: Column | str) -> Column:
    d = _c(dow)
    expr = None
    for i, name in enumerate(DAY_NAMES):
        expr = F.when(d == i, name) if expr is None else expr.when(d == i, name)
    return expr


def max_magnitude_points(max_mag: Column | str) -> Column:
    m = _c(max_mag)
    expr = None
    for bound, pts in MAX_MAGNITUDE_POINTS:
        expr = F.when(m >= bound, F.lit(pts)) if expr is None else expr.when(m >= bound, F.lit(pts))
    return expr.otherwise(F.lit(MAX_MAGNITUDE_POINTS_ELSE))


def risk_category(raw_score: Column | str) -> Column:
    s = _c(raw_score)
    expr = None
    for bound, name in RISK_CATEGORIES:
        expr = F.when(s >= bound, name) if expr is None else expr.when(s >= bound, name)
    return expr.otherwise(RISK_CATEGORY_ELSE)


def capped_risk_score(raw_score: Column | str) -> Column:
    """least(cap, raw) that stays null for a null raw score (Spark's least skips nulls)."""
    s = _c(raw_score)
    return F.when(s.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.lit(RISK_SCORE_CAP), s))
