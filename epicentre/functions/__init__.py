"""Column expressions (JVM-side, codegen'd); no Python UDFs."""

from epicentre.functions.classify import (
    DAY_NAMES,
    MONDAY_FIRST,
    day_name,
    depth_category,
    magnitude_category,
    max_magnitude_points,
    region_from_place,
    risk_category,
    capped_risk_score,
    tsunami_warning,
)
from epicentre.functions.timefn import day_of_week_sunday0, epoch_ms_to_ntz

__all__ = [
    "DAY_NAMES",
    "MONDAY_FIRST",
    "capped_risk_score",
    "day_name",
    "day_of_week_sunday0",
    "depth_category",
    "epoch_ms_to_ntz",
    "magnitude_category",
    "max_magnitude_points",
    "region_from_place",
    "risk_category",
    "tsunami_warning",
]
