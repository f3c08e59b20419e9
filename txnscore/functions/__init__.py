"""Column functions: pure Catalyst expressions, no Python UDFs."""

from .time import parse_time, trans_hour, trans_day_of_week, time_text
from .geo import haversine_km, to_radians_terms
from .categorical import flag, clean_name, clean_value, class_name
from .scoring import linear_score, positive_probability, decision

__all__ = [
    "parse_time", "trans_hour", "trans_day_of_week", "time_text",
    "haversine_km", "to_radians_terms",
    "flag", "clean_name", "clean_value", "class_name",
    "linear_score", "positive_probability", "decision",
]
