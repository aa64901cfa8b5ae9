"""Column expressions. All are built from JVM functions, so plans stay free of Python evaluation."""

from cartlens.functions.cleaning import (
    clean_label,
    not_blank,
    normalise_brand,
    normalise_category,
    normalise_text,
    parse_event_time,
)
from cartlens.functions.clock import event_date, event_hour, event_month
from cartlens.functions.scoring import INDEX_WEIGHTS, POINT_WEIGHTS, weighted_counts, weighted_type

__all__ = [
    "INDEX_WEIGHTS",
    "POINT_WEIGHTS",
    "clean_label",
    "event_date",
    "event_hour",
    "event_month",
    "normalise_brand",
    "normalise_category",
    "normalise_text",
    "not_blank",
    "parse_event_time",
    "weighted_counts",
    "weighted_type",
]
