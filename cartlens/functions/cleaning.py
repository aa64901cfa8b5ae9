"""Cleaning of times, brands, categories, labels and comment texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartlens.schema import EVENT_TIME_FORMAT

# Names under which events without a brand or category are reported, and what a label is
# cleaned of.
NO_BRAND = "WITHOUT BRAND"
NO_CATEGORY = "without category"
UNKNOWN_BRAND = "unknown_brand"
LABEL_GAP = "[^A-Z0-9]+"


def parse_event_time(text: Column) -> Column:
    """``2020-04-01 00:05:00 UTC`` as an instant; null, not an error, when it does not parse."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT))


def not_blank(value: Column) -> Column:
    """The value itself, or null when it holds spaces only."""
    return F.when(F.trim(value) != "", value)


def normalise_brand(brand: Column) -> Column:
    return F.coalesce(F.upper(F.trim(not_blank(brand))), F.lit(NO_BRAND))


def normalise_category(code: Column, level: str = "full") -> Column:
    """The whole dotted code (``full``) or its first part (``top``)."""
    if level not in ("full", "top"):
        raise ValueError(f"level must be 'full' or 'top', not {level!r}")
    known = not_blank(code)
    if level == "top":
        known = F.split_part(known, F.lit("."), F.lit(1))
    return F.coalesce(known, F.lit(NO_CATEGORY))


def clean_label(label: Column) -> Column:
    """Upper case, every run of other characters than A-Z and 0-9 as one space."""
    return F.trim(F.regexp_replace(F.upper(label), LABEL_GAP, " "))


def normalise_text(text: Column, *, like_labels: bool = False) -> Column:
    """Comment text as the labels are searched in: upper case and trimmed, or cleaned just as labels are."""
    return clean_label(text) if like_labels else F.upper(F.trim(text))
