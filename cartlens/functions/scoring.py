"""Weighted event scores. The two scores in use weigh a cart differently, so weights are a parameter."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartlens.schema import CART, PURCHASE, VIEW

# Weight of one event, by type (other types weigh nothing), and of one comment.
INDEX_WEIGHTS = {VIEW: 1, CART: 2, PURCHASE: 10}
POINT_WEIGHTS = {VIEW: 1, CART: 3, PURCHASE: 10}
COMMENT_POINTS = 10


def weighted_counts(counts: Mapping[str, Column], weights: Mapping[str, int]) -> Column:
    """Sum of per-type count columns times their weights."""
    return reduce(lambda total, term: total + term, (counts[kind] * weight for kind, weight in weights.items()))


def weighted_type(event_type: Column, weights: Mapping[str, int]) -> Column:
    """Weight of one event of the given type, 0 for a type without weight."""
    table = F.create_map(*(F.lit(part) for pair in weights.items() for part in pair))
    return F.coalesce(F.try_element_at(table, event_type), F.lit(0)).cast("long")
