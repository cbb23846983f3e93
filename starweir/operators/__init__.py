"""Operators on whole tables: DataFrame in, DataFrame out."""

from starweir.operators.amounts import repair_amounts
from starweir.operators.dense_keys import dense_key
from starweir.operators.history import current_version, latest_per_key, validity_ranges
from starweir.operators.lookups import lookup

__all__ = [
    "current_version",
    "dense_key",
    "latest_per_key",
    "lookup",
    "repair_amounts",
    "validity_ranges",
]
