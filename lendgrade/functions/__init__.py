"""Column-level functions (member key, band tables, safe casts)."""

from .bands import band_points, counter_bands
from .columns import (
    EMPTY_IDENTITY_KEY,
    digits_only,
    digits_to_int,
    in_lookup,
    longer_than,
    member_key,
    null_if_zero_text,
)

__all__ = [
    "EMPTY_IDENTITY_KEY",
    "band_points",
    "counter_bands",
    "digits_only",
    "digits_to_int",
    "in_lookup",
    "longer_than",
    "member_key",
    "null_if_zero_text",
]
