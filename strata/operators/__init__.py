"""Relational operators: joins (J1-J8), per-group minimum (G1-G2), day selection (L1-L3)."""

from .aggregates import arg_min, group_min  # noqa: F401
from .joins import either_key_join, lookup_join  # noqa: F401
from .selection import newest, select_days, select_days_by_month, write_by_month  # noqa: F401
