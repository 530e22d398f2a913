"""Keyed sinks (K1-K3), typed inserts and constraint checks (K4-K5), table store (K6)."""

from .constraints import check_constraints, conform_to, split_violations  # noqa: F401
from .keyed import merge_insert_ignore, merge_upsert, new_rows, one_per_key  # noqa: F401
from .store import TableStore  # noqa: F401
