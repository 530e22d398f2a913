"""Column-level functions: scalars (P2-P7, C4-C10) and JSON documents."""

from . import documents, scalars  # noqa: F401
