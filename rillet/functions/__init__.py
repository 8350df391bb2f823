"""Column-level functions: projections (``columns``) and rule chains (``rules``)."""

from rillet.functions import columns, rules

__all__ = ["columns", "rules"]
