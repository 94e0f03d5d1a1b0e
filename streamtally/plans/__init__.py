"""Named queries over the driver's tables, and the SQL each must agree with."""

from .catalog import oracles, queries

__all__ = ["oracles", "queries"]
