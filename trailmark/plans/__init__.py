"""Named queries over the driver's tables and their DuckDB oracles."""

from .contract import queries
from .oracles import oracles

__all__ = ["oracles", "queries"]
