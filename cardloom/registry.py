"""The library's queries over the driver's tables, and their SQL."""

from .plans.oracles import SQL
from .plans.queries import QUERIES

__all__ = ["QUERIES", "SQL"]
