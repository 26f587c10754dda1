"""The registered queries over the test tables, and the SQL that must give the same rows."""

from checks import layers, listings, tables
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "layers", "listings", "tables"]
