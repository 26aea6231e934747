"""All registered queries."""

from suite import cleaning, deciding, loads, monthly, published, storage  # noqa: F401
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
