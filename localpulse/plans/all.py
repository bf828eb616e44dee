"""All registered queries of the market library."""

from localpulse.plans import market, sites  # noqa: F401
from localpulse.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
