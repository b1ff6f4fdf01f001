"""The library's operators and analyses applied to the driver tables, with SQL oracles."""

from workload import analyses, cleaning, measures, storage
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analyses", "cleaning", "measures", "storage"]
