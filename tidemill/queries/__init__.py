"""Example queries over the driver's tables, with the SQL each must agree with."""

from . import aggregates, checks, files, flows, joins, reports, streams, transform  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
