"""Importing this module registers every query."""

from lendframe.plans import evaluation, modelling, preparation, profiling  # noqa: F401
from lendframe.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
