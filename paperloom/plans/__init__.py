"""Derived tables and named queries."""

from . import changes, literature, statistics, texts  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
