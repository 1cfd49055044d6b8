"""The registered queries: each operator on the given tables, with SQL that states the answer."""

from .common import ORACLES, QUERIES
from . import cursors, maintenance, masks, scans, shaping, streams  # noqa: F401  (they register)

__all__ = ["ORACLES", "QUERIES"]
