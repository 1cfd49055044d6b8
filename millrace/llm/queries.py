"""The queries of the operators, by name."""

from . import backoff, collocations, decontaminate, minhash_dedup, nearest, packing, periodic_runs, private, quality, repeated_passages, repeats, revisits, token_counts  # noqa: F401  (they register)
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
