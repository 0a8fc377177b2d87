"""All registered queries; importing this module registers them."""

from tidemark.plans import basics, dimension, messages, revenue, storage, windows  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
