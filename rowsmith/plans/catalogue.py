"""Loads every query module so that the registry is complete."""

from rowsmith.plans import q_sources, q_clean, q_scalar, q_stats, q_relate, q_series  # noqa: F401
from rowsmith.plans import q_features, q_models, q_evaluate, q_stream  # noqa: F401
from rowsmith.plans.registry import ORACLES, QUERIES  # noqa: F401
