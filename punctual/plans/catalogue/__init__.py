"""The registered queries: each operator applied to the given tables, with the SQL it must agree with."""

from punctual.plans.catalogue import evaluation, history, labels, large, models, quality, samples, sinks, streams  # noqa: F401
from punctual.plans.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
