"""Everything registered, in the order of the report groups."""

from claimscope.plans import cleaning, drift, evaluation, features, loads, models, quality, reports, runs  # noqa: F401
from claimscope.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
