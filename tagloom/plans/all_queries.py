"""Every registered query; importing this module fills the book."""

from tagloom.plans import (  # noqa: F401
    q_aggregates,
    q_filters,
    q_functions,
    q_joins,
    q_learning,
    q_preparation,
    q_profiles,
    q_sources,
    q_streaming,
    q_tags,
)
from tagloom.plans.book import ORACLES, PLANS, run
from tagloom.plans.datasets import Data

__all__ = ["ORACLES", "PLANS", "Data", "run"]
