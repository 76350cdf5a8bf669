"""Importing this module registers every query of the panel engine."""

from panelmill.plans import queries_panel, queries_profile, queries_scores, queries_trips  # noqa: F401
from panelmill.plans.catalog import ORACLE, QUERIES  # noqa: F401
