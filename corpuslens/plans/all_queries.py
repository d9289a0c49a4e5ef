"""Importing this module registers every query."""

from corpuslens.plans import corpus_queries, evaluation_queries, feature_queries, model_queries, profile_queries  # noqa: F401
from corpuslens.plans.registry import ORACLE, QUERIES  # noqa: F401
