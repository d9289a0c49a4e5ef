"""Importing this module registers every query of the subpackage."""

from corpuslens.llm import (  # noqa: F401
    alignment, cotraining, html_text, license_scan, line_dedup, mixing, packing, quality_rules, shingle_join, spelling, url_filter, vector_dedup, warc,
)
from corpuslens.llm.registry import ORACLE, QUERIES  # noqa: F401
