"""Importing this module registers every query of the subpackage."""

from ratingloom.llm import (  # noqa: F401
    chat,
    decontaminate,
    exact_dedup,
    html_extract,
    licenses,
    lm_scoring,
    merkle,
    mixing,
    near_dedup,
    periodic_runs,
    substring_dedup,
    toxicity,
    vector_search,
)
from ratingloom.llm.registry import ORACLES, QUERIES  # noqa: F401
