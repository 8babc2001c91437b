"""Every registered query, each beside the SQL that gives the same rows."""

from ratingloom.plans.catalog import (  # noqa: F401
    encoding,
    joining,
    measuring,
    ranking,
    rows,
    sampling,
    statistics,
    streams,
    windows,
)
from ratingloom.plans.catalog.base import ORACLES, QUERIES  # noqa: F401
