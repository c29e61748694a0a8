"""All registered queries: importing the modules fills the register."""

from . import (  # noqa: F401
    diff_queries, extract_queries, field_queries, fold_queries, report_queries, road_queries, signal_queries,
    text_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
