"""Registered queries over the given tables, with the same query in SQL where SQL can say it."""

from gleaner.plans import (  # noqa: F401
    item_queries,
    matching_queries,
    page_queries,
    policy_queries,
    run_queries,
    source_queries,
    text_queries,
    url_queries,
)
from gleaner.plans.registry import ORACLES, QUERIES  # noqa: F401
