"""The registered queries: every operator over the given tables, with its SQL check."""

from siltwork.queries import (  # noqa: F401
    click_queries,
    finance_queries,
    income_queries,
    published_queries,
    rule_queries,
    shop_queries,
    stream_queries,
    table_queries,
    word_queries,
)
from siltwork.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
