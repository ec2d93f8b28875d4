"""Queries that run the operators over the relational tables.

Every query reads whole tables. Where an operator wants quotes, pages or
payloads, they are derived from the tables by Spark, row by row, so the work
grows with the data.
"""

from faremeld.plans.table_queries.registry import all_queries, all_sql  # noqa: F401
from faremeld.plans.table_queries import (  # noqa: F401
    currency,
    feeds,
    merging,
    names,
    pages,
    payloads,
    runs,
    scalars,
    serving,
)
