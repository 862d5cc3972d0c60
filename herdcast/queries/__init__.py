"""Registered queries and the SQL that states the same results."""

from herdcast.queries import conforming, features, forecasting, models, quality, storage  # noqa: F401
from herdcast.queries.base import oracle_sql, queries  # noqa: F401
