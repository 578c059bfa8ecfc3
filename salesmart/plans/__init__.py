"""Named queries over the shared test tables, each with its SQL twin."""

from .registry import oracle_sql, queries  # noqa: F401
