"""The registered queries and, beside each, the SQL over the raw tables that says the same."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries are named {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
