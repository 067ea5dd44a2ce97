"""All queries of the engine by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import imaging, relational  # noqa: F401 (imaging adds its queries)


def queries() -> dict[str, Callable]:
    return dict(relational.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(relational.SQL)
