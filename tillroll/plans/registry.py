"""Queries next to the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tillroll.sources.wholesale import Wholesale

Build = Callable[[Wholesale], DataFrame]


class Registry:
    def __init__(self):
        self.builders: dict[str, Build] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str) -> Callable[[Build], Build]:
        """Register a query by its function's name."""

        def keep(build: Build) -> Build:
            self.builders[build.__name__] = build
            self.sql[build.__name__] = sql
            return build

        return keep
