"""Registry of this subpackage's queries and their SQL."""

from __future__ import annotations

import functools

from capstan.session import ship_package

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run

    return wrap
