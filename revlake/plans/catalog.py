"""Registry of queries and their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revlake.plans.fixtures import Inputs, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", oracle: str | None = None):
    """Register ``fn(inputs) -> DataFrame``; *oracle* is SQL over the named views."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Inputs(spark, folder))
        if oracle is not None:
            ORACLES[name] = with_views(views.split(), oracle)
        return fn

    return register


def scratch(spark: SparkSession, label: str) -> str:
    """New folder for a sink query, inside the shared checkpoint folder."""
    from revlake.session import shared_folder

    return f"{shared_folder(spark)}/revlake-{label}-{uuid.uuid4().hex}"


def load_all() -> None:
    from revlake.plans import (  # noqa: F401
        queries_increments, queries_profile, queries_reconcile, queries_refs, queries_scalars, queries_sources,
        queries_versioning,
    )
