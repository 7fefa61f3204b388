"""Columns that are evaluated exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add expensive columns that later steps may reference and filter on freely.

    The optimizer merges adjacent projections and copies expressions into pushed-down
    filters, so an expensive column used in three places can be evaluated three times.
    The output of a generator is never inlined, and a one-element ``inline`` costs next to
    nothing.
    """
    keep = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
