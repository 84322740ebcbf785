"""Evaluate an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator, so that later filters, joins and expressions use
    their values instead of repeating the parsing expression wherever it is read."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))
