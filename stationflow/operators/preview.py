"""Ordered preview of a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def ordered_preview(df: DataFrame, order: Sequence[str], rows: int = 20) -> DataFrame:
    """First ``rows`` in ``order``: every task keeps its own top rows, no global sort."""
    return df.orderBy(*order).limit(rows)
