"""Column expressions that turn a change in parked bikes into rentals and returns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flow_columns(change: Column) -> dict[str, Column]:
    """Bikes taken and bikes brought back. An unknown (NULL) change moves none.

    ``greatest`` skips NULLs, so it is the sign split and the NULL default in one.
    """
    none = F.lit(0)
    return {"rental": F.greatest(-change, none), "return": F.greatest(change, none)}
