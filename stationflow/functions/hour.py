"""Hour truncation that keeps the type of the time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.schema import TIME


def is_zoned(df: DataFrame) -> bool:
    return df.schema[TIME].dataType != T.TimestampNTZType()


def hour_start(time: Column, zoned: bool) -> Column:
    """``date_trunc`` would take a time without a zone through the session's zone."""
    if zoned:
        return F.date_trunc("hour", time)
    past = F.make_dt_interval(F.lit(0), F.lit(0), F.minute(time), F.extract(F.lit("SECOND"), time))
    return time - past
