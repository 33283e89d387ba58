"""JSON envelopes to typed snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.schema import APPENDED, COUNT, SNAPSHOT, STATION, TIME, TIMESTAMP_FORMAT

#: How far a snapshot's time may be ahead of the time at which the log took it in.
AHEAD = "10 minutes"


def parse_snapshots(
    envelopes: DataFrame, tz: str | None = None, keep_text: bool = False, evidence: bool = False
) -> DataFrame:
    """Parse ``value`` with the declared snapshot schema, one output row per input row.

    A document that cannot be read becomes a row of NULLs and a field of the wrong type
    becomes NULL by itself; nothing is dropped and nothing raises. ``timestamp`` is
    replaced by ``event_time``. Its text is read in zone ``tz``, or in the session zone.
    Other envelope columns (topic, partition, offset) are carried along. Select fewer
    columns from the result and the optimizer parses only those JSON fields.

    ``keep_text`` keeps the text of the time as ``timestamp``. ``evidence`` adds to malformed rows, and
    only to them, the document as it came (``value``) and what it lacks (``reason``).
    """
    carried = [c for c in envelopes.columns if c != "value"]
    rows = envelopes.select(*carried, F.from_json("value", SNAPSHOT).alias("data"), *(["value"] if evidence else []))
    rows = rows.select(*carried, "data.*", *(["value"] if evidence else []))
    if tz is None:
        event_time = F.try_to_timestamp("timestamp", F.lit(TIMESTAMP_FORMAT))
    else:
        zoned = F.concat(F.col("timestamp"), F.lit(" " + tz))
        event_time = F.try_to_timestamp(zoned, F.lit(TIMESTAMP_FORMAT + " VV"))
    rows = rows.withColumn(TIME, event_time)
    if evidence:
        lacks = [F.when(F.col(c).isNull(), name) for c, name in ((STATION, "station"), (TIME, "time"), (COUNT, "count"))]
        reason = F.when(~is_usable(), F.concat(F.lit("no "), F.concat_ws(", ", *lacks)))
        rows = rows.withColumn("reason", reason).withColumn("value", F.when(reason.isNotNull(), F.col("value")))
    return rows if keep_text else rows.drop("timestamp")


def is_placed() -> Column:
    """A snapshot that names its station and its time has a place in a station's series."""
    return F.col(STATION).isNotNull() & F.col(TIME).isNotNull()


def is_usable() -> Column:
    return is_placed() & F.col(COUNT).isNotNull()


def split_malformed(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, malformed): malformed rows lack the station, the time or the count."""
    return snapshots.filter(is_usable()), snapshots.filter(~is_usable())


def set_aside_ahead(snapshots: DataFrame, tolerance: str = AHEAD, appended: str = APPENDED) -> DataFrame:
    """Take the time from rows that claim one more than ``tolerance`` after the log took them in, so that they count as malformed.

    A row dated in the future would make all later ones of its station late. Such a row keeps what it claimed as
    ``claimed_time``, and ``reason`` says why; other rows have what they had. A row whose own log time is unknown is
    taken at its word. ``event_time`` and the log's time must be of one type.
    """
    ahead = F.coalesce(F.col(TIME) > F.col(appended) + F.expr(f"INTERVAL {tolerance}"), F.lit(False))
    reason = F.col("reason") if "reason" in snapshots.columns else F.lit(None).cast("string")
    return snapshots.withColumns(
        {
            "claimed_time": F.when(ahead, F.col(TIME)),
            "reason": F.when(ahead, F.lit("time ahead of the log")).otherwise(reason),
            TIME: F.when(~ahead, F.col(TIME)),
        }
    )
