"""Flow against the preceding snapshot of the same station.

A plain ``lag`` partitioned by station puts the whole history of a station in one task,
and one station may own a third of the data. Here rows are shuffled by station and *slice*,
a stretch of time of fixed length, and lagged within the slice. Only the first row of a
slice still lacks its predecessor, which is the last row of the station's previous slice.
Those edge rows, two per slice at most, are lagged by station and a longer stretch, and the
edges of these, two per stretch at most, by station. All parts of the result read the
same columns of the same shuffle, so the planner runs the scan and the shuffle once. The
plan is the same whatever the data: nothing is counted while it is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions.flow import flow_columns
from stationflow.functions.hour import is_zoned
from stationflow.functions.parse import is_placed
from stationflow.schema import COUNT, PREVIOUS, STATION, TIME

#: Rows of one station and so many seconds meet in one task.
SLICE_SECONDS = 3600
#: Edge rows of one station and so many slices meet in one task.
SLICES_PER_STRETCH = 720
#: Rows without station or time are dealt into so many slices.
STRAY_SLICES = 1 << 20


def _seconds(rows: DataFrame) -> Column:
    """A whole number that rises with the time, whatever zone the session is in."""
    if is_zoned(rows):
        return F.unix_seconds(TIME)
    of_day = F.hour(TIME) * 3600 + F.minute(TIME) * 60 + F.second(TIME)
    return F.datediff(F.to_date(TIME), F.lit("1970-01-01")).cast("long") * 86400 + of_day


def delta_lag(
    snapshots: DataFrame,
    ties: Sequence[str] = (),
    baseline: DataFrame | None = None,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Add ``prev_count, diff, rental, return``: the change since the station's last row.

    ``ties``, of any type that has an order, tell rows of equal time apart; after them the
    count does. The first row of a station has no predecessor unless ``baseline``, a state of
    one row per station, knows a count from before. ``slice_seconds`` changes who
    works on what, never the result.

    A row without station or time stands in no series: it is kept with no predecessor
    and no flow, and is dealt by its content, so a flood of malformed rows makes no hot key.
    """
    if slice_seconds < 1:
        raise ValueError("a slice has a second at least")
    stray = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in snapshots.columns]), F.lit(STRAY_SLICES))
    # A column, so that no branch below pushes its check under the shuffle they share.
    rows = snapshots.withColumns(
        {"_placed": is_placed(), "_slice": F.when(is_placed(), F.floor(_seconds(snapshots) / slice_seconds)).otherwise(stray)}
    )

    # Ending on the count makes the order of repeats of one instant reproducible.
    order = [TIME, *ties, COUNT]

    def beside(frame: DataFrame, *keys: str) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*order)
        return frame.withColumns(
            {"prev_count": F.lag(COUNT).over(window), "_before": F.lag(TIME).over(window), "_after": F.lead(TIME).over(window)}
        )

    first, last = F.col("_before").isNull(), F.col("_after").isNull()
    columns = [*snapshots.columns, "prev_count"]
    lagged = beside(rows, STATION, "_slice")
    inner = lagged.filter(~F.col("_placed") | ~first)
    inner = inner.withColumn("prev_count", F.when(F.col("_placed"), F.col("prev_count"))).select(*columns)

    edges = lagged.filter(F.col("_placed") & (first | last)).withColumns(
        {"_opens": first, "_stretch": F.floor(F.col("_slice") / SLICES_PER_STRETCH)}
    )
    edges = beside(edges, STATION, "_stretch")
    opens = edges.filter("_opens").filter(~first).select(*columns)

    ends = beside(edges.filter(first | last).withColumn("_leads", F.col("_opens") & first), STATION)
    leads = ends.filter("_leads")
    if baseline is not None:
        # The window left these rows by station, so only the baseline is shuffled.
        known = baseline.select(STATION, F.col(PREVIOUS).alias("_known"))
        carried = F.when(first, F.col("_known")).otherwise(F.col("prev_count"))
        leads = leads.join(known, STATION, "left").withColumn("prev_count", carried)
    return (
        inner.unionByName(opens)
        .unionByName(leads.select(*columns))
        .withColumn("diff", F.col(COUNT) - F.col("prev_count"))
        .withColumns(flow_columns(F.col("diff")))
    )
