"""Hand rows to an external key-value store through its Spark connector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.operators.latest import latest_by
from stationflow.schema import TIME


def put_rows(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    fmt: str = "org.apache.spark.sql.redis",
    order: Sequence[str] = (TIME,),
    options: dict[str, str] | None = None,
) -> None:
    """Append one row per key, the newest; the store replaces what it had for the key.

    Such connectors take one key column, so several keys are joined into ``_key``: as a JSON
    array, in which no two keys look alike whatever their values hold.
    """
    rows = latest_by(df, keys, order)
    key = keys[0]
    if len(keys) > 1:
        key = "_key"
        rows = rows.withColumn(key, F.to_json(F.array(*[F.col(k).cast("string") for k in keys])))
    (
        rows.write.format(fmt)
        .option("table", table)
        .option("key.column", key)
        .options(**(options or {}))
        .mode("append")
        .save()
    )
