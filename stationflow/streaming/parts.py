"""Tables of a job that grow by a part per day and micro-batch, and are folded so that a day stays few parts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.streaming.tables import Folder, JobTables

#: A day with so many parts is folded.
FOLD_AFTER = 32
#: Below all epochs, that of a back-fill included.
UNFOLDED = -(1 << 62)


class DayParts:
    """Rows under ``<name>/event_date=<day>/epoch=<id>``, and what has been folded under ``<name>_folded/event_date=<day>/upto=<id>``.

    Writing an epoch again replaces its own parts. A reader names only the days it needs, and reads of each the newest
    folded version and the parts after it. Folding never touches the newest epoch, the only one that
    may be handled again; a version counts once its write has committed, and parts go only after that.
    """

    def __init__(self, tables: JobTables, name: str, schema: T.StructType, fold: Callable[[DataFrame], DataFrame]):
        spark = tables.root.spark
        self.spark, self.fold_rows = spark, fold
        self.parts, self.folded = Folder(spark, tables.path(name)), Folder(spark, tables.path(f"{name}_folded"))
        self.columns = [f.name for f in schema]
        self.schema = schema
        self.read_schema = T.StructType([*schema, T.StructField("event_date", T.StringType()), T.StructField("epoch", T.LongType())])

    def write(self, rows: DataFrame, epoch: int, day: str) -> None:
        """``day`` names the time whose day a row belongs to."""
        rows = rows.select(*self.columns, F.to_date(day).cast("string").alias("event_date"), F.lit(epoch).cast("bigint").alias("epoch"))
        (
            rows.hint("rebalance", F.col("event_date"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "epoch")
            .parquet(self.parts.path)
        )

    def days(self) -> list[date]:
        names = {*self.parts.names(), *self.folded.names()}
        return sorted(date.fromisoformat(n.split("=")[1]) for n in names if n.startswith("event_date=") and not n.endswith("__"))

    def _epochs(self, day: date, epoch: int) -> tuple[int, list[int]]:
        """(newest folded version up to ``epoch``, or UNFOLDED; epochs of the parts after it, up to ``epoch``)"""
        name = f"event_date={day}"
        versions = [int(n.split("=")[1]) for n in self.folded.names(name) if n.startswith("upto=")]
        done = max((v for v in versions if v <= epoch and self.folded.exists(name, f"upto={v}", "_SUCCESS")), default=UNFOLDED)
        parts = [int(n.split("=")[1]) for n in self.parts.names(name) if n.startswith("epoch=")]
        return done, sorted(e for e in parts if done < e <= epoch)

    def paths(self, epoch: int, wanted: Sequence[date]) -> tuple[list[str], list[str]]:
        """Folders of parts and of folded versions that hold these days up to an epoch."""
        parts, folded = [], []
        for day in sorted(set(wanted)):
            done, epochs = self._epochs(day, epoch)
            folded += [self.folded.at(f"event_date={day}", f"upto={done}")] if done > UNFOLDED else []
            parts += [self.parts.at(f"event_date={day}", f"epoch={e}") for e in epochs]
        return parts, folded

    def read(self, epoch: int, wanted: Sequence[date]) -> DataFrame:
        """The rows of these days up to an epoch, with ``event_date`` and ``epoch``; folded ones have the last epoch folded."""
        parts, folded = self.paths(epoch, wanted)
        found = []
        if parts:
            reader = self.spark.read.schema(self.read_schema).option("basePath", self.parts.path)
            found.append(reader.parquet(*parts))
        if folded:
            schema = T.StructType([*self.schema, T.StructField("event_date", T.StringType()), T.StructField("upto", T.LongType())])
            reader = self.spark.read.schema(schema).option("basePath", self.folded.path)
            found.append(reader.parquet(*folded).withColumnRenamed("upto", "epoch"))
        if not found:
            return self.spark.createDataFrame([], self.read_schema)
        return reduce(DataFrame.unionByName, found)

    def fold(self, epoch: int, wanted: Sequence[date], after: int = FOLD_AFTER) -> None:
        """Fold what is older than ``epoch`` of those of these days that have more than ``after`` parts.

        Each part is folded once in ``after`` epochs, so the work stays in proportion to what is written.
        """
        for day in wanted:
            if len(self.paths(epoch, [day])[0]) <= after:
                continue
            name = f"event_date={day}"
            rows = self.fold_rows(self.read(epoch - 1, [day])).select(*self.columns)
            rows.hint("rebalance").write.mode("overwrite").parquet(self.folded.at(name, f"upto={epoch - 1}"))
            for old in self.folded.names(name):
                if old.startswith("upto=") and int(old.split("=")[1]) < epoch - 1:
                    self.folded.remove(name, old)
            for old in self.parts.names(name):
                if old.startswith("epoch=") and int(old.split("=")[1]) < epoch:
                    self.parts.remove(name, old)
