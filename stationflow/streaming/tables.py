"""Parquet tables a job keeps between micro-batches, on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Folder:
    """A directory reached through the session's own file-system settings."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.spark = spark
        self.path = path.rstrip("/")
        self._path_of = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path_of(self.path).getFileSystem(conf)

    def at(self, *parts: str) -> str:
        return "/".join([self.path, *parts])

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._path_of(self.at(*parts)))

    def names(self, *parts: str) -> list[str]:
        if not self.exists(*parts):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path_of(self.at(*parts)))]

    def pairs(self, outer: str, inner: str) -> list[tuple[int, int]]:
        """Numbers of all folders ``<outer>=<n>/<inner>=<n>``."""
        found = self._fs.globStatus(self._path_of(self.at(f"{outer}=*", f"{inner}=*"))) or []
        paths = [s.getPath() for s in found]
        return [(int(p.getParent().getName().split("=")[1]), int(p.getName().split("=")[1])) for p in paths]

    def make(self, *parts: str) -> None:
        self._fs.mkdirs(self._path_of(self.at(*parts)))

    def remove(self, *parts: str) -> None:
        self._fs.delete(self._path_of(self.at(*parts)), True)


#: Versions of a table that stay, so that readers of an older one can finish.
KEEP_VERSIONS = 3


class VersionedTable:
    """A small table replaced once per epoch, under ``<path>/epoch=<id>``.

    Reading only versions below an epoch makes handling that epoch twice harmless, and a
    version is never overwritten by the plan that reads it. A version counts once its
    write has committed; a damaged one raises instead of passing for an empty table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.folder = Folder(spark, path)
        self.schema = schema

    def versions(self) -> list[int]:
        found = [n.split("=")[1] for n in self.folder.names() if n.startswith("epoch=")]
        return sorted(int(v) for v in found if self.folder.exists(f"epoch={v}", "_SUCCESS"))

    def load(self, before: int | None = None, of: DataFrame | None = None) -> DataFrame:
        """Newest version, or newest below ``before``; empty only if there is none. All of it, whatever rows it is asked for."""
        usable = [v for v in self.versions() if before is None or v < before]
        spark = self.folder.spark
        if not usable:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self.folder.at(f"epoch={usable[-1]}"))

    def save(self, df: DataFrame, epoch: int, keep: int = KEEP_VERSIONS) -> None:
        """Write version ``epoch``, then drop all but the newest ``keep``."""
        columns = df.select(*self.schema.fieldNames())
        columns.write.mode("overwrite").parquet(self.folder.at(f"epoch={epoch}"))
        for old in self.versions()[:-keep]:
            self.folder.remove(f"epoch={old}")


class BucketedTable:
    """A table of one row per key, in a fixed number of buckets by the hash of the key, under ``<path>/bucket=<b>/epoch=<id>``.

    An epoch writes the buckets it touches and no others. It counts once ``<path>/committed/epoch=<id>`` is there, so a
    reader without an epoch never sees half of one. A bucket keeps the newest ``keep`` versions. The number of
    buckets must stay what it was when the table began.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int):
        if buckets < 1:
            raise ValueError("a table has a bucket at least")
        self.folder = Folder(spark, path)
        self.schema, self.keys, self.buckets = schema, list(keys), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))

    def versions(self) -> list[int]:
        """Epochs that have committed."""
        return sorted(int(n.split("=")[1]) for n in self.folder.names("committed") if n.startswith("epoch="))

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of some rows: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def load(self, before: int | None = None, of: DataFrame | None = None) -> DataFrame:
        """The newest version of every bucket, or the newest below ``before``; of the buckets that rows ``of`` are in, if given."""
        spark = self.folder.spark
        committed = set(self.versions())
        wanted = None if of is None else set(self.touched(of))
        newest: dict[int, int] = {}
        for bucket, epoch in self.folder.pairs("bucket", "epoch"):
            usable = epoch in committed if before is None else epoch < before
            if usable and (wanted is None or bucket in wanted):
                newest[bucket] = max(epoch, newest.get(bucket, epoch))
        paths = [self.folder.at(f"bucket={b}", f"epoch={e}") for b, e in sorted(newest.items())]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def save(self, df: DataFrame, epoch: int, keep: int = KEEP_VERSIONS) -> None:
        """Write the buckets of ``df``, each with all its rows, as version ``epoch``."""
        rows = df.select(*self.schema.fieldNames()).withColumns({"bucket": self.bucket(), "epoch": F.lit(epoch).cast("bigint")})
        (
            rows.hint("rebalance", F.col("bucket"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "epoch")
            .parquet(self.folder.path)
        )
        self.folder.make("committed", f"epoch={epoch}")
        versions: dict[int, list[int]] = {}
        for bucket, version in self.folder.pairs("bucket", "epoch"):
            versions.setdefault(bucket, []).append(version)
        for bucket, found in versions.items():
            for old in sorted(found)[:-keep] if epoch in found else []:
                self.folder.remove(f"bucket={bucket}", f"epoch={old}")


#: Says, under a job's root, that a back-fill has written all its tables.
SEEDED = "seeded"


class JobTables:
    """Where a job keeps its tables and its checkpoint: all under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = Folder(spark, root)
        self.checkpoint = self.root.at("checkpoint")

    def path(self, name: str) -> str:
        return self.root.at(name)

    def require_consistent(self, state: str = "state") -> None:
        """Epochs restart at 0 with a new checkpoint, so tables and checkpoint go together."""
        has_state = bool(self.root.names(state))
        seeded = self.root.exists(SEEDED)
        started = bool(self.root.names("checkpoint", "offsets"))
        finished = bool(self.root.names("checkpoint", "commits"))
        if has_state and not started and not seeded:
            raise ValueError(f"{self.root.path} has tables but no checkpoint")
        if finished and not has_state:
            raise ValueError(f"{self.root.path} has a checkpoint but no {state} table")
