"""Published tables bucketed by their key, so that a group replace does not shuffle them.

Past the broadcast bound a delete by keys shuffles the whole target. A bucketed target is
already laid out by its key: only the keys move to it, and the delta to its buckets. Use
it for keys that are (nearly) unique. One bucket is one task, so a key that holds a good
part of the table belongs in a ``PublishedTable``, whose joins split it.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.replace import append_rows, keyed_replace
from .published import PublishedTable

__all__ = ["BucketedTable"]


class BucketedTable(PublishedTable):
    """Versioned like any published table; key and number of buckets are part of its place."""

    def __init__(self, spark: SparkSession, root: str, dataset: str, name: str, key: str, buckets: int):
        super().__init__(spark, root, dataset, f"{name}/{key}-{buckets}")
        self.key, self.buckets = key, buckets

    def _entry(self, version: str) -> str:
        """Name of a version in the session catalog, which is where Spark keeps bucketing."""
        return "tablesync_" + hashlib.sha256(f"{self.path}/{version}".encode()).hexdigest()

    def _check_place(self, entry: str, path: str) -> None:
        """Raise where the catalog's entry lies elsewhere than the version to be read."""
        shown = self.spark.sql(f"DESCRIBE TABLE EXTENDED {entry}").where("col_name = 'Location'").first()["data_type"]
        wanted = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        qualified = wanted.getFileSystem(self.spark._jsc.hadoopConfiguration()).makeQualified(wanted).toString()
        if self.spark._jvm.org.apache.hadoop.fs.Path(shown).toString() != qualified:
            raise RuntimeError(f"{entry} is a table at {shown}, not at {qualified}")

    def read(self, version: str | None = None) -> DataFrame | None:
        version = version or next(iter(self.versions()[::-1]), None)
        if version is None:
            return None
        entry, path = self._entry(version), f"{self.path}/{version}"
        if self.spark.catalog.tableExists(entry):
            self._check_place(entry, path)
        else:  # published by another session
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            self.spark.sql(
                f"CREATE TABLE {entry} ({fields}) USING parquet "
                f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(entry)

    def _save(self, df: DataFrame, version: str) -> None:
        writer = df.write.format("parquet").mode("errorifexists").bucketBy(self.buckets, self.key)
        writer.option("path", f"{self.path}/{version}").saveAsTable(self._entry(version))

    def _placed(self, df: DataFrame) -> DataFrame:
        """Rows brought to their buckets, so that a bucket gets one new file and not one per task."""
        return df.repartition(self.buckets, F.col(f"`{self.key}`"))

    def replace(self, df: DataFrame, run_ts: datetime) -> str:
        return self.write(self._placed(df), run_ts)

    def append(self, df: DataFrame, run_ts: datetime) -> str:
        return self.write(append_rows(self.read(), self._placed(df)), run_ts)

    def keyed_replace(self, delta: DataFrame, key: str, run_ts: datetime, keys: DataFrame | None = None) -> str:
        if key != self.key:
            raise ValueError(f"the table is bucketed by {self.key}")
        placed = self._placed(delta)
        return self.write(keyed_replace(self.read(), placed, key, keys=delta if keys is None else keys, placed=True), run_ts)

    def expire(self, keep: int = 2) -> list[str]:
        old = super().expire(keep)
        for version in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._entry(version)}")
        return old
