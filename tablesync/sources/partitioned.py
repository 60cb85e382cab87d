"""Published tables kept by month, where a run writes only the months it touches.

A version is a manifest: one row per month with the folder that holds its rows, the folder's own schema, its number of rows, the size of
its key filter, and the least and greatest day in it. A group replace asks the filters which folders can hold one of its keys, reads the
key column of those alone, writes the months found anew into a folder of its own, and commits a
manifest that names the new folders and, for all other months, the old ones: unchanged data stays where
it is, and one commit marker is the switch. Readers take the newest committed manifest and never write. A run
that fails leaves folders no manifest names, which ``expire`` removes.

* Keys whose rows are the same before and after leave the replace if asked for; with none left no folder is written.
* An append with a token that a version already holds changes nothing, so a repeated run adds its rows once.
* A folder is read by its own schema and widened to the least one that holds all (``functions.lattice``), so a column may change its type.
* A purge drops whole folders by their greatest and least day and rewrites those the bound cuts.

One writer at a time. A table without the time column is one month.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, fields
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lattice import as_schema, wider_schema
from ..operators.fingerprints import unchanged_keys
from ..operators.keys import key_set, with_keys, without_keys
from ..operators.replace import append_rows, purge_trailing_days
from .keyfilter import SCHEMA as FILTER
from .keyfilter import filter_of, folders_hit
from .published import next_version
from .staging import shuffles_freed
from .staging import stage as stage_rows
from .storage import delete_dir, exists, list_dirs

__all__ = ["Folder", "PartitionedTable"]

MONTH, NO_MONTH = "created_month", "__HIVE_DEFAULT_PARTITION__"


KEEP_TOKENS = 400  # appends whose tokens a manifest remembers


@dataclass(frozen=True)
class Folder:
    """What a manifest says of the folder of one month."""

    month: int | None
    folder: str
    schema: str
    rows: int | None = None
    slots: int | None = None  # size of its key filter; None: it has none
    key: str | None = None  # the filter's column
    least: str | None = None  # of the day column
    greatest: str | None = None
    blank: int | None = None  # rows without a day


_MANIFEST = (
    "month int, folder string, schema string, rows bigint, slots bigint, key string, least string, greatest string, blank bigint, tokens array<string>"
)


class PartitionedTable:
    """One table of a dataset: ``versions/<version>`` are manifests, ``rows/<run>/created_month=<yyyymm>`` the rows, ``filters/<run>`` their key filters.

    ``key`` is the column filters are built of; without one, a group replace reads the keys of all months. ``day_column`` (text ``yyyymmdd``) is what
    ``purge`` goes by.
    """

    def __init__(
        self, spark: SparkSession, root: str, dataset: str, name: str, time_column: str = "created_at", key: str | None = None, day_column: str | None = None,
    ):
        self.spark, self.time_column, self.key, self.day_column = spark, time_column, key, day_column
        self.path = f"{root.rstrip('/')}/{dataset}/{name}"
        self.rows_path, self.versions_path, self.filters_path = f"{self.path}/rows", f"{self.path}/versions", f"{self.path}/filters"

    def _month(self, df: DataFrame) -> Column:
        kinds = {f.name.lower(): f.dataType for f in df.schema}
        if not isinstance(kinds.get(self.time_column.lower()), (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.lit(None).cast("int").alias(MONTH)
        c = F.col(f"`{self.time_column}`")
        return (F.year(c) * 100 + F.month(c)).alias(MONTH)

    # --- versions ---

    def versions(self) -> list[str]:
        """Committed versions, oldest first."""
        return [v for v in list_dirs(self.spark, self.versions_path) if exists(self.spark, f"{self.versions_path}/{v}/_SUCCESS")]

    def exists(self) -> bool:
        return bool(self.versions())

    def _newest(self) -> str | None:
        return next(iter(self.versions()[::-1]), None)

    def _listed(self, version: str) -> list:
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.versions_path}/{version}").collect()  # a row per month

    def manifest(self, version: str | None = None) -> dict[int | None, Folder]:
        """The folder of each month of a version (the newest one)."""
        version = version or self._newest()
        if version is None:
            return {}
        names = [f.name for f in fields(Folder)]
        return {r["month"]: Folder(*[r[n] for n in names]) for r in self._listed(version) if r["folder"] is not None}

    def folders(self, version: str | None = None) -> dict[int | None, str]:
        """The folder, under ``rows``, of each month of a version (the newest one)."""
        return {month: f.folder for month, f in self.manifest(version).items()}

    def tokens(self, version: str | None = None) -> list[str]:
        """The tokens of appends that a version (the newest one) holds, oldest first."""
        version = version or self._newest()
        return list(self._listed(version)[0]["tokens"] or []) if version else []

    def schema(self, version: str | None = None) -> T.StructType:
        """The least schema that holds every folder's."""
        listed = self._listed(version or self._newest())
        return wider_schema(T.StructType.fromJson(json.loads(text)) for text in dict.fromkeys(r["schema"] for r in listed))

    def _load(self, held: Iterable[Folder], schema: T.StructType) -> DataFrame:
        """Folders read by their own schemas, as ``schema``."""
        groups: dict[str, list[str]] = {}
        for f in held:
            groups.setdefault(f.schema, []).append(f"{self.rows_path}/{f.folder}")
        parts = [as_schema(self.spark.read.schema(T.StructType.fromJson(json.loads(own))).parquet(*paths), schema) for own, paths in groups.items()]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def read(self, version: str | None = None) -> DataFrame | None:
        """The newest committed version (or a named one); None before the first publish."""
        version = version or self._newest()
        return None if version is None else self._load(self.manifest(version).values(), self.schema(version))

    # --- writing ---

    def _write(self, df: DataFrame) -> dict[int | None, Folder]:
        """Write rows by month into a new folder, then its filters; gives its months."""
        run = uuid.uuid4().hex
        schema = _nullable(df.schema)
        # rebalance: one month's rows come together, and a large month is split again
        with shuffles_freed(self.spark):
            df.withColumn(MONTH, self._month(df)).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{self.rows_path}/{run}")
        names = list_dirs(self.spark, f"{self.rows_path}/{run}")
        if not names:
            return {}
        have = {c.lower(): c for c in df.columns}
        key, day = (have.get((c or "").lower()) for c in (self.key, self.day_column))
        written = self.spark.read.schema(schema).option("basePath", f"{self.rows_path}/{run}").parquet(*[f"{self.rows_path}/{run}/{n}" for n in names])
        place = F.concat(F.lit(f"{run}/{MONTH}="), F.coalesce(F.col(MONTH).cast("string"), F.lit(NO_MONTH))).alias("_folder")
        counts = [F.count(F.lit(1)).alias("rows"), *([F.count(f"`{key}`").alias("keys")] if key else [])]
        if day:
            text = F.col(f"`{day}`").cast("string")
            counts += [F.min(text).alias("least"), F.max(text).alias("greatest"), F.sum(text.isNull().cast("long")).alias("blank")]
        seen = {r["_folder"]: r.asDict() for r in written.select("*", place).groupBy("_folder").agg(*counts).collect()}  # a row per month
        slots: dict[str, int] = {}
        if key:
            held = self.spark.createDataFrame([(name, told["keys"]) for name, told in seen.items()], "folder string, n bigint")
            with shuffles_freed(self.spark):
                filter_of(written.select(f"`{key}`", place), "_folder", key, counts=held).write.parquet(f"{self.filters_path}/{run}")
            sizes = self.spark.read.schema(FILTER).parquet(f"{self.filters_path}/{run}").groupBy("folder").agg(F.max("slots").alias("slots"))
            slots = {r["folder"]: r["slots"] for r in sizes.collect()}
        made = {}
        for name in names:
            value = name.removeprefix(f"{MONTH}=")
            month, told = None if value == NO_MONTH else int(value), seen.get(f"{run}/{name}", {})
            made[month] = Folder(
                month, f"{run}/{name}", schema.json(), told.get("rows"), slots.get(f"{run}/{name}", 0) if key else None, key,
                told.get("least"), told.get("greatest"), told.get("blank"))
        return made

    def _commit(self, folders: Mapping[int | None, Folder], schema: T.StructType, run_ts: datetime, tokens: Sequence[str] = ()) -> str:
        version = next_version(list_dirs(self.spark, self.versions_path), run_ts)
        held, kept = [f for f in folders.values()], list(tokens)[-KEEP_TOKENS:]
        rows = [(*[getattr(f, c.name) for c in fields(Folder)], kept) for f in held] or [(None, None, schema.json(), *[None] * 6, kept)]
        listed = self.spark.createDataFrame(rows, _MANIFEST)
        listed.coalesce(1).write.mode("errorifexists").parquet(f"{self.versions_path}/{version}")
        return version

    def replace(self, df: DataFrame, run_ts: datetime) -> str:
        return self._commit(self._write(df), _nullable(df.schema), run_ts)

    def append(self, df: DataFrame, run_ts: datetime, token: str | None = None) -> str:
        """Add rows; months that get some are written anew. A ``token`` that a version already holds adds nothing; gives the version that holds the rows."""
        version = self._newest()
        held = self.tokens(version)
        if token is not None and token in held:
            return version
        tokens = [*held, token] if token is not None else held
        if version is None:
            return self._commit(self._write(df), _nullable(df.schema), run_ts, tokens)
        months = {r[0] for r in df.select(self._month(df)).distinct().collect()}  # a row per month at most
        return self._rewrite(version, months, None, None, df, run_ts, tokens)

    def keyed_replace(
        self, delta: DataFrame, key: str, run_ts: datetime, keys: DataFrame | None = None, skip_unchanged: bool = False, ignore: Iterable[str] = (),
    ) -> str:
        """Group replace by key. ``keys`` overrides the key source.

        With ``skip_unchanged``, keys with the same rows before and after are left as they are; ``ignore`` names columns that do not count as a difference. Where
        no key is left the new version names the folders of the old one and none is written.
        """
        version = self._newest()
        if version is None:
            return self.replace(delta, run_ts)
        wanted = key_set(delta if keys is None else keys, key)
        found = self.rows_of(wanted, key, version)
        if found is not None and skip_unchanged:
            schema = wider_schema([found.schema, delta.schema])
            same = unchanged_keys(as_schema(found, schema), as_schema(delta, schema), key, ignore)
            spot = stage_rows(same, f"same-{uuid.uuid4().hex[:8]}")
            try:
                if spot.rows:
                    same = spot.read()
                    wanted, delta = wanted.join(same, "_key", "left_anti"), without_keys(delta, same, key)
                return self._replace_groups(version, delta, key, wanted, found, run_ts)
            finally:
                spot.release()
        return self._replace_groups(version, delta, key, wanted, found, run_ts)

    def _replace_groups(self, version: str, delta: DataFrame, key: str, wanted: DataFrame, found: DataFrame | None, run_ts: datetime) -> str:
        months = delta.select(self._month(delta))
        if found is not None:
            months = months.unionByName(with_keys(found, wanted, key).select(self._month(found)))
        with shuffles_freed(self.spark):
            touched = {r[0] for r in months.distinct().collect()}  # a row per month at most
        if not touched:  # a version of its own, made of the folders that are there
            return self._commit(self.manifest(version), self.schema(version), run_ts, self.tokens(version))
        return self._rewrite(version, touched, key, wanted, delta, run_ts, self.tokens(version))

    def folders_of(self, wanted: DataFrame, key: str, version: str | None = None) -> list[Folder]:
        """The folders that can hold one of the keys (column ``_key``): those whose filter says so, and those without a filter of this column."""
        held = self.manifest(version)
        known = [f for f in held.values() if f.slots is not None and f.key == key]
        sizes = sorted({f.slots for f in known if f.slots})
        hit: list[str] = []
        if sizes:
            runs = sorted({f.folder.split("/")[0] for f in known if f.slots})
            filters = self.spark.read.schema(FILTER).parquet(*[f"{self.filters_path}/{run}" for run in runs])
            current = [f.folder for f in known]
            with shuffles_freed(self.spark):
                hit = folders_hit(filters.where(F.col("folder").isin(current)), wanted, sizes)
        return [f for f in held.values() if f not in known or f.folder in hit]

    def rows_of(self, wanted: DataFrame, key: str, version: str | None = None) -> DataFrame | None:
        """The rows with one of the keys, from the folders that can hold one; None where no folder can."""
        version = version or self._newest()
        opened = self.folders_of(wanted, key, version)
        return with_keys(self._load(opened, self.schema(version)), wanted, key) if opened else None

    def _rewrite(
        self, version: str, touched: set, key: str | None, wanted: DataFrame | None, delta: DataFrame, run_ts: datetime, tokens: Sequence[str],
    ) -> str:
        """Write months anew: their rows without the wanted keys, and the delta."""
        held, stored = self.manifest(version), self.schema(version)
        old = [held[m] for m in touched if m in held]
        rows = delta
        if old:
            # only the rewritten months take the wider types, the others keep theirs until they are read
            schema = wider_schema([*[T.StructType.fromJson(json.loads(f.schema)) for f in old], delta.schema])
            kept = self._load(old, schema)
            rows = append_rows(kept if key is None else without_keys(kept, wanted, key), as_schema(delta, schema))
        made = self._write(rows)
        rest = {m: f for m, f in held.items() if m not in touched}
        return self._commit({**rest, **made}, wider_schema([stored, delta.schema]), run_ts, tokens)

    def purge(self, as_of: date, run_ts: datetime, days: int = 4) -> str:
        """Drop the rows of the last ``days`` days up to ``as_of`` and later, by ``day_column``; rows without a day stay.

        Folders whose days all stay are not touched, folders whose days all go leave by the manifest alone; only those the bound cuts are read.
        """
        if self.day_column is None:
            raise ValueError("the table has no day column")
        version, held = self._newest(), self.manifest()
        last_kept = (as_of - timedelta(days=days)).strftime("%Y%m%d")
        told = {m: f for m, f in held.items() if f.blank is not None}
        gone = [m for m, f in told.items() if not f.blank and f.least is not None and f.least > last_kept]
        stays = [m for m, f in told.items() if m not in gone and (f.greatest is None or f.greatest <= last_kept)]
        cut = [m for m in held if m not in gone and m not in stays]
        if not gone and not cut:
            return version
        schema = self.schema(version)
        made = {}
        for m in cut:  # a month or two
            rows = self._load([held[m]], T.StructType.fromJson(json.loads(held[m].schema)))
            made.update(self._write(purge_trailing_days(rows, self.day_column, as_of, days)))
        return self._commit({**{m: held[m] for m in stays}, **made}, schema, run_ts, self.tokens(version))

    def expire(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` committed versions, and every folder and filter that none of those names."""
        good = self.versions()
        old, kept = good[: -max(keep, 1)], good[-max(keep, 1):]
        for version in list_dirs(self.spark, self.versions_path):
            if version not in kept and (version in old or version < good[-1]):  # committed and old, or never committed
                delete_dir(self.spark, f"{self.versions_path}/{version}")
        named = {f for version in kept for f in self.folders(version).values()}
        for run in list_dirs(self.spark, self.rows_path):
            months = list_dirs(self.spark, f"{self.rows_path}/{run}")
            gone = [m for m in months if f"{run}/{m}" not in named]
            for name in [run] if len(gone) == len(months) else [f"{run}/{m}" for m in gone]:
                delete_dir(self.spark, f"{self.rows_path}/{name}")
        for run in list_dirs(self.spark, self.filters_path):
            if not any(f.startswith(f"{run}/") for f in named):
                delete_dir(self.spark, f"{self.filters_path}/{run}")
        return old


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
