"""Where source tables come from.

A catalog gives ``scan(table, window)`` and ``declared(table)``. ``table`` is
``namespace.name``. The window is passed to the scan so that a database read can be
cut into parallel slices of it; file reads filter by pushdown and ignore it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.types import declared_pairs
from ..operators.slices import literal, slice_edges, slice_predicates
from ..operators.window import Window

__all__ = ["Catalog", "ParquetCatalog", "JdbcCatalog", "FrameCatalog"]


class Catalog(Protocol):
    def scan(self, table: str, window: Window | None = None, column: str = "updated_at") -> DataFrame: ...

    def declared(self, table: str) -> list[tuple[str, str]]: ...


class _SchemaDeclares:
    def declared(self, table: str) -> list[tuple[str, str]]:
        return declared_pairs(self.scan(table))


class ParquetCatalog(_SchemaDeclares):
    """Tables as ``<root>/<namespace>/<name>``, in any format Spark reads."""

    def __init__(self, spark: SparkSession, root: str, format: str = "parquet", suffix: str = ""):
        self.spark, self.root, self.format, self.suffix = spark, root.rstrip("/"), format, suffix

    def scan(self, table: str, window: Window | None = None, column: str = "updated_at") -> DataFrame:
        path = f"{self.root}/{table.replace('.', '/')}{self.suffix}"
        return self.spark.read.format(self.format).load(path)


class FrameCatalog(_SchemaDeclares):
    """Tables from given frames or functions that make them; also SQL tables and views."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]], declares: Mapping | None = None):
        self.frames, self.declares = dict(frames), dict(declares or {})

    def scan(self, table: str, window: Window | None = None, column: str = "updated_at") -> DataFrame:
        found = self.frames[table]
        return found() if callable(found) else found

    def declared(self, table: str) -> list[tuple[str, str]]:
        return self.declares[table] if table in self.declares else super().declared(table)


class JdbcCatalog:
    """Tables of an operational database.

    A windowed scan is cut into ``slices`` touching time ranges, read in parallel; each slice is a range on the bare
    column, which an index on it serves. A whole table is cut the same way along ``slice_by[table]``, or
    ``slice_column`` where it has that one; only a table with neither is read in one task. For a join,
    ``scan_matching`` asks only for the rows of the given keys where those are few.

    With ``equal_depth``, a table that has ``key_column`` (or ``key_by[table]``) is cut into slices of about equal numbers of rows instead: time and key
    alone are read first, and the edges taken from them also cut a time that many rows share.

    ``namespaces`` maps the namespaces of the specs to database names. ``fetch_rows`` rows come in one round trip (a MySQL
    driver needs ``useCursorFetch=true`` in the URL for it). Timestamps are read without a zone. Declared types are the database's own.
    """

    def __init__(
        self, spark: SparkSession, url: str, properties: Mapping[str, str], slices: int = 8,
        slice_by: Mapping[str, str] | None = None, slice_column: str | None = "created_at", fetch_rows: int = 10_000,
        namespaces: Mapping[str, str] | None = None, match_keys: int = 20_000,
        equal_depth: bool = False, key_column: str = "uuid", key_by: Mapping[str, str] | None = None,
    ):
        if slices < 1:
            raise ValueError("at least one slice")
        self.spark, self.url, self.slices, self.slice_by = spark, url, slices, dict(slice_by or {})
        self.slice_column, self.namespaces, self.match_keys = slice_column, dict(namespaces or {}), match_keys
        self.equal_depth, self.key_column, self.key_by = equal_depth, key_column, dict(key_by or {})
        self.properties = {"preferTimestampNTZ": "true", "fetchsize": str(fetch_rows), **properties}

    def named(self, table: str) -> str:
        """``namespace.name`` as the database calls it."""
        namespace, name = table.split(".")
        return f"{self.namespaces.get(namespace, namespace)}.{name}"

    def predicates(self, window: Window, column: str) -> list[str]:
        """Touching ranges that cover the window."""
        return [
            f"{column} >= '{w.lower:%Y-%m-%d %H:%M:%S.%f}' AND {column} < '{w.upper:%Y-%m-%d %H:%M:%S.%f}'"
            for w in window.slices(self.slices)
        ]

    def whole_predicates(self, first: datetime | None, last: datetime | None, column: str) -> list[str]:
        """Ranges that cover every row: open at both ends, and the rows without a time."""
        if first is None or first >= last or self.slices == 1:
            return ["1 = 1"]
        edges = [f"'{w.lower:%Y-%m-%d %H:%M:%S.%f}'" for w in Window(first, last).slices(self.slices)[1:]]
        inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
        return [f"{column} < {edges[0]}", *inner, f"{column} >= {edges[-1]}", f"{column} IS NULL"]

    def matching_predicates(self, column: str, keys: list) -> list[str]:
        """Lists of the keys, one for each slice."""
        size = -(-len(keys) // self.slices) if keys else 1
        parts = [keys[i:i + size] for i in range(0, len(keys), size)]
        return [f"{column} IN ({', '.join(map(literal, p))})" for p in parts] or ["1 = 0"]

    def _query(self, text: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, query=text, **self.properties).load()

    def _read(self, table: str, predicates: list[str] | None) -> DataFrame:
        if predicates is None:
            return self.spark.read.jdbc(self.url, self.named(table), properties=self.properties)
        return self.spark.read.jdbc(self.url, self.named(table), predicates=predicates, properties=self.properties)

    def _slice_column(self, table: str) -> str | None:
        if table in self.slice_by or self.slice_column is None:
            return self.slice_by.get(table)
        fields = {field.lower(): kind.lower() for field, kind in self.declared(table)}
        kind = fields.get(self.slice_column.lower(), "")
        return self.slice_column if "time" in kind or kind == "date" else None

    def scan(self, table: str, window: Window | None = None, column: str = "updated_at") -> DataFrame:
        if window is not None:
            return self._read(table, self._by_depth(table, self.predicates(window, column), column, window))
        column = self._slice_column(table)
        if column is None:
            return self._read(table, None)
        bounds = self._query(f"SELECT min({column}) AS lo, max({column}) AS hi FROM {self.named(table)}").first()
        return self._read(table, self._by_depth(table, self.whole_predicates(bounds["lo"], bounds["hi"], column), column))

    def _by_depth(self, table: str, even: list[str], column: str, window: Window | None = None) -> list[str]:
        """Slices of about equal numbers of rows, from time and key read by the even ones; those where this is not asked for or there is no key."""
        key = self.key_by.get(table, self.key_column)
        if not self.equal_depth or key.lower() not in {field.lower() for field, _ in self.declared(table)}:
            return even
        cut = slice_predicates(slice_edges(self._read(table, even), column, key, self.slices), column, key)
        if window is None:
            return cut
        inside = f"{column} >= '{window.lower:%Y-%m-%d %H:%M:%S.%f}' AND {column} < '{window.upper:%Y-%m-%d %H:%M:%S.%f}'"
        return [f"{inside} AND ({p})" for p in cut if p != f"{column} IS NULL"]

    def scan_matching(self, table: str, column: str, keys: DataFrame) -> DataFrame | None:
        """The rows whose ``column`` is among the keys (column ``key``); None where those are more than ``match_keys``."""
        if not isinstance(keys.schema["key"].dataType, (T.StringType, T.IntegralType)):
            return None
        few = [r["key"] for r in keys.where("key is not null").distinct().limit(self.match_keys + 1).collect()]
        return self._read(table, self.matching_predicates(column, sorted(few))) if len(few) <= self.match_keys else None

    def declared_query(self, table: str) -> str:
        namespace, name = self.named(table).split(".")
        return (
            "SELECT column_name AS Field, column_type AS Type FROM information_schema.columns "
            f"WHERE table_schema = '{namespace}' AND table_name = '{name}' ORDER BY ordinal_position"
        )

    def declared(self, table: str) -> list[tuple[str, str]]:
        rows = self._query(self.declared_query(table))
        return [(r["Field"], r["Type"]) for r in rows.collect()]  # one row per column of one table
