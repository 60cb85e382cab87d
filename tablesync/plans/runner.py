"""Running a table spec: one generic flow of DataFrame operators.

    changed rows -> joins -> masks -> (snapshot) -> missing values, types, names -> publish

``delta`` and ``next_state`` compose the whole as one lazy plan. ``run_job`` is the
deployed form: it stages the changed rows first, because everything after depends on
them more than once (guard, snapshot, keys, publish), because the source may change
between two reads, and because a written table has a size the join planning can trust.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lattice import reinfer
from ..functions.masks import mask_table
from ..functions.text import na_normalise, to_text
from ..functions.times import shift_hours, to_time_coerce, to_time_strict
from ..functions.types import align_to_target, first_declared, to_double, to_whole, type_sync
from ..operators import columns as cols
from ..operators.aggregates import dedupe_keep_first, observe_profile
from ..operators.arrival import ARRIVAL, keep_first_arrived, with_arrival
from ..operators.joins import fan_out, lookup, preagg_join
from ..operators.replace import full_refresh, keyed_replace
from ..operators.window import Window, change_window, changed_groups, daily_window
from ..sources.bucketed import BucketedTable
from ..sources.catalog import Catalog
from ..sources.partitioned import PartitionedTable
from ..sources.published import PublishedTable
from ..sources.snapshot import snapshot_csv
from ..sources.staging import Staged, stage
from .spec import MASKED, TableSpec

__all__ = [
    "changed_rows", "enriched", "masked", "settled", "delta", "published_keys", "next_state", "published_table",
    "run_job", "run_jobs", "JobResult",
]


def _window(run: datetime | Window) -> Window:
    return run if isinstance(run, Window) else daily_window(run)


def changed_rows(spec: TableSpec, catalog: Catalog, run: datetime | Window) -> DataFrame:
    """The base rows of this run, filtered on bare columns."""
    if not spec.windowed:
        base = catalog.scan(spec.source)
    else:
        window = _window(run)
        base = change_window(catalog.scan(spec.source, window), "updated_at", window)
        if spec.whole_groups:
            base = changed_groups(catalog.scan(spec.source), "updated_at", window, spec.whole_groups, base)
    base = with_arrival(base) if spec.first_arrived else base
    return cols.all_non_zero(base, spec.non_zero)


def enriched(
    spec: TableSpec, base: DataFrame, catalog: Catalog, staging: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Joins, shifted times, copied, dropped, ordered and early-named columns.

    With ``staging``, large sides of one-to-many joins are written first, and a database is asked for the rows
    of the base keys only.
    """
    times = [c for c in ("created_at", "updated_at") if c in base.columns] if spec.shift_hours else []
    df = base if spec.shift_last else cols.shift_and_replace(base, times, spec.shift_hours)
    for join in spec.joins:
        right = None
        if staging and len(join.on) == 1 and hasattr(catalog, "scan_matching"):
            (mine, theirs), = join.on.items()
            right = catalog.scan_matching(join.table, theirs, df.select(F.col(f"`{mine}`").alias("key")))
        right = catalog.scan(join.table) if right is None else right
        if join.kind == "sum":
            df = preagg_join(df, right, join.on, join.take)
        elif join.kind == "fan_out":
            df = fan_out(df, right, join.on, join.take, staging)
        else:
            df = lookup(df, right, join.on, join.take)
        if join.shift:
            df = df.withColumns({c: shift_hours(F.col(c), hours) for c, hours in join.shift.items()})
    for joined, column in spec.replaces.items():
        df = df.drop(column).withColumnRenamed(joined, column)
    if spec.shift_last:
        df = cols.shift_and_replace(df, times, spec.shift_hours)
    for new, column in spec.copies.items():
        df = cols.copy_column(df, column, new)
    if spec.columns:
        df = cols.project(df, (*spec.columns, *([ARRIVAL] if spec.first_arrived else [])))
    df = cols.drop_and_sort_columns(df, spec.drops) if spec.sort_columns else cols.drop_columns(df, spec.drops)
    return cols.rename_swap(df, spec.early_names) if spec.early_names else df


def absent_masks(spec: TableSpec, df: DataFrame) -> list[str]:
    """Columns a spec masks that the table does not have (it may have renamed them)."""
    have = {c.lower() for c in df.columns}
    return [c for c in (*spec.value_masks, *spec.flag_masks) if c.lower() not in have]


def masked(spec: TableSpec, df: DataFrame) -> DataFrame:
    """What the snapshot holds. Masks apply to the columns the table has, in any case of letters."""
    absent = set(absent_masks(spec, df))
    df = mask_table(
        df, [c for c in spec.value_masks if c not in absent], [c for c in spec.flag_masks if c not in absent]
    )
    return na_normalise(df, lenient=True) if spec.reload == "lenient" else df


def _cast(kind: str, name: str, dtype: T.DataType, spell_null: bool) -> Column:
    c = F.col(f"`{name}`")
    if kind == "whole":
        return to_whole(c, dtype)
    if kind == "double":
        return to_double(c, dtype)
    if kind == "time":
        return to_time_strict(c)
    if kind == "time_or_null":
        return to_time_coerce(c)
    is_time = isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
    return to_text(c, dtype, null_text=("NaT" if is_time else "nan") if spell_null else None)


def settled(spec: TableSpec, df: DataFrame, catalog: Catalog) -> DataFrame:
    """Missing values, declared types, final names and casts: the rows to publish."""
    if spec.reload in ("plain", "inferred"):
        df = na_normalise(df)
    if spec.reload == "inferred":
        df = reinfer(df, [c for c in df.columns if c != ARRIVAL])
    if spec.sync:
        df = type_sync(df, _declared(spec, catalog))
    df = cols.rename_swap(df, spec.final_names)
    if spec.first_arrived:
        df = keep_first_arrived(df, spec.key)
    if spec.dedupe_order:
        df = dedupe_keep_first(df, spec.key, spec.dedupe_order)
    if spec.overwrite:
        df = df.withColumns({c: F.col(source) for c, source in spec.overwrite.items() if c in df.columns})
    types = {f.name: f.dataType for f in df.schema}
    # a flag is 0 or 1, also where its declared type made it text: there is nothing to parse
    casts = {
        c: F.col(f"`{c}`").cast("bigint") if kind == "whole" and c in spec.flag_masks else _cast(kind, c, types[c], spec.text_nulls)
        for c, kind in spec.casts.items() if c in types}
    return df.withColumns(casts) if casts else df


def _declared(spec: TableSpec, catalog: Catalog) -> list[tuple[str, str]]:
    copied = {source: new for new, source in spec.copies.items()}
    tables = [[(copied.get(field, field), t) for field, t in catalog.declared(spec.source)]]
    for join in spec.joins:
        if join.declares:
            outputs = {source: out for out, source in join.take.items()}
            tables.append([(outputs.get(field, field), t) for field, t in catalog.declared(join.table)])
    return first_declared(*tables)


def delta(spec: TableSpec, catalog: Catalog, run: datetime | Window) -> DataFrame:
    """The rows a run publishes, as one lazy plan."""
    return settled(spec, masked(spec, enriched(spec, changed_rows(spec, catalog, run), catalog)), catalog)


def published_keys(spec: TableSpec, base: DataFrame, target: DataFrame) -> DataFrame:
    """The keys of the changed rows under their published name and type.

    Taken from the base rows: left joins add no key and drop none, so they need not run.
    """
    early = {new: old for old, new in spec.early_names.items()}
    named = next((old for old, new in spec.final_names.items() if new == spec.key), spec.key)
    source = F.col(f"`{early.get(named, named)}`")
    return base.select(source.cast(target.schema[spec.key].dataType).alias(spec.key))


def next_state(
    spec: TableSpec, target: DataFrame | None, rows: DataFrame, base: DataFrame | None = None
) -> DataFrame:
    """The published table after the run, as one lazy plan.

    ``base``, the changed source rows, gives the keys without the joins of ``rows``.
    """
    if target is None or spec.publish == "full":
        return full_refresh(target, rows if target is None else align_to_target(rows, target.schema))
    keys = published_keys(spec, base, target) if base is not None else None
    return keyed_replace(target, align_to_target(rows, target.schema), spec.key, keys=keys)


@dataclass
class JobResult:
    name: str
    status: str  # published, empty, failed
    rows: int = 0
    version: str | None = None  # the version written
    snapshot: str | None = None
    non_null: dict[str, int] = field(default_factory=dict)
    absent_masks: list[str] = field(default_factory=list)  # worth a look: masks that found no column
    error: Exception | None = None


def run_job(
    spec: TableSpec, catalog: Catalog, root: str, run_ts: datetime, snapshots: str | None = None,
    window: Window | None = None, keep: int | None = 3,
) -> JobResult:
    """Run one spec and publish it under ``root``; ``keep`` limits the versions left there (None: all).

    All rows are computed before anything is published, and the publish is one commit, so
    a failure leaves the published table as it was. No changed rows: nothing is written,
    for a full replacement too.
    """
    window = window or daily_window(run_ts)
    base = stage(changed_rows(spec, catalog, window), spec.name)
    staged = [base]
    try:
        if base.rows == 0:
            return JobResult(spec.name, "empty")

        def staging(df: DataFrame, label: str) -> DataFrame:
            staged.append(stage(df, f"{spec.name}-{label}"))
            return staged[-1].read()

        full = enriched(spec, base.read(), catalog, staging)
        if spec.joins:  # read more than once below: types are judged on the rows that are cast
            full = staging(full, "joined")
        shown = masked(spec, full)
        day = window.lower.date()
        snapshot = snapshot_csv(shown.drop(ARRIVAL), snapshots, snapshot_name(spec), day) if snapshots and spec.snapshot else None
        # counted while being written: no pass of its own
        rows, profile = observe_profile(settled(spec, shown, catalog), f"{spec.name}-{run_ts:%Y%m%dT%H%M%S}")
        if spec.publish == "keyed":  # rows, their months and their count come of one reading
            rows = staging(rows, "rows")
        table = published_table(spec, base.spark, root)
        version = _publish(spec, table, base, rows, run_ts)
        if keep is not None:
            table.expire(keep)
        counts = profile.get
        non_null = {c[2:]: n for c, n in counts.items() if c.startswith("n:")}
        return JobResult(
            spec.name, "published", counts["rows"], version, snapshot, non_null, absent_masks(spec, full)
        )
    finally:
        for s in staged:
            s.release()


def snapshot_name(spec: TableSpec) -> str:
    """Tables of the unmasked dataset have it in their snapshot's name, so the two never share a folder."""
    return f"{spec.dataset}_{spec.target}" if spec.dataset != MASKED else spec.target


def published_table(spec: TableSpec, spark: SparkSession, root: str) -> PublishedTable | PartitionedTable:
    """Where a spec publishes to."""
    if spec.buckets:
        return BucketedTable(spark, root, spec.dataset, spec.target, spec.key, spec.buckets)
    if spec.by_month and spec.publish == "keyed":
        return PartitionedTable(spark, root, spec.dataset, spec.target, key=spec.key)
    return PublishedTable(spark, root, spec.dataset, spec.target)


def _publish(
    spec: TableSpec, table: PublishedTable | PartitionedTable, base: Staged, rows: DataFrame, run_ts: datetime
) -> str:
    target = table.read()
    if target is None:
        return table.replace(rows, run_ts)
    rows = align_to_target(rows, target.schema)
    if spec.publish == "full":
        return table.replace(rows, run_ts)
    more = {"skip_unchanged": True} if spec.skip_unchanged and isinstance(table, PartitionedTable) else {}
    return table.keyed_replace(rows, spec.key, run_ts, keys=published_keys(spec, base.read(), target), **more)


def run_jobs(
    specs: Iterable[TableSpec], catalog: Catalog, root: str, run_ts: datetime, snapshots: str | None = None,
    parallel: int = 4, keep: int | None = 3,
) -> list[JobResult]:
    """Run specs from a few driver threads; one failing does not stop the others."""

    def one(spec: TableSpec) -> JobResult:
        try:
            return run_job(spec, catalog, root, run_ts, snapshots, keep=keep)
        except Exception as error:  # reported in the result, in the order of the specs
            return JobResult(spec.name, "failed", error=error)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(one, specs))
