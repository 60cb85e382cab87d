"""A replicated table described as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

__all__ = ["MASKED", "Join", "TableSpec"]

MASKED = "datascience_public"  # the dataset whose personal columns are masked


@dataclass(frozen=True)
class Join:
    """One left join of a spec.

    ``on`` maps a column of the rows so far (base or earlier join) to the joined table's;
    ``take`` maps output name to the joined table's column (for ``sum``: summed per key).
    """

    table: str
    on: Mapping[str, str]
    take: Mapping[str, str]
    kind: str = "lookup"  # lookup: many to one; fan_out: one to many; sum: pre-aggregated
    shift: Mapping[str, int] = field(default_factory=dict)  # output name -> hours
    declares: bool = False  # do its declared types count for the type sync?


@dataclass(frozen=True)
class TableSpec:
    """What one job does to one source table.

    Names that a source table does not have are ignored: its columns may change.
    """

    name: str
    source: str
    target: str
    key: str
    dataset: str = MASKED
    publish: str = "keyed"  # keyed: group replace by key; full: replace the table
    windowed: bool = True  # only the rows changed in the window
    whole_groups: str | None = None  # window on this column's groups instead of single rows
    non_zero: tuple[str, ...] = ()
    joins: tuple[Join, ...] = ()
    replaces: Mapping[str, str] = field(default_factory=dict)  # joined name -> column it takes over
    shift_hours: int = 0  # of created_at and updated_at
    shift_last: bool = False  # shifted columns go behind the joined ones
    copies: Mapping[str, str] = field(default_factory=dict)  # new name -> column
    columns: tuple[str, ...] = ()  # explicit projection
    drops: tuple[str, ...] = ()
    sort_columns: bool = False
    early_names: Mapping[str, str] = field(default_factory=dict)  # before the snapshot
    names: Mapping[str, str] | None = None  # after it; default: uuid -> key
    value_masks: tuple[str, ...] = ()
    flag_masks: tuple[str, ...] = ()
    snapshot: bool = True
    reload: str | None = "plain"  # missing-value tokens become NULL: plain, lenient, inferred (types are judged anew), or not at all
    sync: bool = True
    dedupe_order: tuple[str, ...] = ()
    first_arrived: bool = False  # of rows of one key the first one read stays
    overwrite: Mapping[str, str] = field(default_factory=dict)  # column -> column it is set from
    casts: Mapping[str, str] = field(default_factory=dict)  # whole, double, text, time, time_or_null
    text_nulls: bool = False  # text casts spell NULL out
    by_month: bool = True  # group replaces keep the published table by creation month and write touched months only
    skip_unchanged: bool = False  # keys whose rows did not change leave a group replace, so their months are not rewritten
    buckets: int = 0  # instead bucketed by its key, which a group replace then does not shuffle
    legacy: Mapping[str, object] = field(default_factory=dict)

    @property
    def final_names(self) -> Mapping[str, str]:
        return {"uuid": self.key} if self.names is None else self.names

    def verbatim(self) -> "TableSpec":
        """The historic behaviour, slips included, where this spec departs from it."""
        return replace(self, text_nulls=True, **self.legacy)
