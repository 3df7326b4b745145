"""Planned changes: what a job would write, separate from writing it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from listingflow import schemas as S
from listingflow.operators import merge
from listingflow.operators.journal import Entry, Journal
from listingflow.operators.snapshots import SnapshotTable, write_preview
from listingflow.operators.store import BucketTable, drop_staged, staged
from listingflow.sources.catalog import Catalog


@dataclass(frozen=True)
class Change:
    """Rows for one target table and the merge that brings them in.

    ``mode`` is upsert, replace, insert_ignore, insert_numbered, keep_id,
    truncate, update or delete.
    """

    table: str
    rows: DataFrame
    keys: tuple[str, ...]
    mode: str = "upsert"
    columns: tuple[str, ...] = ()
    on_duplicate: str = "error"
    when: Column | None = None
    order: tuple[Column, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    # the largest number given so far, for a target that is only part of its table
    start: int | None = None

    def with_rows(self, rows: DataFrame) -> Change:
        return replace(self, rows=rows)

    def with_start(self, start: int) -> Change:
        return replace(self, start=start)

    def apply(self, target: DataFrame) -> DataFrame:
        """The target as it is after this change."""
        keys, order = list(self.keys), list(self.order) or None
        if self.mode == "upsert":
            return merge.upsert(target, self.rows, keys, self.defaults, self.on_duplicate, order)
        if self.mode == "replace":
            return merge.replace_rows(target, self.rows, keys, self.defaults, self.on_duplicate, order)
        if self.mode == "insert_ignore":
            return merge.insert_ignore(target, self.rows, keys, self.defaults, order)
        if self.mode == "insert_numbered":
            return merge.insert_ignore_numbered(target, self.rows, keys[0], "id", self.defaults, self.on_duplicate, self.start)
        if self.mode == "keep_id":
            return merge.upsert_keep_id(target, self.rows, keys[0], "id", self.defaults, self.on_duplicate, self.start)
        if self.mode == "truncate":
            return merge.truncate_load(self.rows, keys, order)
        if self.mode == "update":
            return merge.update_from(target, self.rows, keys, self.columns, self.when, order)
        if self.mode == "delete":
            return merge.delete_matching(target, self.rows, keys)
        raise ValueError(f"mode: {self.mode!r}")


def into(schema: T.StructType, table: str, rows: DataFrame, mode: str = "upsert", **options) -> Change:
    """A change keyed and defaulted by a declared layout."""
    return Change(table, rows, tuple(S.keys_of(schema)), mode, defaults=S.defaults_of(schema), **options)


def planned(catalog: Catalog, changes: Iterable[Change], schemas: Mapping[str, T.StructType] | None = None) -> Catalog:
    """The catalog as it would be after the changes, so a later stage can be planned on top."""
    for change in changes:
        target = _target(catalog, change, schemas or {})
        catalog = catalog.overlay(**{change.table: change.apply(target)})
    return catalog


def preview(changes: Iterable[Change], path: str) -> list[str]:
    """Write each change's rows as CSV below ``path``; nothing is merged."""
    out = []
    for number, change in enumerate(changes):
        target = f"{path}/{number:02d}-{change.table}-{change.mode}"
        write_preview(change.rows, target)
        out.append(target)
    return out


def _target(catalog: Catalog, change: Change, schemas: Mapping[str, T.StructType]) -> DataFrame:
    if change.table in schemas:
        return catalog.read_or_empty(change.table, schemas[change.table])
    return catalog.read(change.table)


class Sink(Protocol):
    """Where a planned change goes."""

    def take(self, change: Change, target: Callable[[], DataFrame]) -> object | None:
        """Merge a change whose rows were written once; ``target`` gives the table as the catalog has it."""

    def read(self) -> DataFrame: ...


@dataclass(frozen=True)
class SnapshotSink:
    """A whole new snapshot for each change."""

    table: SnapshotTable

    def take(self, change: Change, target: Callable[[], DataFrame]) -> str:
        return self.table.commit(change.apply(target()))

    def read(self) -> DataFrame:
        return self.table.read()


@dataclass(frozen=True)
class BucketSink:
    """Only the buckets of the changed keys; the table itself is the target."""

    table: BucketTable

    def take(self, change: Change, target: Callable[[], DataFrame]) -> str:
        if self.table.manifest() is None:
            self.table.load(target())
        return f"{self.table.root}@{self.table.merge_staged(change).version}"

    def read(self) -> DataFrame:
        return self.table.read()


def _sink(store: object) -> Sink:
    return SnapshotSink(store) if isinstance(store, SnapshotTable) else BucketSink(store) if isinstance(store, BucketTable) else store


def commit(
    catalog: Catalog, changes: Iterable[Change], stores: Mapping[str, SnapshotTable | BucketTable | Sink],
    schemas: Mapping[str, T.StructType] | None = None,
) -> list[str]:
    """Merge changes one after another, each into the sink of its table.

    A change's rows are evaluated once, as they are written to the shared
    folder; the guard against an empty change reads the count observed there.
    An empty change writes nothing. A later change to the same table merges
    into what the earlier one wrote. Tables with a declared layout may be absent.
    """
    written = []
    for change in changes:
        rows, seen = staged(change.rows, "change")
        if seen["n"]:
            sink = _sink(stores[change.table])
            written.append(sink.take(change.with_rows(rows), lambda c=change: _target(catalog, c, schemas or {})))
            catalog.bind(change.table, sink.read)
        drop_staged(rows)
    return written


def _noted(change: Change) -> dict[str, object]:
    """What is needed to plan a change again besides its rows; columns of expressions can't be written down."""
    if change.when is not None or change.order:
        raise ValueError(f"a change of {change.table} with conditions or an order can't be journaled")
    return {"table": change.table, "keys": list(change.keys), "mode": change.mode, "columns": list(change.columns),
            "on_duplicate": change.on_duplicate, "defaults": dict(change.defaults)}


def _recorded(entry: Entry, label: str) -> Change:
    n = entry.notes[label]
    return Change(n["table"], entry.frame(label), tuple(n["keys"]), n["mode"], tuple(n["columns"]), n["on_duplicate"], defaults=n["defaults"])


def resume(catalog: Catalog, journal: Journal, name: str, stores: Mapping[str, SnapshotTable | BucketTable | Sink],
           schemas: Mapping[str, T.StructType] | None = None) -> list[str]:
    """Finish what earlier runs of a job recorded and did not close; merges that were done already change nothing."""
    written = []
    for entry in journal.open(name):
        for label in entry.labels():
            change = _recorded(entry, label)
            sink = _sink(stores[change.table])
            if not change.rows.isEmpty():
                written.append(sink.take(change, lambda c=change: _target(catalog, c, schemas or {})))
                catalog.bind(change.table, sink.read)
        journal.close(entry)
    return written


def commit_all(catalog: Catalog, changes: Sequence[Change], stores: Mapping[str, SnapshotTable | BucketTable | Sink], journal: Journal,
               name: str, schemas: Mapping[str, T.StructType] | None = None) -> list[str]:
    """Merge changes to several tables so that a stop between them is made good by the next ``resume``.

    All rows are computed once, before the first table changes.
    """
    journal.record(name, {f"{n:03d}-{c.table}": (c.rows, _noted(c)) for n, c in enumerate(changes)})
    return resume(catalog, journal, name, stores, schemas)


# A step plans one change from the tables as the steps before it leave them.
Step = Callable[[Catalog], Change]


def plan_steps(
    catalog: Catalog, steps: Sequence[Step], schemas: Mapping[str, T.StructType] | None = None
) -> list[Change]:
    """All changes without writing any to its table: each step sees the planned output of the ones before.

    A change's rows and the table as it would be are written once to the shared
    folder, and later steps read these copies: no step is computed again by the
    steps after it.
    """
    changes = []
    for number, step in enumerate(steps):
        change = step(catalog)
        if number + 1 < len(steps):
            change = change.with_rows(staged(change.rows, "planned-rows")[0])
            after = staged(change.apply(_target(catalog, change, schemas or {})), "planned-table")[0]
            catalog = catalog.overlay(**{change.table: after})
        changes.append(change)
    return changes


def run_steps(
    catalog: Catalog, steps: Sequence[Step], stores: Mapping[str, SnapshotTable],
    schemas: Mapping[str, T.StructType] | None = None,
) -> list[str]:
    """Plan and write step by step: each step reads what the ones before have written."""
    written = []
    for step in steps:
        written += commit(catalog, [step(catalog)], stores, schemas)
    return written
