"""Tables of immutable folders behind a manifest, and keyed merges that rewrite only the buckets they touch.

A table is cut into cells: partitions by column values, or buckets by a hash of
the key. Data folders are never changed. A small manifest names the live folder
of each cell; a new version is written beside it and becomes current by one
rename, so a reader sees the old or the new table and never half of one. What
no manifest of the grace period names is deleted by ``expire``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingflow.operators.journal import read_text, write_text
from listingflow.operators.snapshots import filesystem
from listingflow.session import checkpoint_dir

# A cell's values as text, in the order of the cell columns; None for NULL.
Cell = tuple[str | None, ...]

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer committed this version first; nothing of ours is visible."""


@dataclass(frozen=True)
class Manifest:
    """Live folders by cell, below the table's root, and the largest surrogate ids seen."""

    version: int
    folders: Mapping[Cell, str]
    rows: Mapping[Cell, int] = field(default_factory=dict)
    marks: Mapping[str, int] = field(default_factory=dict)
    written_ms: int = 0

    def dumps(self) -> str:
        cells = [[list(c), f, self.rows.get(c)] for c, f in sorted(self.folders.items(), key=lambda x: [v or "" for v in x[0]])]
        return json.dumps({"version": self.version, "written_ms": self.written_ms, "marks": dict(self.marks), "cells": cells})

    @staticmethod
    def loads(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(
            raw["version"], {tuple(c): f for c, f, _ in raw["cells"]}, {tuple(c): n for c, _, n in raw["cells"]},
            raw["marks"], raw["written_ms"])


def staged(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """Write rows once to the shared folder; the copy, and metrics observed on the rows as they were written.

    ``n`` is always among the metrics: the number of rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n"), *metrics).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


def drop_staged(df: DataFrame) -> None:
    """Delete the folder of a staged copy once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        fs, path = filesystem(df.sparkSession, folder)
        if path.getParent().toUri().getPath().rstrip("/") == filesystem(df.sparkSession, checkpoint_dir(df.sparkSession))[1].toUri().getPath().rstrip("/"):
            fs.delete(path, True)


@dataclass(frozen=True)
class ManifestTable:
    """A table of cells under ``root``; cell columns are stored as text in folder names and come back in their own type."""

    spark: SparkSession
    root: str
    schema: T.StructType
    cells: tuple[str, ...]

    # -- versions

    def _log(self) -> str:
        return f"{self.root}/manifests"

    def versions(self) -> list[int]:
        fs, log = filesystem(self.spark, self._log())
        if not fs.exists(log):
            return []
        names = [e.getPath().getName() for e in fs.listStatus(log)]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit())

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The newest version, or the one asked for."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return Manifest.loads(read_text(self.spark, f"{self._log()}/{version:010d}.json"))

    def publish(self, new: Manifest) -> None:
        """Make a version current by one rename; a version that is there already is a conflict."""
        fs, draft = filesystem(self.spark, f"{self._log()}/.draft-{uuid.uuid4().hex}")
        write_text(self.spark, draft.toString(), new.dumps())
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            # without an option to overwrite, the second of two writers fails
            context.rename(draft, filesystem(self.spark, f"{self._log()}/{new.version:010d}.json")[1], none)
        except Py4JJavaError as err:
            fs.delete(draft, False)
            if "FileAlreadyExists" in err.java_exception.getClass().getName():
                raise Conflict(f"version {new.version} of {self.root} is there already") from err
            raise

    # -- reading

    def read(self, cells: Iterable[Cell] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version, of some cells only if given: no other folder is listed or scanned."""
        return self.rows_of(self.manifest(version), cells)

    def rows_of(self, manifest: Manifest | None, cells: Iterable[Cell] | None = None) -> DataFrame:
        """The rows that a manifest names; without one the table is empty."""
        columns = [f"`{f.name}`" for f in self.schema.fields]
        if manifest is None:
            return self.spark.createDataFrame([], self.schema)
        wanted = manifest.folders if cells is None else [c for c in dict.fromkeys(cells) if c in manifest.folders]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        kinds = {f.name: f.dataType for f in self.schema.fields}
        stored = T.StructType([f for f in self.schema.fields if f.name not in self.cells]
                              + [T.StructField(c, kinds.get(c, T.IntegerType())) for c in self.cells])
        paths = [f"{self.root}/data/{manifest.folders[c]}" for c in wanted]
        return self.spark.read.option("basePath", f"{self.root}/data").schema(stored).parquet(*paths).select(*columns)

    # -- writing

    def replace(self, rows: DataFrame, touched: Iterable[Cell] | None, old: Manifest | None,
                marks: Mapping[str, int] | Callable[[], Mapping[str, int]] | None = None) -> Manifest:
        """A new version in which the touched cells (None: all) hold exactly ``rows`` and the others are carried over.

        Marks that only the written rows can tell are given as a function.

        ``rows`` has the schema's columns and the cell columns. Rows meet by cell
        before they are written, so a cell is no more files than its
        size asks for.
        """
        write = f"write={uuid.uuid4().hex}"
        path = f"{self.root}/data/{write}"
        # adaptive execution splits a large cell and joins small ones
        rows.hint("rebalance", *[F.col(f"`{c}`") for c in self.cells]).write.partitionBy(*self.cells).parquet(path)
        written = self._written(path)
        # one row per touched cell; Parquet answers the count from its footers
        counted = self._counts(path, written)
        keep = {} if old is None or touched is None else {c: f for c, f in old.folders.items() if c not in set(touched)}
        new = Manifest(
            (old.version if old else 0) + 1, keep | {c: f"{write}/{sub}" for c, sub in written.items()},
            {c: n for c, n in (old.rows if old else {}).items() if c in keep} | counted,
            dict(old.marks if old else {}) | dict(marks() if callable(marks) else marks or {}), int(time.time() * 1000))
        self.publish(new)
        return new

    def _written(self, path: str) -> dict[Cell, str]:
        """Cells below a data folder with their folder, relative to it."""
        fs, top = filesystem(self.spark, path)
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found: dict[Cell, tuple[str, object]] = {(): ("", top)}
        for column in self.cells:
            deeper = {}
            for values, (sub, folder) in found.items():
                for entry in fs.listStatus(folder):
                    name = entry.getPath().getName()
                    if name.startswith(f"{column}="):
                        value = name.partition("=")[2]
                        value = None if value == "__HIVE_DEFAULT_PARTITION__" else str(unescape(value))
                        deeper[(*values, value)] = (f"{sub}/{name}".lstrip("/"), entry.getPath())
            found = deeper
        return {c: sub for c, (sub, _) in found.items() if c}

    def _counts(self, path: str, written: Mapping[Cell, str]) -> dict[Cell, int]:
        if not written:
            return {}
        rows = self.spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in self.cells])).parquet(path)
        return {tuple(r[c] for c in self.cells): r["n"] for r in rows.groupBy(*self.cells).agg(F.count(F.lit(1)).alias("n")).collect()}

    # -- expiry

    def expire(self, grace_ms: int, now_ms: int | None = None) -> list[str]:
        """Delete versions older than the grace period, except the current one, and data that no version left names.

        Data younger than the grace period stays, so a write in progress does no
        harm. The deleted names are returned.
        """
        now = int(time.time() * 1000) if now_ms is None else now_ms
        fs, _ = filesystem(self.spark, self.root)
        gone, live = [], set()
        known = self.versions()
        for n in known:
            m = self.manifest(n)
            # readers of a version may have started until the next one was published
            ended = None if n == known[-1] else self.manifest(n + 1).written_ms if n + 1 in known else m.written_ms
            if ended is not None and ended < now - grace_ms:
                fs.delete(filesystem(self.spark, f"{self._log()}/{n:010d}.json")[1], False)
                gone.append(f"manifests/{n:010d}.json")
            else:
                live.update(m.folders.values())
        data = filesystem(self.spark, f"{self.root}/data")[1]
        for write in fs.listStatus(data) if fs.exists(data) else []:
            name = write.getPath().getName()
            own = {f for f in live if f.startswith(f"{name}/")}
            if write.getModificationTime() >= now - grace_ms:
                continue
            if not own:
                fs.delete(write.getPath(), True)
                gone.append(f"data/{name}")
                continue
            for sub in self._written(f"{self.root}/data/{name}").values():
                if f"{name}/{sub}" not in own:
                    fs.delete(filesystem(self.spark, f"{self.root}/data/{name}/{sub}")[1], True)
                    gone.append(f"data/{name}/{sub}")
        return gone


def buckets_for(table_bytes: int, bucket_bytes: int = 256 << 20) -> int:
    """Buckets of about that size; fixed when the table is created."""
    return max(1, -(-table_bytes // bucket_bytes))


@dataclass(frozen=True)
class BucketTable(ManifestTable):
    """A keyed table in buckets by a hash of its key; merges read and write the buckets of the changed keys only."""

    keys: tuple[str, ...] = ()
    buckets: int = 16
    surrogate: str | None = None

    @staticmethod
    def of(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = 16, surrogate: str | None = None) -> BucketTable:
        return BucketTable(spark, root, schema, (BUCKET,), tuple(keys), buckets, surrogate)

    def bucket(self, df: DataFrame) -> Column:
        """The bucket of a row; keys count in the table's types, NULL keys have a bucket too."""
        kinds = {f.name: f.dataType for f in self.schema.fields}
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast(kinds[k]) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def load(self, rows: DataFrame) -> Manifest:
        """A new version that holds exactly these rows."""
        old = self.manifest()
        rows = self._fitted(rows)
        return self.replace(rows.withColumn(BUCKET, self.bucket(rows)), None, old, self._marks(rows))

    def _fitted(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _marks(self, rows: DataFrame, least: int = 0) -> dict[str, int]:
        if self.surrogate is None:
            return {}
        return {self.surrogate: max(least, rows.agg(F.max(F.col(self.surrogate).cast("long"))).head()[0] or 0)}

    def touched(self, rows: DataFrame) -> list[Cell]:
        """Buckets of the rows' keys: as many as the table has at most."""
        return [(str(r[0]),) for r in rows.select(self.bucket(rows).alias("b")).distinct().collect()]

    def merge(self, change, attempts: int = 5) -> Manifest | None:
        """Merge one planned change; None if it has no rows.

        Its rows are evaluated once, into a staged copy; the guard against an
        empty source reads the count observed there.
        """
        rows, seen = staged(change.rows, "change")
        done = self.merge_staged(change.with_rows(rows), attempts) if seen["n"] or change.mode == "truncate" else None
        drop_staged(rows)
        return done

    def merge_staged(self, change, attempts: int = 5) -> Manifest:
        """Merge a change whose rows are cheap to read again.

        If another writer was first, it is merged again into what that one wrote.
        """
        for _ in range(attempts - 1):
            try:
                return self._merged(change, self.manifest())
            except Conflict:
                continue
        return self._merged(change, self.manifest())

    def _merged(self, change, old: Manifest | None) -> Manifest:
        if change.mode == "truncate":
            whole = self._fitted(change.apply(self.rows_of(None)))
            return self.replace(whole.withColumn(BUCKET, self.bucket(whole)), None, old, self._marks(whole))
        # a change by other columns than the table's key may touch any bucket
        by_key = tuple(change.keys) == self.keys
        touched = self.touched(change.rows) if by_key else list(old.folders) if old else []
        target = self.rows_of(old, touched)
        if self.surrogate is not None and change.mode in ("keep_id", "insert_numbered"):
            # numbers go on from the largest of the whole table, which the manifest knows
            change = change.with_start(old.marks.get(self.surrogate, 0) if old else 0)
        after = self._fitted(change.apply(target))
        after, marks = after.withColumn(BUCKET, self.bucket(after)), None
        if self.surrogate is not None:
            # seen on the rows as they are written
            seen, known = Observation(), old.marks.get(self.surrogate, 0) if old else 0
            after = after.observe(seen, F.max(F.col(self.surrogate).cast("long")).alias("top"))
            marks = lambda: {self.surrogate: max(seen.get["top"] or 0, known)}
        return self.replace(after, touched if by_key else None, old, marks)
