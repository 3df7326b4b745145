"""Writing merge results: versioned snapshots, partition overwrite, previews.

A path that is being read is never overwritten. Whole tables are written as a
new snapshot folder. Partitioned tables rewrite only the partitions a change
touches, from a staged copy.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def filesystem(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


@dataclass(frozen=True)
class SnapshotTable:
    """A table kept as numbered snapshot folders under ``root``.

    The current one is the highest number whose write finished; Spark's own
    success marker, written last, is the switch. Older ones stay for readers
    that started before it, until ``expire`` deletes them.
    """

    spark: SparkSession
    root: str

    def _numbers(self) -> list[int]:
        fs, root = filesystem(self.spark, self.root)
        if not fs.exists(root):
            return []
        names = [entry.getPath().getName() for entry in fs.listStatus(root)]
        return sorted(int(n.split("-")[1]) for n in names if n.startswith("snapshot-"))

    def _path(self, number: int) -> str:
        return f"{self.root}/snapshot-{number:08d}"

    def current(self) -> str | None:
        for number in reversed(self._numbers()):
            fs, marker = filesystem(self.spark, f"{self._path(number)}/_SUCCESS")
            if fs.exists(marker):
                return self._path(number)
        return None

    def read(self) -> DataFrame:
        path = self.current()
        if path is None:
            raise FileNotFoundError(f"no snapshot under {self.root}")
        return self.spark.read.parquet(path)

    def commit(self, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Write the next snapshot; a failed write leaves the old one current."""
        path = self._path(max(self._numbers(), default=0) + 1)
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return path

    def expire(self, grace_ms: int, now_ms: int | None = None) -> list[str]:
        """Delete snapshots that were replaced, or writes that were given up, longer than the grace period ago.

        A reader may have started on a snapshot until the next finished one came;
        the current one always stays.
        """
        now = int(time.time() * 1000) if now_ms is None else now_ms
        fs, _ = filesystem(self.spark, self.root)
        markers = {n: filesystem(self.spark, f"{self._path(n)}/_SUCCESS")[1] for n in self._numbers()}
        finished = {n: fs.getFileStatus(m).getModificationTime() for n, m in markers.items() if fs.exists(m)}
        gone = []
        for number in markers:
            replaced = [t for n, t in finished.items() if n > number]
            if replaced and min(replaced) < now - grace_ms:
                fs.delete(filesystem(self.spark, self._path(number))[1], True)
                gone.append(self._path(number))
        return gone


def touched_partitions(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], partition_by: Sequence[str]
) -> DataFrame:
    """Distinct partitions that hold a changed key now or will hold one."""
    cols = list(partition_by)
    now = target.join(changes.select(*keys), list(keys), "left_semi").select(*cols)
    return now.unionByName(changes.select(*cols)).distinct()


def _partition_folders(spark: SparkSession, path: str, cols: Sequence[str]) -> dict[tuple, object]:
    """Partition values (None for an unknown one) and folders of a partitioned table, as its folders name them."""
    fs, root = filesystem(spark, path)
    found = {(): root}
    for col in cols:
        deeper = {}
        for values, folder in found.items():
            for entry in fs.listStatus(folder):
                name, _, value = entry.getPath().getName().partition("=")
                if name == col:
                    value = None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)
                    deeper[(*values, value)] = entry.getPath()
        found = deeper
    return found


def overwrite_partitions(
    spark: SparkSession, path: str, rows: DataFrame, touched: DataFrame, partition_by: Sequence[str]
) -> None:
    """Replace the touched partitions of ``path`` by ``rows``.

    Rows are written to a staging folder next to the table first: they may be
    computed from the table itself, and the copy survives a failed overwrite.
    It goes once the table is written. Touched partitions with no row left are
    removed, unknown (NULL) ones and those with escaped names too.
    """
    staging = f"{path.rstrip('/')}__staged-{uuid.uuid4().hex}"
    cols = list(partition_by)
    rows.write.partitionBy(*cols).parquet(staging)
    # partitions, not rows: bounded by the number touched; read before their files change
    gone = {tuple(None if v is None else str(v) for v in part) for part in touched.select(*cols).collect()}
    gone -= set(_partition_folders(spark, staging, cols))
    staged = spark.read.schema(rows.schema).parquet(staging).select(*rows.columns)
    (
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols).parquet(path)
    )
    fs, staged_folder = filesystem(spark, staging)
    for part, folder in _partition_folders(spark, path, cols).items():
        if part in gone:
            fs.delete(folder, True)
    fs.delete(staged_folder, True)


def write_preview(df: DataFrame, path: str) -> None:
    """CSV with a header of the rows that would be written."""
    df.write.option("header", True).mode("errorifexists").csv(path)
