"""A journal for jobs that write several tables: what is to be written is recorded before the first write.

An entry holds the rows of all writes, each computed once, and becomes open by
one rename. Writes are merges that can be repeated, so after a stop at any place
the next run repeats the open entries and closes them. A stop before the rename
leaves no entry and no table changed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from listingflow.operators.snapshots import filesystem


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = filesystem(spark, path)
    stream = fs.open(jpath)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = filesystem(spark, path)
    out = fs.create(jpath, True)
    out.write(bytearray(text.encode()))
    out.close()


@dataclass(frozen=True)
class Entry:
    """Recorded frames by label, with what the job noted about each."""

    name: str
    id: str
    folder: str
    notes: Mapping[str, Mapping[str, object]]
    spark: SparkSession

    def labels(self) -> list[str]:
        return sorted(self.notes)

    def frame(self, label: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(str(self.notes[label]["schema"])))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{label}")


@dataclass(frozen=True)
class Journal:
    """Entries below a folder that all executors reach."""

    spark: SparkSession
    root: str

    def record(self, name: str, frames: Mapping[str, tuple[DataFrame, Mapping[str, object]]]) -> Entry:
        """Write the frames and open an entry for them; labels sort in the order in which they are to be applied."""
        number = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        folder, notes = f"{self.root}/{number}", {}
        for label, (df, note) in frames.items():
            df.write.parquet(f"{folder}/{label}")
            notes[label] = {**note, "schema": df.schema.json()}
        write_text(self.spark, f"{folder}/.intent", json.dumps({"name": name, "notes": notes}))
        fs, draft = filesystem(self.spark, f"{folder}/.intent")
        if not fs.rename(draft, filesystem(self.spark, f"{folder}/intent")[1]):
            raise OSError(f"cannot open the entry {folder}")
        return Entry(name, number, folder, notes, self.spark)

    def open(self, name: str | None = None) -> list[Entry]:
        """Entries that were not closed, the oldest first."""
        fs, top = filesystem(self.spark, self.root)
        found = []
        for entry in fs.listStatus(top) if fs.exists(top) else []:
            folder, number = f"{self.root}/{entry.getPath().getName()}", entry.getPath().getName()
            if fs.exists(filesystem(self.spark, f"{folder}/intent")[1]):
                raw = json.loads(read_text(self.spark, f"{folder}/intent"))
                if name is None or raw["name"] == name:
                    found.append(Entry(raw["name"], number, folder, raw["notes"], self.spark))
        return sorted(found, key=lambda e: e.id)

    def close(self, entry: Entry) -> None:
        """The entry is done: it is no longer open, then its rows go."""
        fs, intent = filesystem(self.spark, f"{entry.folder}/intent")
        fs.delete(intent, False)
        fs.delete(intent.getParent(), True)
