"""What a load has begun, finished, and done to the catalog.

A load leaves a marker in the table's folder when it starts and, if its caller has given it an id,
another when it ends. Before each step that changes the catalog it writes down how the table was. A load
that fails, or that is found dead by the next one, is taken back from these notes, last step first,
and then its files go.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from landinglake.operators.swap import drop_partitions, set_schema, swap_table
from landinglake.sources.lake import find_table
from landinglake.storage import Storage, base_name, join_path

LOADS = "_loads"


class LoadMarker:
    """Start, end and catalog notes of one load, kept in the table's own folder."""

    def __init__(self, spark: SparkSession, path: str, load_id: str):
        self._spark, self._storage = spark, Storage(spark, path)
        self.load_id = load_id
        self._folder = join_path(path, LOADS)
        self._name = join_path(self._folder, load_id)

    def finished(self) -> bool:
        return self._storage.exists(self._name + ".done")

    def started(self) -> bool:
        return self._storage.exists(self._name + ".started")

    def start(self) -> None:
        self._storage.make_folder(self._folder)
        self._storage.touch(self._name + ".started")

    def finish(self) -> None:
        """The load counts from here on; its notes are of no more use."""
        self._storage.touch(self._name + ".done")
        self._storage.delete(self._name + ".started")
        self._drop_notes()

    def forget(self) -> None:
        self._storage.delete(self._name + ".done")
        self._storage.delete(self._name + ".started")
        self._drop_notes()

    def note(self, kind: str, **values) -> None:
        """Write down how the table is, before the catalog is changed."""
        self._storage.make_folder(self._folder)
        number = len(self._storage.glob(self._folder, base_name(self._name) + ".note-*"))
        target = f"{self._name}.note-{number:03d}"
        if not self._storage.create_exclusive(target, json.dumps({"kind": kind, **values})):
            raise RuntimeError(f"{target} exists")

    def notes(self) -> list[dict]:
        names = sorted(self._storage.glob(self._folder, base_name(self._name) + ".note-*"))
        texts = [self._storage.read_text(name) for name in names]
        # A note cut short was never followed by its step.
        return [json.loads(text) for text in texts if text.endswith("}")]

    def undo(self, table: str) -> int:
        """Bring the catalog back to the notes, the last one first; returns their number."""
        notes = self.notes()
        for note in reversed(notes):
            definition = find_table(self._spark, table)
            if note["kind"] == "create":
                if definition is not None:
                    self._spark.sql(f"DROP TABLE IF EXISTS {definition.name}")
            elif definition is not None:
                schema = StructType.fromJson(note["schema"])
                if note["kind"] == "swap":
                    swap_table(self._spark, table, note["folder"], schema, note["partitions"])
                else:
                    if note["partitions"]:
                        drop_partitions(self._spark, table, note["partitions"])
                    if definition.schema != schema:
                        set_schema(self._spark, table, schema)
                    self._spark.catalog.refreshTable(table)
        self._drop_notes()
        return len(notes)

    def _drop_notes(self) -> None:
        self._storage.delete_all(
            self._storage.glob(self._folder, base_name(self._name) + ".note-*"))


def dead_loads(spark: SparkSession, path: str, but: str | None = None) -> list[str]:
    """Loads of a table that were started and have not ended. A table takes one load at a time, so
    when a load starts all others of them are dead."""
    found = Storage(spark, path).glob(path, LOADS, "*.started")
    names = {base_name(name).removesuffix(".started") for name in found}
    return sorted(names - {but})


def take_back_dead(spark: SparkSession, path: str, table: str, but: str | None,
                   remove_files: Callable[[str], object]) -> list[str]:
    """Take back every dead load of a table: catalog, then files by ``remove_files``, then marker."""
    names = dead_loads(spark, path, but)
    for name in names:
        marker = LoadMarker(spark, path, name)
        if not marker.finished():  # else it died between its two last steps
            marker.undo(table)
            remove_files(name)
        Storage(spark, path).delete(join_path(path, LOADS, name + ".started"))
        marker._drop_notes()
    return names
