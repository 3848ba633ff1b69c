"""Which landing files a table has loaded: path, length and time of each, per load.

A load writes its files' entries before it publishes, and they count from the moment its end marker
is there; so they are committed with the load, and a load that dies leaves none. The next listing
is anti-joined with the entries, whichever load they come from: files of a finished load are never
read again, alone or beside new ones, and can be purged later or not at all. A file that comes again
under its name with other content or time is a new file.

Entries of many loads are compacted into one table that keeps only files that are still there.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.operators.sinks import write_snapshot
from landinglake.operators.journal import LOADS, LoadMarker
from landinglake.sources.lake import read_snapshot, snapshots
from landinglake.storage import Storage, base_name, join_path

FILE = ("path", "length", "modified")
ENTRY = ("path string, length bigint, modified timestamp, load_id string, records bigint, "
         "rejects bigint, accepted bigint, lost_values bigint")
# Loads whose entries are apart before they are compacted.
COMPACT_AT = 20


class FileLedger:
    """The loaded files of the table whose own folder is ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path, self._storage = spark, path, Storage(spark, path)
        self._folder = join_path(path, "_ledger")
        self._whole = join_path(self._folder, "whole")

    def _piece(self, load_id: str) -> str:
        return join_path(self._folder, f"load={load_id}")

    def committed(self) -> list[str]:
        """Finished loads whose entries are still apart."""
        staged = {base_name(p).split("=", 1)[1] for p in self._storage.glob(self._folder, "load=*")}
        done = {base_name(p).removesuffix(".done")
                for p in self._storage.glob(self._path, LOADS, "*.done")} if staged else set()
        return sorted(staged & done)

    def stage(self, load_id: str, files: DataFrame, records: int, rejects: int, accepted: int,
              lost_values: int) -> None:
        """Write the entries of a load that has not ended; ``files`` has ``FILE``."""
        counts = {"records": records, "rejects": rejects, "accepted": accepted,
                  "lost_values": lost_values}
        rows = files.select(*FILE, F.lit(load_id).alias("load_id"),
                            *(F.lit(n).cast("bigint").alias(c) for c, n in counts.items()))
        rows.write.mode("overwrite").parquet(self._piece(load_id))

    def loaded(self) -> DataFrame | None:
        """Entries of all files that finished loads have read."""
        pieces = [self._piece(load_id) for load_id in self.committed()]
        frames = [self._spark.read.schema(ENTRY).parquet(*pieces)] if pieces else []
        if snapshots(self._spark, self._whole):
            frames.append(read_snapshot(self._spark, self._whole))
        # A compaction that died between its two steps leaves entries in both places.
        return reduce(DataFrame.unionByName, frames).dropDuplicates(list(FILE)) if frames else None

    def drop(self, load_id: str) -> None:
        self._storage.delete(self._piece(load_id))

    def forget(self, load_ids: Iterable[str]) -> None:
        """The files of these loads are gone, so they cannot come again."""
        for load_id in load_ids:
            self.drop(load_id)
            LoadMarker(self._spark, self._path, load_id).forget()

    def compact(self, present: DataFrame, at: int = COMPACT_AT) -> bool:
        """Join the entries of ``at`` and more loads, keeping files that are in ``present``."""
        pieces = self.committed()
        if len(pieces) < at:
            return False
        kept = self.loaded().join(present.select(*FILE).distinct(), list(FILE), "left_semi")
        write_snapshot(kept.select(*(c.split()[0] for c in ENTRY.split(", "))).coalesce(1),
                       self._whole)
        self.forget(pieces)
        return True
