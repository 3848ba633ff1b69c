"""Lake tables and their definitions, and statements over them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from landinglake.functions.quoting import table_identifier
from landinglake.storage import Storage, base_name, join_path


# Data folders of overwrites, below the table's own.
SNAPSHOT = "snapshot-"


def base_folder(location: str) -> str:
    """The table's own folder, whichever of its data folders is in use."""
    location = location.rstrip("/")
    return location.rsplit("/", 1)[0] if base_name(location).startswith(SNAPSHOT) else location


@dataclass(frozen=True)
class TableDefinition:
    """What the catalog knows of a table; partition columns are held apart."""

    name: str
    location: str
    provider: str
    schema: StructType
    partition_cols: list[str]

    @property
    def columns(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in self.schema
                if f.name not in self.partition_cols}

    @property
    def partitions(self) -> dict[str, str]:
        return {p: self.schema[p].dataType.simpleString() for p in self.partition_cols}


def find_table(spark: SparkSession, table: str) -> TableDefinition | None:
    """Definition of a table, or none if the catalog has no such table."""
    table = table_identifier(table)
    if not spark.catalog.tableExists(table):
        return None
    details = {row.col_name: row.data_type
               for row in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    partition_cols = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    # The types come from the schema, as listings cut the text of wide structs short.
    return TableDefinition(table, details["Location"], details["Provider"].lower(),
                           spark.table(table).schema, partition_cols)


def query_rows(spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None,
               **tables: DataFrame) -> DataFrame:
    """Run a statement with named parameters (``:name``) and named tables (``{name}``)."""
    return spark.sql(sql, args=dict(args or {}), **tables)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a record table, whichever append they came with."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop("append")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Malformed records kept by earlier runs: the record, verbatim, and the run id.

    The reader's own column for malformed records is moved out of the way, as the files
    hold a column of that name.
    """
    return (spark.read.option("columnNameOfCorruptRecord", "_unreadable")
            .option("recursiveFileLookup", "true")
            .schema("_corrupt_record string, process_execution_id bigint").json(path))


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a snapshot table, oldest first."""
    done = Storage(spark, path).glob(path, "version=*", "_SUCCESS")
    return sorted(int(base_name(marker.rsplit("/", 1)[0]).split("=")[1]) for marker in done)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Newest complete version of a table that is rewritten as a whole."""
    versions = snapshots(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete snapshot in {path}")
    return spark.read.parquet(join_path(path, f"version={versions[-1]}"))
