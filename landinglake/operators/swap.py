"""Moving a table to another data folder, so that a reader sees the old rows or the new ones.

A table's root, columns and partition locations are changed by one catalog call each:
``alterTable`` and ``alterPartitions``, which no SQL statement gives for many partitions at once.
Partitions that only the new data have are registered before, and those that only the old data had
dropped after, both empty at that time, so neither call changes what a reader gets. A reader that
has looked up the table before goes on with the old folder, which stays for a grace time.

A metastore that splits a batch of partitions into several calls, as some do above a hundred, is
atomic within these calls only.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from landinglake.functions.quoting import literal, table_identifier
from landinglake.operators.partitions import (NULL_PARTITION, partition_clause,
                                              partition_folder)
from landinglake.operators.tables import PARTITION_BATCH
from landinglake.sources.lake import SNAPSHOT, TableDefinition, base_folder, find_table
from landinglake.storage import Storage, base_name, join_path

RETIRED = "_retired"
# Seconds that an old data folder stays for readers that have looked up the table.
GRACE = 3600.0


def _changed(product, **values):
    """A copy of a case class with some fields changed."""
    names = [product.productElementName(i) for i in range(product.productArity())]
    return product.copy(*(values.get(n, product.productElement(i)) for i, n in enumerate(names)))


def _catalog(spark: SparkSession):
    return spark._jsparkSession.sessionState().catalog()


def _identifier(spark: SparkSession, table: str):
    return spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(
        table_identifier(table))


def _metadata(spark: SparkSession, table: str):
    return _catalog(spark).getTableMetadata(_identifier(spark, table))


def _location(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(Storage(spark, folder).qualified(folder))
    return spark._jvm.scala.Option.apply(path.toUri())


def partition_names(spark: SparkSession, table: str) -> set[str]:
    """Registered partitions as folder names below the table."""
    return {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def relative_folder(spark: SparkSession, values: Mapping[str, object]) -> str:
    return partition_folder(spark, "/", values).lstrip("/")


def set_schema(spark: SparkSession, table: str, schema: StructType) -> None:
    """Give a table these columns, also fewer than it has; one catalog call."""
    meta = _metadata(spark, table)
    columns = spark._jsparkSession.parseDataType(schema.json())
    _catalog(spark).externalCatalog().alterTable(_changed(meta, schema=columns))
    spark.catalog.refreshTable(table)


def drop_partitions(spark: SparkSession, table: str,
                    values: Iterable[Mapping[str, object]]) -> None:
    """Forget partitions; the files of a table with a location stay."""
    clauses = [partition_clause(v) for v in values]
    for start in range(0, len(clauses), PARTITION_BATCH):
        batch = ", ".join(clauses[start:start + PARTITION_BATCH])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {batch}")


def swap_table(spark: SparkSession, table: str, folder: str, schema: StructType,
               values: Iterable[Mapping[str, object]]) -> None:
    """Let a table have its data in ``folder``, these columns, and these partitions only."""
    definition = find_table(spark, table)
    external = _catalog(spark).externalCatalog()
    wanted = {relative_folder(spark, v): v for v in values}
    gone = []
    if definition.partition_cols:
        known = partition_names(spark, table)
        empty = join_path(base_folder(definition.location), "_nothing", "empty")
        Storage(spark, empty).make_folder(empty)
        fresh = [v for name, v in wanted.items() if name not in known]
        for start in range(0, len(fresh), PARTITION_BATCH):
            clauses = " ".join(f"{partition_clause(v)} LOCATION {literal(empty)}"
                               for v in fresh[start:start + PARTITION_BATCH])
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")
        meta = _metadata(spark, table)
        database, name = meta.identifier().database().get(), meta.identifier().table()
        moved = spark._jvm.java.util.ArrayList()
        convert = spark._jvm.scala.jdk.javaapi.CollectionConverters
        listed = convert.asJava(external.listPartitions(database, name,
                                                        spark._jvm.scala.Option.empty()))
        for partition in listed:
            spec = dict(convert.asJava(partition.spec()))
            place = relative_folder(spark, {c: spec[c] for c in definition.partition_cols})
            if place not in wanted:
                gone.append({c: _value(spec[c]) for c in definition.partition_cols})
            where = join_path(folder, place) if place in wanted else empty
            moved.add(_changed(partition, storage=_changed(
                partition.storage(), locationUri=_location(spark, where))))
        if moved.size():
            external.alterPartitions(database, name, convert.asScala(moved).toSeq())
    meta = _metadata(spark, table)
    external.alterTable(_changed(
        meta, storage=_changed(meta.storage(), locationUri=_location(spark, folder)),
        schema=spark._jsparkSession.parseDataType(schema.json())))
    spark.catalog.refreshTable(table)
    if gone:
        drop_partitions(spark, table, gone)
        spark.catalog.refreshTable(table)


def _value(text: str) -> str | None:
    return None if text == NULL_PARTITION else text


def table_state(definition: TableDefinition, values: list[dict]) -> dict:
    """What :func:`swap_table` needs to bring a table back, as plain values."""
    return {"folder": definition.location, "schema": json.loads(definition.schema.json()),
            "partitions": values}


def registered_values(spark: SparkSession, definition: TableDefinition) -> list[dict]:
    """The partitions of a table, as the texts the catalog holds."""
    if not definition.partition_cols:
        return []
    external = _catalog(spark).externalCatalog()
    meta = _metadata(spark, definition.name)
    convert = spark._jvm.scala.jdk.javaapi.CollectionConverters
    listed = convert.asJava(external.listPartitions(
        meta.identifier().database().get(), meta.identifier().table(),
        spark._jvm.scala.Option.empty()))
    specs = [dict(convert.asJava(p.spec())) for p in listed]
    return [{c: _value(spec[c]) for c in definition.partition_cols} for spec in specs]


def retire(spark: SparkSession, base: str, folder: str) -> None:
    """Note that a data folder is no longer in use; ``base`` itself stands for what lies in it
    beside the data folders of overwrites."""
    name = base_name(folder) if base_folder(folder) != folder.rstrip("/") else "root"
    Storage(spark, base).make_folder(join_path(base, RETIRED))
    Storage(spark, base).touch(join_path(base, RETIRED, f"{name}@{time.time():.3f}"))


def sweep(spark: SparkSession, base: str, grace: float = GRACE) -> int:
    """Delete data folders that have been retired for ``grace`` seconds."""
    storage, swept = Storage(spark, base), 0
    for marker in storage.glob(base, RETIRED, "*@*"):
        name, since = base_name(marker).rsplit("@", 1)
        if time.time() - float(since) < grace:
            continue
        if name == "root":
            storage.delete_all(path for path, _ in storage.children(base)
                               if not base_name(path).startswith(SNAPSHOT))
        else:
            storage.delete(join_path(base, name))
        storage.delete(marker)
        swept += 1
    return swept
