"""Catalog side of a lake table: definition, columns, partitions, schema rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from landinglake.errors import LocationMismatch
from landinglake.functions.quoting import literal, quoted
from landinglake.functions.times import TIME_PARTS
from landinglake.operators.partitions import partition_clause
from landinglake.sources.lake import TableDefinition, base_folder, find_table

# Column of the run id, and the columns left out of the schema rows.
RUN_ID = "process_execution_id"
TECHNICAL_COLUMNS = (*TIME_PARTS, RUN_ID)

# Partitions per ALTER TABLE statement.
PARTITION_BATCH = 500


def resolve_location(definition: TableDefinition | None, path: str | None) -> str:
    """The table's own folder: the given path, which an existing table must agree with. Its data
    may lie in a folder of an overwrite below."""
    if definition is None:
        if path is None:
            raise ValueError("a new table needs a path")
        return path
    base = base_folder(definition.location)
    if path is not None and _plain(path) != _plain(base):
        raise LocationMismatch(
            f"{definition.name} lies at {base}, not at {path}")
    return path or base


def _plain(path: str) -> str:
    """Path without the ways in which one local path can be spelled, or a trailing slash."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return path.rstrip("/")


def _ddl(fields: Iterable[StructField]) -> str:
    return StructType([StructField(f.name, f.dataType) for f in fields]).toDDL()


def create_table(spark: SparkSession, table: str, path: str, schema: StructType,
                 partition_cols: list[str], provider: str = "parquet") -> None:
    names = ", ".join(map(quoted, partition_cols))
    partitioned = f"PARTITIONED BY ({names})" if names else ""
    spark.sql(f"CREATE TABLE {table} ({_ddl(schema)}) USING {provider} {partitioned} "
              f"LOCATION {literal(path)}")


def extend_table(spark: SparkSession, definition: TableDefinition, schema: StructType) -> None:
    """Add the columns the table does not have yet."""
    known = {name.lower() for name in definition.schema.names}
    new = [field for field in schema if field.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {definition.name} ADD COLUMNS ({_ddl(new)})")


def add_partitions(spark: SparkSession, table: str,
                   values: Iterable[Mapping[str, object]]) -> int:
    """Register partitions, those already known are left as they are."""
    clauses = [partition_clause(v) for v in values]
    for start in range(0, len(clauses), PARTITION_BATCH):
        batch = " ".join(clauses[start:start + PARTITION_BATCH])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {batch}")
    if clauses:
        spark.catalog.refreshTable(table)
    return len(clauses)


def schema_rows(spark: SparkSession, table: str, entity: str, run_id: int) -> DataFrame:
    """Columns and types of a table as rows, without the technical columns."""
    definition = find_table(spark, table)
    if definition is None:
        raise ValueError(f"no table {table}")
    pairs = list({**definition.columns, **definition.partitions}.items())
    return schema_detail(spark, pairs, entity, run_id)


def schema_detail(spark: SparkSession, pairs: list[tuple[str, str]], entity: str,
                  run_id: int) -> DataFrame:
    """(name, type) pairs as rows of the entity's schema table."""
    return (spark.createDataFrame(pairs, "column_name string, data_type string")
            .filter(~F.col("column_name").isin(*TECHNICAL_COLUMNS))
            .withColumns({"entity": F.lit(entity), RUN_ID: F.lit(run_id).cast("int")}))
