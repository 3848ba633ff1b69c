"""Which partitions a data set touches, and where they lie."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landinglake.functions.quoting import literal, quoted
from landinglake.storage import join_path

# Fixed value: folder name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_values(df: DataFrame, partition_cols: Iterable[str]) -> DataFrame:
    """Distinct partition tuples; reads only these columns, combines before the shuffle."""
    return df.select(*partition_cols).distinct()


def _folder_value(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL_PARTITION))


def partition_map(df: DataFrame, partition_cols: list[str], path: str) -> DataFrame:
    """One row per partition: its folder below ``path`` and its values as text."""
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), _folder_value(c)) for c in partition_cols])
    prefix = F.concat(F.lit(join_path(path, "")), folder, F.lit("/"))
    values = F.array(*[_folder_value(c) for c in partition_cols])
    return partition_values(df, partition_cols).select(prefix.alias("prefix"), values.alias("values"))


def touched_metric(partition_cols: Iterable[str]) -> Column:
    """The distinct partition tuples, as text, as a metric of the write itself.

    Spark makes the text, as it does for the folders, so both agree whatever time zone the
    driver is in. It is as small as the list of partitions the catalog has to hold, and saves
    a second scan of the data.
    """
    texts = [F.col(quoted(c)).cast("string").alias(c) for c in partition_cols]
    return F.collect_set(F.struct(*texts)).alias("partitions")


def read_touched(rows: Iterable[Mapping[str, str | None]], numbers: Iterable[str] = ()
                 ) -> list[dict[str, str | int | None]]:
    """The tuples of the metric as stored: Spark keeps an empty text in the null partition.

    Columns among ``numbers`` come back as integers.
    """
    whole = set(numbers)
    stored = [{k: None if v in (None, "") else int(v) if k in whole else v for k, v in row.items()}
              for row in rows]
    return list({tuple(row.values()): row for row in stored}.values())


def partition_clause(values: Mapping[str, object]) -> str:
    """``PARTITION (...)`` of one tuple; the catalog reads the texts as the columns' types."""
    def text(value: object) -> str:
        if value is None:
            return "null"
        return literal(str(value).lower() if isinstance(value, bool) else str(value))
    return "PARTITION (" + ", ".join(f"{quoted(k)}={text(v)}" for k, v in values.items()) + ")"


def partition_folder(spark: SparkSession, path: str, values: Mapping[str, object]) -> str:
    """The folder in which Spark keeps a partition."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return join_path(path, *(names.getPartitionPathString(k, None if v is None else str(v)) for k, v in values.items()))
