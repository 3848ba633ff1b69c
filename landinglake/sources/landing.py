"""Landing folders: which entities and files are there, and their rows with lineage."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from landinglake.storage import Storage, join_path

# Options of the readers that choose among files. A stream cannot look at times, as it would never
# come back to a file it has left out.
FILE_FILTERS, TIME_FILTERS = ("pathglobfilter",), ("modifiedbefore", "modifiedafter")
# Fixed value: what a listing has; nothing opens a file unless it asks for its content.
LISTING = "path string, modificationTime timestamp, length bigint, content binary"
# A stream source forgets, and never loads, what is older than this before the newest file.
MOST_AGE = "36500d"

# The added columns, and the formats whose reader sets bad records apart.
CORRUPT_RECORD = "_corrupt_record"
SOURCE_FILE = "source_file_name"
RECORD_FORMATS = ("json", "csv", "xml")


@dataclass(frozen=True)
class Landing:
    """Rows of one landing folder and the very files they are read from."""

    rows: DataFrame
    files: tuple[str, ...]
    load_id: str | None = None
    listed: DataFrame | None = None

    @property
    def payload(self) -> list[str]:
        return [c for c in self.rows.columns if c not in (CORRUPT_RECORD, SOURCE_FILE)]


def chosen_files(options: Mapping[str, str] | None, stream: bool = False) -> dict[str, str]:
    """How files below a folder are chosen, for listings, batches and streams alike: all of them,
    in sub-folders of any depth, less hidden ones and what the reader's own filters leave out."""
    options = options or {}
    timed = [k for k in options if k.lower() in TIME_FILTERS]
    if stream and timed:
        raise ValueError(f"{timed[0]} cannot be used by an incremental load")
    wanted = {k: v for k, v in options.items() if k.lower() in (*FILE_FILTERS, *TIME_FILTERS)}
    return {"recursiveFileLookup": "true", **wanted}


def listed_files(spark: SparkSession, path: str,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """(path, length, modified) of every file below a folder that has content."""
    return (spark.read.format("binaryFile").schema(LISTING).options(**chosen_files(options))
            .load(path).select("path", "length", F.col("modificationTime").alias("modified")))


def arriving_files(spark: SparkSession, path: str, options: Mapping[str, str] | None = None,
                   files_per_batch: int | None = None, archive: str | None = None) -> DataFrame:
    """The same listing as a stream: each file once, when it has arrived. Which files have been
    seen is kept by the stream's checkpoint, and on the driver while it runs (a name per file)."""
    reader = (spark.readStream.format("binaryFile").schema(LISTING)
              .options(**chosen_files(options, stream=True)).option("maxFileAge", MOST_AGE))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path): files that a stream over :func:`arriving_files` has taken, from its checkpoint."""
    log = spark.read.text(join_path(checkpoint, "sources", "0")).filter(
        F.col("value").startswith("{"))
    path = F.from_json("value", "path string")["path"]
    # Names are kept as parts of an address, where a plus sign is itself; a listing spells local
    # ones with one slash.
    name = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return log.select(F.regexp_replace(name, "^file:/+", "file:/").alias("path"))


def landing_files(spark: SparkSession, prefix: str) -> DataFrame:
    """One row per file below ``prefix``: entity, path, length, modification time.

    Only the listing is used: the pruned scan never opens a file. The entity is the first
    folder after the prefix; files that lie directly in it belong to none.
    """
    root = re.escape(Storage(spark, prefix).qualified(prefix))
    entity = F.regexp_extract("path", f"^{root}/+([^/]+)/", 1)
    return (listed_files(spark, prefix)
            .select(entity.alias("entity"), "path", "length",
                    F.col("modified").alias("modificationTime"))
            .filter(F.col("entity") != ""))


def entity_files(spark: SparkSession, prefix: str, exclude: Iterable[str] = ()) -> DataFrame:
    """Entities that have files, with their number and size, less the excluded ones."""
    files = landing_files(spark, prefix)
    excluded = list(exclude)
    if excluded:
        files = files.filter(~F.col("entity").isin(excluded))
    return files.groupBy("entity").agg(F.count("path").alias("files"),
                                       F.sum("length").alias("bytes"))


def list_folder(spark: SparkSession, path: str, options: Mapping[str, str] | None = None,
                loaded: DataFrame | None = None) -> tuple[tuple[str, ...], str, DataFrame]:
    """Every file below a folder, in order, a load id that depends on which they are, and the
    listing. With ``loaded`` (path, length, modified) those files are left out.

    The names come to the driver in one transfer.
    """
    found = listed_files(spark, path, options)
    # The scan skips files without content, which still are files of the load.
    every = set(map(unquote, found.inputFiles()))
    fresh = found if loaded is None else found.join(
        loaded.select(*found.columns), found.columns, "left_anti")
    rows = sorted(fresh.collect())
    if loaded is not None:
        every -= {_spelt(r.path) for r in found.join(
            loaded.select(*found.columns), found.columns, "left_semi").collect()}
    files = tuple(sorted(every))
    text = "\n".join([*files, *(f"{r.path}|{r.length}|{r.modified}" for r in rows)])
    listed = spark.createDataFrame(rows, found.schema)
    return files, hashlib.sha256(text.encode()).hexdigest()[:32], listed


def _spelt(path: str) -> str:
    """A local path as ``inputFiles`` spells it."""
    return "file://" + path.removeprefix("file:") if re.match("file:/(?!/)", path) else path


def _folder_columns(path: str, files: Iterable[str]) -> set[tuple[str, ...]]:
    """The columns that folder names below ``path`` make, for each way they do so."""
    depth = len(path.rstrip("/").split("/")) if "://" in path else len(
        re.sub("^file:/*", "/", path).rstrip("/").split("/"))
    found = set()
    for name in files:
        parts = re.sub("^file:/+", "/", name).split("/")[depth:-1]
        found.add(tuple(part.split("=", 1)[0] for part in parts if "=" in part))
    return found


def infer_schema(spark: SparkSession, files: Iterable[str], file_format: str,
                 options: Mapping[str, str] | None = None) -> StructType:
    """Schema of the given files without the malformed-record column; it may be empty.

    Spark reads the whole files for this, as a sample could miss rare columns. Pass a
    schema to :func:`read_landing` to save the pass.
    """
    found = (spark.read.format(file_format).option("inferSchema", "true")
             .option("mode", "PERMISSIVE").options(**(options or {})).load(list(files)).schema)
    return StructType([field for field in found if field.name != CORRUPT_RECORD])


def read_landing(spark: SparkSession, path: str, file_format: str,
                 schema: StructType | None = None, options: Mapping[str, str] | None = None,
                 loaded: DataFrame | None = None, files: Iterable[str] | None = None) -> Landing:
    """Rows of a folder, malformed records kept verbatim in ``_corrupt_record``.

    The folder, sub-folders included, is listed once. Schema, rows, ``files`` and ``load_id``
    all come from that listing, so a file that arrives meanwhile is left for the next load; files
    that are among ``loaded`` are left out. With ``files`` just these files of the folder are read.
    The corrupt column is part of the given schema, so no second look at the data decides
    whether it exists, and CSV gets one too.
    """
    options = dict(options or {})
    load_id, listed = None, None
    if files is None:
        files, load_id, listed = list_folder(spark, path, options, loaded)
    files = tuple(files)
    if not files:
        raise FileNotFoundError(f"no files in {path}")
    if str(options.get("recursiveFileLookup", "false")).lower() != "true":
        # Folders named column=value are columns, as when the folder itself is read, if they are
        # so for all files; else there is no one set of columns.
        if len(_folder_columns(path, files)) == 1:
            options.setdefault("basePath", path)
        else:
            options["recursiveFileLookup"] = "true"
    names = [re.sub(r"([\[\]{}*?\\])", r"\\\1", name) for name in files]
    payload = schema or infer_schema(spark, names, file_format, options)
    if file_format not in RECORD_FORMATS:
        rows = spark.read.format(file_format).options(**options).schema(payload).load(names)
        rows = rows.withColumn(CORRUPT_RECORD, F.lit(None).cast("string"))
    elif not payload.fields:
        # Nothing but malformed records: there is no column to parse into.
        whole = str(options.get("multiLine", "false")).lower() == "true"
        lines = spark.read.options(**options).text(names, wholetext=whole)
        rows = lines.filter(F.trim("value") != "").withColumnRenamed("value", CORRUPT_RECORD)
    else:
        with_corrupt = StructType([*payload.fields, StructField(CORRUPT_RECORD, StringType())])
        rows = (spark.read.format(file_format).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
                .options(**options).schema(with_corrupt).load(names))
    return Landing(rows.withColumn(SOURCE_FILE, F.col("_metadata.file_path")), files,
                   load_id, listed)
