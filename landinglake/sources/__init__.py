"""Where rows come from: landing folders, databases, lake tables."""

from landinglake.sources.databases import read_query, read_table
from landinglake.sources.lake import (TableDefinition, find_table, query_rows, read_appended,
                                      read_rejects, read_snapshot)
from landinglake.sources.landing import (CORRUPT_RECORD, SOURCE_FILE, Landing, entity_files,
                                         infer_schema, landing_files, read_landing)

__all__ = ["CORRUPT_RECORD", "SOURCE_FILE", "Landing", "TableDefinition", "entity_files",
           "find_table", "infer_schema", "landing_files", "query_rows", "read_appended",
           "read_landing", "read_query", "read_rejects", "read_snapshot", "read_table"]
