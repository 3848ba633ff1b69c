"""Column and schema rules: names, times, types."""

from landinglake.functions.names import clean_columns, clean_name, clean_text
from landinglake.functions.times import add_time_parts, parse_time, utc_text
from landinglake.functions.types import align_columns, catalog_type, catalog_types, lost_casts

__all__ = ["add_time_parts", "align_columns", "catalog_type", "catalog_types", "clean_columns",
           "clean_name", "clean_text", "lost_casts", "parse_time", "utc_text"]
