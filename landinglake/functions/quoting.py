"""Names and texts inside SQL expressions.

Expressions over all columns of a table are written as SQL text: one call to the JVM for
the lot, where Column objects take several for every column of a wide table.
"""

from __future__ import annotations


def quoted(name: str) -> str:
    """A column name, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def table_identifier(name: str) -> str:
    """A table name, with or without its database, for SQL and the catalog alike."""
    return name if "`" in name else ".".join(map(quoted, name.split(".")))


def literal(text: str) -> str:
    """A text literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
