"""Clean names: no accents, only ASCII word characters, snake case, lower case.

The rule exists twice, once for column names on the driver and once as a Column
expression for values. Both share the table of accented characters below.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landinglake.errors import NameCollision

# What separates words (\W in its ASCII sense, which is the JVM's own and many
# times faster there than the class spelt out), and where camel case is split.
SEPARATORS = r"\W+"
CAMEL_HUMP = "([a-z0-9])([A-Z])"

# No character from here on has a canonical base in ASCII (checked by a test).
_FOLD_END = 0x3000


@lru_cache(maxsize=None)
def accent_table() -> dict[str, str]:
    """Every precomposed character whose base is one ASCII word character, with that base."""
    table = {}
    for code in range(0x80, _FOLD_END):
        base = [c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0].isascii() and (base[0].isalnum() or base[0] == "_"):
            table[chr(code)] = base[0]
    return table


@lru_cache(maxsize=None)
def accent_marks() -> str:
    """Every character that is only a mark on another one."""
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Mn")


@lru_cache(maxsize=None)
def _folding() -> dict[int, str | None]:
    return {ord(source): base for source, base in accent_table().items()} | dict.fromkeys(
        map(ord, accent_marks()))


def clean_name(name: str) -> str:
    """Clean one name on the driver, e.g. a column or an entity."""
    folded = name.translate(_folding())
    words = re.sub(CAMEL_HUMP, r"\1_\2", re.sub(SEPARATORS, "_", folded, flags=re.ASCII))
    return words.lower()


def clean_text(text: Column | str) -> Column:
    """The same rule on the values of a string column, inside the JVM.

    ``translate`` looks each character up in a table, which folds accents and, for want of
    a counterpart, deletes the marks; the JVM's own Unicode version does not matter.
    """
    column = F.col(text) if isinstance(text, str) else text
    sources, bases = map("".join, zip(*accent_table().items()))
    column = F.translate(column, sources + accent_marks(), bases)
    for pattern, replacement in ((SEPARATORS, "_"), (CAMEL_HUMP, "$1_$2")):
        column = F.regexp_replace(column, pattern, replacement)
    return F.lower(column)


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every top-level column; two columns with one clean name are an error."""
    sources: dict[str, str] = {}
    for column in df.columns:
        clean = clean_name(column)
        if clean in sources:
            raise NameCollision(
                f"columns {sources[clean]!r} and {column!r} both become {clean!r}")
        sources[clean] = column
    return df.toDF(*sources)
