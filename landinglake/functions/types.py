"""Catalog types and the alignment of a load with an existing table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landinglake.functions.quoting import quoted

# How a load's types enter the catalog.
WIDENED = {"int": "bigint"}
EXACT_DOUBLE = "decimal(38,6)"
EXACT_DOUBLE_LIMIT = 1e32

# Text that reads as a number; for integers the sign and the whole digits.
INTEGRAL = ("tinyint", "smallint", "int", "bigint")
NUMBER = r"^\s*([+-]?)(?=[.0-9])([0-9]*)(?:\.[0-9]*)?\s*$"
EXPONENT_NUMBER = r"^\s*[+-]?(?=\.?\p{Nd})\p{Nd}*\.?\p{Nd}*(?:[eE][+-]?\p{Nd}+)?\s*$"


def catalog_type(dtype: str) -> str:
    """Type text under which a top-level column is registered."""
    return WIDENED.get(dtype, dtype)


def catalog_types(df: DataFrame, partition_cols: list[str] | tuple[str, ...] = ()
                  ) -> tuple[dict[str, str], dict[str, str]]:
    """Data columns and partition columns of ``df``, each name with its catalog type."""
    types = {name: catalog_type(dtype) for name, dtype in df.dtypes}
    return ({n: t for n, t in types.items() if n not in partition_cols},
            {n: types[n] for n in partition_cols if n in types})


def aligned_type(dtype: str, table_type: str | None) -> str:
    """Type a column is brought to.

    A column of the table takes the table's type, except that a table's double asks for an
    exact decimal from any other type. A new double becomes that decimal, a new int is widened.
    """
    if table_type is None:
        return EXACT_DOUBLE if dtype == "double" else catalog_type(dtype)
    if dtype == table_type or table_type != "double":
        return table_type
    return EXACT_DOUBLE


def lenient_cast(name: str, dtype: str, target: str) -> str:
    """SQL text of a cast that gives null where a value does not fit.

    Text becomes an integer by its whole part, as a cast without ANSI does. What cannot be a
    number is sorted out by pattern: a failing cast costs an exception per value.
    """
    column, value = quoted(name), quoted(name)
    if dtype == "string" and target in INTEGRAL:
        sign, digits = (f"regexp_extract({column}, r'{NUMBER}', {i})" for i in (1, 2))
        pattern, value = NUMBER, f"concat({sign}, '0', {digits})"
    elif dtype == "string" and target.startswith("decimal"):
        pattern = EXPONENT_NUMBER
    else:
        return f"try_cast({column} as {target})"
    return f"case when {column} rlike r'{pattern}' then try_cast({value} as {target}) end"


def align_columns(df: DataFrame, table_types: Mapping[str, str] | None = None) -> DataFrame:
    """Columns the table knows first, new ones after them, all in the types above.

    Values that do not fit become null; :func:`lost_casts` counts them.
    """
    known = table_types or {}
    select = []
    for name, dtype in sorted(df.dtypes, key=lambda pair: pair[0] not in known):
        target = aligned_type(dtype, known.get(name))
        select.append(quoted(name) if target == dtype
                      else f"{lenient_cast(name, dtype, target)} as {quoted(name)}")
    return df.selectExpr(*select)


def lost_casts(df: DataFrame, table_types: Mapping[str, str] | None = None,
               names: Mapping[str, str] | None = None) -> Column:
    """How many values of a row the alignment turns into null.

    ``names`` gives the table's name of a column where it differs.
    """
    known = table_types or {}
    tests = []
    for name, dtype in df.dtypes:
        target = aligned_type(dtype, known.get((names or {}).get(name, name)))
        if target == dtype or (dtype, target) in WIDENED.items():
            continue
        if (dtype, target) == ("double", EXACT_DOUBLE):
            lost = f"isnan({quoted(name)}) or abs({quoted(name)}) >= {EXACT_DOUBLE_LIMIT}D"
        else:
            lost = f"{quoted(name)} is not null and {lenient_cast(name, dtype, target)} is null"
        tests.append(f"case when {lost} then 1 end")
    return F.expr(f"size(array_compact(array({', '.join(tests)})))" if tests else "0")
