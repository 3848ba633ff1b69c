"""Compare a Spark query with its SQL on DuckDB: names, rows, Python values."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def by_name(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(
        tuple((type(row[i]).__name__, row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    ours = by_name(spark_df.columns, (tuple(r) for r in spark_df.collect()))
    cursor = connection.execute(sql)
    theirs = by_name([d[0] for d in cursor.description], cursor.fetchall())
    found = []
    if ours[0] != theirs[0]:
        found.append(f"columns {ours[0]} but SQL has {theirs[0]}")
    for label, extra in (("only here", ours[1] - theirs[1]), ("only in SQL", theirs[1] - ours[1])):
        if extra:
            found.append(f"{label}: {sum(extra.values())} rows, e.g. {list(extra)[:2]}")
    return found
