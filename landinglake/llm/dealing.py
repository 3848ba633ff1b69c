"""Dealing hashed values of documents to tasks as packed arrays.

A value (the hash of a shingle or window) goes to the part that its high bits name. A task packs
what it has for a part into one row: owners in runs, run lengths, values. So the shuffle carries
little beside the hashes, and each part holds about ``PART_BYTES`` of the input's text, whatever
the input. Values of very many documents would make parts uneven and are found first: counted
within batches, only repeated ones passed on, and added up. What is in at least one of
``FREQUENT_SHARE / 2`` documents is always found, and at most mean values per document *
``FREQUENT_SHARE`` values are, so the result is a table of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landinglake.llm.words import utf8_buffer

FREQUENT_SHARE = 1024
# Below so many documents a value is not worth a special path.
FREQUENT_LEAST = 64
# Bytes of text whose values one task counts, and whose words are handled in one step.
PART_BYTES = 4_000_000
STEP_BYTES = 2_000_000

# One row per part of what a step deals. Owners stand in runs; owners, run lengths, values and
# extras are packed in the narrowest integers that hold them, owners as differences.
PACKED = ("part int, kind int, n_runs bigint, first_owner bigint, owners binary, runs binary, "
          "values binary, extras binary")


def steps(batches: Iterator[pa.RecordBatch], column: str = "text",
          size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of text (``STEP_BYTES`` if not told); a longer
    text is a step by itself."""
    size = size or STEP_BYTES
    for batch in batches:
        at = 0
        offsets = utf8_buffer(batch.column(column))[1]
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def frequent_values(counted: DataFrame, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of many documents, sorted, and their counts, from partial counts
    (value, n_docs)."""
    least = max(FREQUENT_LEAST, n_docs // FREQUENT_SHARE)
    found = (counted.groupBy("value").agg(F.sum("n_docs").alias("n_docs"))
             .filter(F.col("n_docs") >= least).toArrow())
    values = found.column("value").to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], found.column("n_docs").to_numpy()[order]


def look_up(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is in a sorted table, and where."""
    if not len(table):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values, at


def part_of(values: np.ndarray, parts: int) -> np.ndarray:
    return ((values.view(np.uint64) >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)


def _narrow(values: np.ndarray) -> bytes:
    top = int(np.abs(values).max()) if len(values) else 0
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(k).max)
    return values.astype(kind).tobytes()


def _wide(packed: bytes, count: int) -> np.ndarray:
    kind = np.dtype(f"i{len(packed) // count}") if count else np.int64
    return np.frombuffer(packed, kind).astype(np.int64)


def pack(part: np.ndarray, owners: np.ndarray, values: np.ndarray, extras: np.ndarray | None,
         parts: int, kind: int = 0, by_owner: bool = True) -> Iterator[pa.RecordBatch]:
    """``PACKED`` rows of owners (64-bit integers), values (64-bit hashes) and extras (integers).

    Without ``by_owner`` the values of an owner already stand together.
    """
    order = np.lexsort((owners, part)) if by_owner else np.argsort(part, kind="stable")
    part, owners, values = part[order], owners[order], values[order]
    extras = None if extras is None else extras[order]
    bounds = np.searchsorted(part, np.arange(parts + 1))
    rows = []
    for number in np.flatnonzero(np.diff(bounds)).tolist():
        own = slice(bounds[number], bounds[number + 1])
        new = np.r_[True, owners[own][1:] != owners[own][:-1]]
        starts = np.flatnonzero(new)
        each = owners[own][starts]
        # Differences that leave 64 bits wrap around, and wrap back when they are added up.
        rows.append((number, kind, len(starts), int(each[0]), _narrow(np.diff(each)),
                     _narrow(np.diff(np.r_[starts, len(new)])), values[own].tobytes(),
                     None if extras is None else _narrow(extras[own])))
    columns = list(zip(*rows)) or [[]] * 8
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                     names=[c.split()[0] for c in PACKED.split(", ")])


def unpack(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(kind, owners, values, extras) of every row of a batch."""
    for row in batch.to_pylist():
        runs = _wide(row["runs"], row["n_runs"])
        owners = np.cumsum(np.r_[row["first_owner"], _wide(row["owners"], row["n_runs"] - 1)])
        values = np.frombuffer(row["values"], np.uint64)
        yield (row["kind"], np.repeat(owners, runs), values,
               None if row["extras"] is None else _wide(row["extras"], len(values)))


def joined(arrays, kinds) -> list[np.ndarray]:
    return [np.concatenate(a) if a else np.zeros(0, k) for a, k in zip(arrays, kinds)]


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows that agree in all columns begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)
