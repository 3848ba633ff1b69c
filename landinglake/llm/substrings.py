"""Removal of long passages that an earlier document already has.

A window is ``size`` consecutive words. Every window of every document is hashed (Rabin-Karp,
modulo 2**64) and counted: a window is repeated for a document if it also starts in one with a
smaller doc_id. Repeated windows that overlap or touch merge into maximal intervals, and the words
of these intervals are removed. Windows are judged on the input alone.

Windows are shuffled by hash as packed arrays; what comes back to a document are the hashes of its
repeated windows, and a last pass over its text turns them into intervals. Windows of very many
documents (see ``dealing``) are never gathered: each task passes on the least document of each, a
table of bounded size holds the minimum, and the last pass compares with that.

Edge cases: a null or empty text, or one shorter than a window, loses nothing; rows that share a
doc_id count as one document and do not repeat each other; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landinglake.llm.dealing import (PACKED, PART_BYTES, frequent_values, joined, look_up, pack,
                                     part_of, run_starts, steps, unpack)
from landinglake.llm.tables import parts_for, stored, text_bytes
from landinglake.llm.words import Words, mix

SIZE = 50
# Documents written at once.
STEP_ROWS = 10_000


def _windows(batch: pa.RecordBatch, size: int):
    """Words of a batch, and hash, first word and row of each of its windows."""
    words = Words(batch.column("text"), lower=False)
    hashes, at = words.windows(size)
    return words, hashes, at, np.searchsorted(words.first, at, side="right") - 1


def common_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(value, n_docs): windows that several documents of a batch share, with their number."""

    def count(batches):
        for batch in steps(batches):
            _, hashes, _, rows = _windows(batch, size)
            order = np.lexsort((rows, hashes))
            hashes, rows = hashes[order], rows[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
            values, counts = np.unique(hashes[new], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[counts > 1].view(np.int64)), pa.array(counts[counts > 1])],
                names=["value", "n_docs"])

    return docs.select("text").mapInArrow(count, "value bigint, n_docs bigint")


# Kinds of packed rows: windows to be counted or repeated, and least documents of frequent ones.
_COUNT, _LEAST = 0, 1
_REPEATED = "doc_id bigint, windows binary, window bigint, least bigint"


def repeated_windows(docs: DataFrame, parts: int, often: np.ndarray, size: int = SIZE) -> DataFrame:
    """Rows of two kinds: (doc_id, windows), the packed hashes of windows that a smaller doc_id
    has too, and (window, least), the least doc_id of each window in ``often``, by task."""
    known = docs.sparkSession.sparkContext.broadcast(often)

    def deal(batches):
        often = known.value
        least = np.full(len(often), np.iinfo(np.int64).max)
        for batch in steps(batches):
            _, hashes, _, rows = _windows(batch, size)
            owners = batch.column("doc_id").to_numpy(zero_copy_only=False)[rows].astype(np.int64)
            is_often, at = look_up(often, hashes)
            np.minimum.at(least, at[is_often], owners[is_often])
            rare = ~is_often
            yield from pack(part_of(hashes[rare], parts), owners[rare], hashes[rare], None, parts,
                            _COUNT, by_owner=False)
        seen = least < np.iinfo(np.int64).max
        if seen.any():
            yield from pack(part_of(often[seen], parts), least[seen], often[seen], None, parts,
                            _LEAST)

    def count(batches):
        arrays = ([], [])
        for batch in batches:
            passing = batch.filter(pc.equal(batch.column("kind"), _LEAST))
            if passing.num_rows:
                yield passing
            for _, owners, hashes, _ in unpack(batch.filter(
                    pc.equal(batch.column("kind"), _COUNT))):
                arrays[0].append(owners)
                arrays[1].append(hashes)
        owners, hashes = joined(arrays, (np.int64, np.uint64))
        order = np.lexsort((owners, hashes))
        owners, hashes = owners[order], hashes[order]
        once = run_starts(hashes, owners)
        owners, hashes = owners[once], hashes[once]
        starts = run_starts(hashes)
        least = np.repeat(owners[starts], np.diff(np.r_[starts, len(hashes)]))
        again = owners > least
        yield from pack(part_of(mix(owners[again].view(np.uint64)), parts), owners[again],
                        hashes[again], None, parts, _COUNT)

    def gather(batches):
        arrays = ([], [])
        for batch in batches:
            for kind, owners, hashes, _ in unpack(batch):
                if kind == _LEAST:
                    yield _record(None, None, hashes.view(np.int64), owners)
                else:
                    arrays[0].append(owners)
                    arrays[1].append(hashes)
        owners, hashes = joined(arrays, (np.int64, np.uint64))
        order = np.argsort(owners, kind="stable")
        owners, hashes = owners[order], hashes[order]
        starts = run_starts(owners)
        ends = np.r_[starts[1:], len(owners)]
        for at in range(0, len(starts), STEP_ROWS):
            own = slice(at, at + STEP_ROWS)
            yield _record(owners[starts[own]], [hashes[b:e].tobytes() for b, e in
                                                zip(starts[own], ends[own])], None, None)

    dealt = docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(deal, PACKED)
    counted = dealt.repartitionById(parts, "part").mapInArrow(count, PACKED)
    return counted.repartitionById(parts, "part").mapInArrow(gather, _REPEATED)


def _record(owners, windows, window, least) -> pa.RecordBatch:
    rows = len(owners if owners is not None else window)
    types = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.nulls(rows, t) if c is None else pa.array(c, t)
         for c, t in zip((owners, windows, window, least), types)],
        names=["doc_id", "windows", "window", "least"])


def intervals_of(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by windows that begin at ``starts`` (sorted)."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(starts[1:] > starts[:-1] + size)
    return starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]] + size


_RESULT = ("doc_id bigint, n_words bigint, removed array<struct<start:bigint,end:bigint>>, "
           "kept_text string")


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, removed, kept_text) for every row of ``docs`` (doc_id, text): intervals
    of word numbers, and the other words joined by single spaces."""
    parts = parts_for(text_bytes(docs), PART_BYTES)
    often = frequent_values(common_windows(docs, size), docs.count())[0]
    repeated = stored(repeated_windows(docs, parts, often, size), "repeated")
    least = (repeated.filter("window is not null").groupBy("window")
             .agg(F.min("least").alias("least")).toArrow())
    windows = least.column("window").to_numpy().view(np.uint64)
    order = np.argsort(windows)
    known = docs.sparkSession.sparkContext.broadcast(
        (windows[order], least.column("least").to_numpy()[order]))
    of_doc = repeated.filter("doc_id is not null").select("doc_id", "windows")

    def remove(batches):
        often, least = known.value
        for batch in steps(batches):
            words, hashes, at, rows = _windows(batch, size)
            owners = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()
            is_often, place = look_up(often, hashes)
            again = is_often.copy()
            again[is_often] = least[place[is_often]] < owners[rows[is_often]]
            bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            counts = words.counts().tolist()
            removed, kept = [], []
            texts, lists = batch.column("text").to_pylist(), batch.column("windows")
            for row in range(batch.num_rows):
                own = slice(bounds[row], bounds[row + 1])
                if lists[row].is_valid:
                    mine = np.frombuffer(lists[row].as_py(), np.uint64)
                    again[own] |= np.isin(hashes[own], mine)
                starts, ends = intervals_of(at[own][again[own]] - words.first[row], size)
                removed.append([{"start": s, "end": e}
                                for s, e in zip(starts.tolist(), ends.tolist())])
                parts_of = (texts[row] or "").encode().split()
                if len(starts):
                    keep = np.ones(counts[row], bool)
                    for s, e in zip(starts.tolist(), ends.tolist()):
                        keep[s:e] = False
                    parts_of = compress(parts_of, keep.tolist())
                kept.append(b" ".join(parts_of).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()),
                                                       ("end", pa.int64())]))),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "removed", "kept_text"])

    return (docs.select("doc_id", "text").join(of_doc, "doc_id", "left")
            .select("doc_id", "text", "windows").mapInArrow(remove, _RESULT))
