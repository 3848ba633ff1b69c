"""Similarity classes of documents by a grouped prefix join on word shingles.

The set of a document is its distinct lower-cased shingles of ``size`` words. Two documents link
when 100 * intersection >= percent * union. The join:

1. Shingles that are frequent relative to the corpus (in about one document of
   ``FREQUENT_SHARE`` or more, see ``dealing``) are found by counting within batches and adding up. By the
   averages there are at most mean set size * FREQUENT_SHARE of them whatever the input, so
   the tasks get them as a table, and no such shingle is ever gathered in one place.
2. All other shingles are shuffled by hash as packed arrays, which gives the number of rows that
   hold them (equal sets of one step count once). Shingles of one document only say how many they are; the rest go back to their set.
3. Shingles are ordered by frequency. A set of n shingles can only link with one that shares one
   of its first n - ceil(percent * n / 100) + 1, so sets whose prefix holds only shingles of their
   own are done. The others with identical size and prefix collapse into one group.
4. Groups that share a prefix shingle meet in a cell, named by the least group of that shingle's
   list; pairs of groups are thus found once per list and not once per shingle, and lists that
   name the same cell become one.
5. Cells are expanded to members, which are verified exactly on all shingles that occur in more
   than one set. In a cell a member is compared with all others at once; after that, whoever is
   not yet in the cell's largest class is compared next, so that every pair of different classes
   has been verified, while pairs inside the largest class need not be. A cell with more than
   ``cell_tokens`` shingles is first compared with its centre by a join and those left are
   compared with the whole cell in blocks.
6. Links, at most one per merge, make the classes by connected components.

Sets and shingles are named by 64-bit hashes. Edge cases: a text with fewer words has its whole
sequence as one shingle; one without words, or null, links with nothing and is its own class;
repeated rows have equal sets and link; rows that share a doc_id count as one document; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landinglake.llm.components import connected_components
from landinglake.llm.dealing import (PACKED, PART_BYTES, frequent_values, joined, look_up, pack,
                                     part_of, run_starts, steps, unpack)
from landinglake.llm.tables import parts_for, stored, text_bytes, trimmed
from landinglake.llm.words import Words, mix, set_fingerprints, shingle_sets

SIZE = 5
PERCENT = 75
# Shingles compared in one step.
CELL_TOKENS = 1_000_000
# Sets written at once.
STEP_ROWS = 2_000
# Added to the frequency of frequent shingles, so that they come last.
_LAST = 1 << 40


def _sets(column: pa.Array, size: int):
    values, first = shingle_sets(Words(column, lower=True), size)
    return values, first, set_fingerprints(values, first).view(np.int64)


_SET_COLUMNS = "doc_id bigint, n bigint, set_id bigint, shingle bigint, n_docs bigint"


def describe_sets(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Stored rows of two kinds: (doc_id, n, set_id) per document, and (shingle, n_docs) for
    shingles that several sets of a batch share. Equal sets of a batch count once."""

    def describe(batches):
        for batch in steps(batches):
            values, first, ids = _sets(batch.column("text"), size)
            sizes = np.diff(first)
            yield _record([batch.column("doc_id"), sizes, ids, None, None])
            firsts = np.unique(ids, return_index=True)[1]
            once = np.zeros(len(ids), bool)
            once[firsts] = True
            shingles, counts = np.unique(values[np.repeat(once, sizes)], return_counts=True)
            yield _record([None, None, None, shingles[counts > 1].view(np.int64),
                           counts[counts > 1]])

    return stored(docs.select("doc_id", "text").mapInArrow(trimmed(describe), _SET_COLUMNS), "sets")


def _record(columns) -> pa.RecordBatch:
    rows = max(len(c) for c in columns if c is not None)
    arrays = [pa.nulls(rows, pa.int64()) if c is None else
              c.cast(pa.int64()) if isinstance(c, pa.Array) else pa.array(c, pa.int64())
              for c in columns]
    return pa.RecordBatch.from_arrays(
        arrays, names=[c.split()[0] for c in _SET_COLUMNS.split(", ")])


_SHARED = "set_id bigint, n bigint, prefix array<bigint>, shingles array<bigint>"
# Kinds of packed rows: shingles to be counted, shingles with their frequency on the way back to
# their row, and what is known of the rows themselves (set in ``values``, size in ``extras``).
_COUNT, _BACK, _ROWS = 0, 1, 2
# Rows are numbered within the steps of a task; a step's rows go back to one part.
_STEP_BITS = 20


def sets_with_shared_prefix(docs: DataFrame, parts: int, frequent, size: int = SIZE,
                            percent: int = PERCENT) -> DataFrame:
    """Sets whose prefix holds shingles of other sets: (set_id, n, prefix, shingles), where
    ``shingles`` are all of the set's that occur in more than one, and ``prefix`` those of its
    prefix, in order. A set may come more than once if equal sets lie in different steps."""
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def home(rows):
        return part_of(mix((rows >> _STEP_BITS).view(np.uint64)), parts)

    def deal(batches):
        often, counts = known.value
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(steps(batches)):
            values, first, ids = _sets(batch.column("text"), size)
            once = np.unique(ids, return_index=True)[1]
            once = once[ids[once] != 0]
            sizes = np.diff(first)
            base = (task << 42) + (number << _STEP_BITS)
            rows = base + np.arange(len(ids))
            yield from pack(home(rows[once]), rows[once], ids[once].view(np.uint64), sizes[once],
                            parts, _ROWS)
            keep = np.zeros(len(ids), bool)
            keep[once] = True
            keep = np.repeat(keep, sizes)
            owners, values = np.repeat(rows, sizes)[keep], values[keep]
            is_often, at = look_up(often, values)
            rare = ~is_often
            yield from pack(part_of(values[rare], parts), owners[rare], values[rare], None, parts,
                            _COUNT, by_owner=False)
            if is_often.any():
                yield from pack(home(owners[is_often]), owners[is_often], values[is_often],
                                _LAST + counts[at[is_often]], parts, _BACK, by_owner=False)

    def count(batches):
        arrays = ([], [])
        for batch in batches:
            # What only passes through has its part already.
            passing = batch.filter(pc.not_equal(batch.column("kind"), _COUNT))
            if passing.num_rows:
                yield passing
            for _, owners, values, _ in unpack(batch.filter(
                    pc.equal(batch.column("kind"), _COUNT))):
                arrays[0].append(owners)
                arrays[1].append(values)
        owners, values = joined(arrays, (np.int64, np.uint64))
        order = np.argsort(values, kind="stable")
        owners, values = owners[order], values[order]
        lengths = np.diff(np.r_[run_starts(values), len(values)])
        n_docs = np.repeat(lengths, lengths)
        shared = n_docs > 1
        yield from pack(home(owners[shared]), owners[shared], values[shared], n_docs[shared],
                        parts, _BACK)

    def prefixes(batches):
        arrays, rows, ids, sizes = ([], [], []), [], [], []
        for batch in batches:
            for kind, owners, values, extras in unpack(batch):
                if kind == _ROWS:
                    rows.append(owners)
                    ids.append(values.view(np.int64))
                    sizes.append(extras)
                else:
                    for whole, part in zip(arrays, (owners, values, extras)):
                        whole.append(part)
        rows, ids, sizes = joined((rows, ids, sizes), (np.int64, np.int64, np.int64))
        order = np.argsort(rows)
        rows, ids, sizes = rows[order], ids[order], sizes[order]
        owners, values, n_docs = joined(arrays, (np.int64, np.uint64, np.int64))
        order = np.lexsort((values, n_docs, owners))
        owners, values = owners[order], values[order]
        starts = run_starts(owners)
        shared = np.diff(np.r_[starts, len(owners)])
        place = np.searchsorted(rows, owners[starts])
        n = sizes[place]
        prefix = n - (percent * n + 99) // 100 + 1 - (n - shared)
        for at in range(0, len(starts), STEP_ROWS):
            own = np.flatnonzero(prefix[at:at + STEP_ROWS] > 0) + at
            heads = [values[s:s + p] for s, p in zip(starts[own], np.minimum(prefix, shared)[own])]
            wholes = [np.sort(values[s:s + k]) for s, k in zip(starts[own], shared[own])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[place[own]]), pa.array(n[own]), _lists(heads), _lists(wholes)],
                names=["set_id", "n", "prefix", "shingles"])

    counted = (docs.select("text").mapInArrow(trimmed(deal), PACKED).repartitionById(parts, "part")
               .mapInArrow(trimmed(count), PACKED))
    return counted.repartitionById(parts, "part").mapInArrow(trimmed(prefixes), _SHARED)


def _lists(arrays) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def candidate_cells(shared: DataFrame) -> DataFrame:
    """(cell, set_id): sets that must be compared are together in at least one cell."""
    member = shared.select("set_id", F.struct("n", "prefix").alias("key"))
    groups = member.groupBy("key").agg(F.min("set_id").alias("group"),
                                       F.count(F.lit(1)).alias("members"))
    lists = groups.select("group", "members", F.explode("key.prefix").alias("shingle"))
    cells = (lists.groupBy("shingle").agg(F.min("group").alias("cell"),
                                          F.sum("members").alias("members"))
             .filter("members > 1").drop("members"))
    met = lists.select("group", "shingle").join(cells, "shingle").select("cell", "group").distinct()
    of_group = member.join(groups.select("key", "group"), "key").select("group", "set_id")
    return met.join(of_group, "group").select("cell", "set_id")


def links_in_cell(sets: np.ndarray, n: np.ndarray, shingles: list[np.ndarray], percent: int,
                  others_from: int = 0) -> list[tuple[int, int]]:
    """Verified links, at most one per merge, that connect all linked members of a cell.

    With ``others_from``, only members before it are compared, each with all members.
    """
    total = len(sets)
    parent = list(range(total))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ends = np.cumsum([len(s) for s in shingles])
    starts = ends - [len(s) for s in shingles]
    flat = np.unique(np.concatenate(shingles), return_inverse=True)[1].astype(np.int32)
    present = np.zeros(int(flat.max()) + 1 if len(flat) else 0, np.uint8)
    sums = np.zeros(len(flat) + 1, np.int64)
    compared = np.zeros(total, bool)
    found = []
    last = others_from or total
    while True:
        roots = np.array([root(x) for x in range(total)])
        if others_from:
            wanted = np.flatnonzero(~compared[:last])
        else:
            largest = np.bincount(roots).argmax()
            wanted = np.flatnonzero(~compared & (roots != largest)) if compared.any() else [0]
        if not len(wanted):
            return found
        centre = int(wanted[0])
        compared[centre] = True
        own = flat[starts[centre]:ends[centre]]
        present[own] = 1
        np.cumsum(present[flat], out=sums[1:])
        present[own] = 0
        both = sums[ends] - sums[starts]
        linked = np.flatnonzero(100 * both >= percent * (n + n[centre] - both))
        for other in linked.tolist():
            a, b = root(centre), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((int(sets[centre]), int(sets[other])))


def _by_key(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of rows with equal first ``keys`` columns, from a stream sorted by them."""
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            key = tuple(column[begin] for column in columns)
            if held and key != current:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def _verify(frame: DataFrame, keys: list[str], percent: int, parts: int) -> DataFrame:
    """Links (a, b) among rows of equal ``keys``; column ``is_other`` marks rows that are only
    compared with rows that are not."""

    def verify(batches):
        for cell in _by_key(batches, len(keys)):
            if cell.num_rows < 2:
                continue
            shingles = cell.column("shingles").combine_chunks()
            flat, offsets = shingles.flatten().to_numpy(), shingles.offsets.to_numpy()
            offsets = offsets - offsets[0]
            other = cell.column("is_other").to_numpy()
            found = links_in_cell(
                cell.column("set_id").to_numpy(), cell.column("n").to_numpy(),
                [flat[b:e] for b, e in zip(offsets, offsets[1:])], percent,
                int((~other).sum()) if other.any() else 0)
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                                 names=["a", "b"])

    rows = frame.select(*keys, "is_other", "set_id", "n", "shingles")
    return (rows.repartition(parts, *keys).sortWithinPartitions(*keys, "is_other", "set_id")
            .mapInArrow(trimmed(verify), "a bigint, b bigint"))


def links(shared: DataFrame, cells: DataFrame, percent: int = PERCENT,
          cell_tokens: int = CELL_TOKENS, parts: int = 8) -> DataFrame:
    """Links (a, b) that connect all sets of ``shared`` which link in some cell."""
    weighed = (cells.join(shared.select("set_id", F.size("shingles").alias("weight")), "set_id")
               .groupBy("cell").agg(F.sum("weight").alias("weight")))
    blocks = F.ceil(F.col("weight") / cell_tokens).cast("bigint")
    sized = stored(cells.join(weighed.select("cell", blocks.alias("blocks")), "cell"), "cells")
    sets = shared.select("set_id", "n", "shingles")
    not_other = F.lit(False).alias("is_other")
    small = sized.filter("blocks <= 1").join(sets, "set_id").withColumn("is_other", not_other)
    found = _verify(small, ["cell"], percent, parts)
    if not sized.filter("blocks > 1").take(1):
        return found

    large = sized.filter("blocks > 1").join(sets, "set_id")
    centre = sets.select(F.col("set_id").alias("cell"), F.col("n").alias("centre_n"),
                         F.col("shingles").alias("centre_shingles"))
    both = F.size(F.array_intersect("shingles", "centre_shingles"))
    star = stored(large.join(centre, "cell").select(
        "cell", "blocks", "set_id", "n", "shingles",
        (100 * both >= percent * (F.col("n") + F.col("centre_n") - both)).alias("linked")), "star")
    block = F.pmod(F.xxhash64("set_id"), "blocks")
    # Who is not linked with the centre, in blocks, meets every block of the cell.
    left = star.filter("not linked").select(
        "cell", block.alias("left_block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        .alias("block"), "set_id", "n", "shingles", F.lit(False).alias("is_other"))
    whole = star.select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("left_block"),
        block.alias("block"), "set_id", "n", "shingles", F.lit(True).alias("is_other"))
    crossed = _verify(left.unionByName(whole), ["cell", "left_block", "block"], percent, parts)
    return (found.unionByName(crossed)
            .unionByName(star.filter("linked and cell != set_id")
                         .select(F.col("cell").alias("a"), F.col("set_id").alias("b"))))


def similarity_classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT,
                       cell_tokens: int = CELL_TOKENS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    parts = parts_for(text_bytes(docs), PART_BYTES)
    described = describe_sets(docs, size)
    rows = described.filter("n is not null").select("doc_id", "n", "set_id")
    frequent = frequent_values(
        described.filter("shingle is not null").select(F.col("shingle").alias("value"), "n_docs"),
        rows.count())
    shared = stored(sets_with_shared_prefix(docs, parts, frequent, size, percent)
                    .dropDuplicates(["set_id"]), "shared")
    edges = links(shared, candidate_cells(shared), percent, cell_tokens, parts)
    # Rows with one doc_id are one document: all their sets link with the least one. Rows without
    # a doc_id are documents of their own.
    firsts = rows.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first"))
    several = (rows.filter("n > 0 and doc_id is not null").groupBy("doc_id")
               .agg(F.min("set_id").alias("a"), F.max("set_id").alias("last"))
               .filter("a != last").select("doc_id", "a"))
    again = (rows.filter("n > 0").join(several, "doc_id").filter("set_id != a")
             .select("a", F.col("set_id").alias("b")).distinct())
    roots = connected_components(edges.unionByName(again))
    classes = (firsts.join(roots.select(F.col("a").alias("set_id"), F.col("b").alias("root")),
                           "set_id", "left")
               .select("set_id", "first", F.coalesce("root", "set_id").alias("root")))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "root").select("set_id", "component_id")
    return (rows.join(named, "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))
