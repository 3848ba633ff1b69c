"""Benchmark items that occur in documents, up to a number of word edits.

An item of n words may differ from a stretch of the document by k = n * error_percent // 100
inserted, deleted or replaced words (case aside). Split into k + 1 pieces, one piece then occurs
unchanged (pigeonhole). So the hashes of all windows of the pieces' lengths are looked up, and
around each hit the edit distance of item and text is computed with Myers' bit-parallel algorithm
over words, one bit per word of the item. The best stretch per document and item is reported.

Different items, split by hash into blocks whose bytes are counted before any is read, go to the
tasks as a table. The documents are searched for one block at a time: its matches are stored, then
its table is given up and the next block comes to the driver, which so never holds more than
``block_bytes`` of text, or twice that of an item longer than half of it.

Edge cases: null or empty texts and items without words match nothing; an item too short for an
error must occur as it is; repeated rows or item ids give one row per (doc_id, item_id), with the
best match; ties go to the first, then shortest stretch; rows without a doc_id count as one
document and items without an item_id as one item, named null; very long texts are searched whole,
a step of rows at a time; an empty table on either side gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landinglake.llm.dealing import steps
from landinglake.llm.tables import parts_for, stored, trimmed
from landinglake.llm.words import Words, window_hashes

ERROR_PERCENT = 15
BLOCK_BYTES = 16_000_000
_FILTER_BITS = 20

MATCHES = "doc_id bigint, item_id bigint, distance bigint, first_word bigint, end_word bigint"


def budget(n_words: int, error_percent: int = ERROR_PERCENT) -> int:
    return n_words * error_percent // 100


class Pieces:
    """Item words, and their pieces by length in sorted tables."""

    def __init__(self, items: list[tuple[int | None, str]], error_percent: int):
        words = Words(pa.array([text for _, text in items], pa.string()), lower=True)
        self.ids, self.words, self.budgets = [], [], []
        tables: dict[int, list[tuple[int, int, int]]] = {}
        for (item_id, _), begin, end in zip(items, words.first[:-1], words.first[1:]):
            own = words.hashes[begin:end]
            if not len(own):
                continue
            errors = budget(len(own), error_percent)
            cuts = [len(own) * i // (errors + 1) for i in range(errors + 2)]
            for first, last in zip(cuts, cuts[1:]):
                value = int(window_hashes(own[first:last], last - first)[0])
                tables.setdefault(last - first, []).append((value, len(self.ids), first))
            self.ids.append(item_id)
            self.words.append(own)
            self.budgets.append(errors)
        self.tables = {}
        for length, rows in tables.items():
            rows.sort()
            values = np.array([r[0] for r in rows], np.uint64)
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[values >> np.uint64(64 - _FILTER_BITS)] = True
            self.tables[length] = (values, seen, np.array([r[1:] for r in rows], np.int64))

    def hits(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """(row, item, word at which the item would begin) of every piece found."""
        for length, (values, seen, places) in self.tables.items():
            hashes, at = words.windows(length)
            maybe = np.flatnonzero(seen[hashes >> np.uint64(64 - _FILTER_BITS)])
            hashes, at = hashes[maybe], at[maybe]
            first = np.searchsorted(values, hashes, "left")
            count = np.searchsorted(values, hashes, "right") - first
            rows = np.searchsorted(words.first, at, side="right") - 1
            for i in np.flatnonzero(count).tolist():
                for item, offset in places[first[i]:first[i] + count[i]].tolist():
                    yield int(rows[i]), item, int(at[i]) - offset


def myers(pattern: list[int], text: list[int], anchored: bool = False) -> list[int]:
    """Edit distances of the pattern to the text up to each place, from any place before it or,
    if ``anchored``, from the text's beginning."""
    size = len(pattern)
    ones, top = (1 << size) - 1, 1 << (size - 1)
    equal: dict[int, int] = {}
    for i, word in enumerate(pattern):
        equal[word] = equal.get(word, 0) | 1 << i
    plus, minus, score, found = ones, 0, size, []
    for word in text:
        same = equal.get(word, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up = minus | ~(horizontal | plus) & ones
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 | anchored
        down <<= 1
        plus = (down | ~(vertical | up)) & ones
        minus = up & vertical & ones
        found.append(score)
    return found


def best_stretch(item: list[int], text: list[int], errors: int) -> tuple[int, int, int] | None:
    """(distance, begin, end) of the closest stretch within ``errors``: the first of the closest
    ends, and the shortest stretch that ends there."""
    scores = myers(item, text)
    distance = min(scores, default=errors + 1)
    if distance > errors:
        return None
    end = scores.index(distance) + 1
    back = myers(item[::-1], text[:end][::-1], anchored=True)
    length = back.index(distance) + 1 if distance in back else 0
    return distance, end - length, end


def _matches(words: Words, pieces: Pieces) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, first word, end) for every row and item that match."""
    regions: dict[tuple[int, int], list[int]] = {}
    for row, item, begin in pieces.hits(words):
        regions.setdefault((row, item), []).append(begin)
    for (row, item), begins in regions.items():
        low, high = int(words.first[row]), int(words.first[row + 1])
        errors, pattern = pieces.budgets[item], pieces.words[item].tolist()
        best, last = None, None
        spans: list[list[int]] = []
        for begin in sorted(set(begins)):
            span = [max(low, begin - errors), min(high, begin + len(pattern) + errors)]
            if spans and span[0] <= spans[-1][1]:
                spans[-1][1] = max(span[1], spans[-1][1])
            else:
                spans.append(span)
        for first, last in spans:
            found = best_stretch(pattern, words.hashes[first:last].tolist(), errors)
            if found:
                distance, begin, end = found
                best = min(best or (distance, 1 << 62, 0),
                           (distance, first + begin - low, first + end - low))
        if best:
            yield row, item, *best


def _search(docs: DataFrame, items: list[tuple[int | None, str]], error_percent: int) -> DataFrame:
    """``MATCHES`` of some items, stored, perhaps several of a document and item."""
    known = docs.sparkSession.sparkContext.broadcast(items)

    def search(batches):
        pieces = Pieces(known.value, error_percent)
        for batch in steps(batches):
            words = Words(batch.column("text"), lower=True)
            rows = [(batch.column("doc_id")[row].as_py(), pieces.ids[item], *found)
                    for row, item, *found in _matches(words, pieces)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in list(zip(*rows)) or [[]] * 5],
                names=[c.split()[0] for c in MATCHES.split(", ")])

    found = stored(docs.select("doc_id", "text").mapInArrow(trimmed(search), MATCHES), "matches")
    known.destroy()
    return found


def item_blocks(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, list[int]]:
    """(item_id, text, block) of the different items, and the blocks that have any. A block holds
    at most ``block_bytes`` of text, unless a single item is more than half of it."""
    items = stored(benchmark.select("item_id", "text").filter("text is not null").distinct(),
                   "items")
    size = F.octet_length("text").cast("bigint")
    total = items.agg(F.sum(size)).first()[0] or 0
    blocks = parts_for(total, max(1, block_bytes // 2))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
        sizes = dealt.groupBy("block").agg(F.sum(size).alias("bytes"), F.max(size).alias("longest"))
        # Half a block that is one item will not get smaller by more blocks.
        if sizes.filter((F.col("bytes") > block_bytes)
                        & (2 * F.col("longest") <= F.col("bytes"))).isEmpty():
            return dealt, sorted(r.block for r in sizes.select("block").collect())
        blocks *= 2


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, error_percent: int = ERROR_PERCENT,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``MATCHES``: the best match of each ``benchmark`` item (item_id, text) in each of ``docs``
    (doc_id, text), if there is one."""
    items, blocks = item_blocks(benchmark, block_bytes)
    found = []
    for block in blocks:
        rows = items.filter(F.col("block") == block).select("item_id", "text").collect()
        found.append(_search(docs, [tuple(r) for r in rows], error_percent))
    best = F.min(F.struct("distance", "first_word", "end_word")).alias("best")
    found = found or [docs.sparkSession.createDataFrame([], MATCHES)]
    return (reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "best.*"))
