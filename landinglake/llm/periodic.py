"""Runs in word sequences: maximal stretches that repeat one period at least twice.

All texts of a step are searched together. Words become numbers that differ between texts, and a
suffix array is made by prefix doubling, in which only what still has an equal goes on; so most
words drop out after four. Every round leaves the ranks of all stretches of 2**k words, which tell
in O(log n) how far two places agree.

A run with smallest period q and at least ``max(LEAST, 2 * q)`` words holds, before its last q
words, a dyadic block: 2**k words from a multiple of half that length, for the k whose range of
periods q is in. The block's copy q words later is in the run too. So for each block the places of
its equals, an interval of the suffix array, are asked for those in the neighbouring window of that
range (range successor on a wavelet matrix over the suffix array). Neighbouring equals that
overlap by half or more are an arithmetic progression, which is followed without further questions.
The distances from the block are the candidate periods; a progression in the same repetition as
the block itself holds multiples of a smaller period and is left out. How far both places agree to
the left and right gives the run of a candidate, or that there is none.

Each text is one row's work, so nothing is shuffled. Edge cases: null, empty and blank texts have no
runs; a very long text is a step by itself and needs memory in proportion to its words (four bytes
per word and doubling round beside some ten arrays); repeated rows give repeated results; an empty
table gives an empty result; other columns are ignored, and those named in ``carry`` kept. Words are
compared by 64-bit hashes, stretches of words by exact ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from landinglake.llm.dealing import steps
from landinglake.llm.words import Words, mix

# Words a run has at least, and the length of the shortest blocks.
LEAST = 12
LEAST_BLOCK = 4
# Text searched in one step, and candidates compared at a time.
STEP_BYTES = 3_000_000
CANDIDATES = 1 << 19

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                ("period", pa.int64())]))


class Suffixes:
    """Suffix array of a sequence in which every text ends with a number of its own, and the
    ranks of all stretches of 2**k values, for every k at which some are still equal.

    ``ranks[k][i]`` is where the group of stretches equal to that at ``i`` begins in the array;
    ``equal[k]`` lists the places whose group has others.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        order = np.argsort(values, kind="stable")
        self.array = order
        self.ranks, self.equal, self.sizes = [], [], []
        rank = np.empty(n, np.int32 if n < 2**31 else np.int64)
        self._group(rank, np.arange(n), values[order], order)
        length = 1
        while len(active := self.equal[-1]):
            rank = self.ranks[-1].copy()
            key = rank[active].astype(np.int64) * (n + 1) + rank[active + length]
            by_key = np.argsort(key, kind="stable")
            slots = np.sort(self._slots)
            places = active[by_key]
            self.array[slots] = places
            self._group(rank, slots, key[by_key], places)
            length *= 2

    def _group(self, rank, slots, keys, places) -> None:
        """Ranks of ``places``, which stand at ``slots`` of the array sorted by ``keys``."""
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        begins = np.flatnonzero(first)
        sizes = np.diff(np.append(begins, len(keys)))
        group = np.cumsum(first) - 1
        rank[places] = slots[begins][group]
        many = sizes[group] > 1
        self.ranks.append(rank)
        self.equal.append(places[many])
        self._slots = slots[many]
        self.sizes.append(sizes[group][many])

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many values from ``a`` on equal those from ``b`` on, for a < b."""
        at = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            at += (rank[a + at] == rank[b + at]).astype(np.int64) << k
        return at

    def agree_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many values before ``a`` equal those before ``b``."""
        at = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, left = self.ranks[k], a - at - (1 << k)
            there = np.maximum(left, 0)
            same = (rank[there] == rank[there + b - a]) & (left >= 0)
            at += same.astype(np.int64) << k
        return at


class RangeSuccessor:
    """The least value from ``x`` on in a range of an array: a wavelet matrix, asked twice.

    It is built over a permutation of 0 .. m - 1.
    """

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros, self.before = [], []
        for bit in range(self.bits - 1, -1, -1):
            ones = values >> bit & 1
            before = np.concatenate([[0], np.cumsum(1 - ones)])  # zeros before each place
            self.before.append(before)
            self.zeros.append(before[-1])
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def __call__(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """For each range [low, high): the least value >= x, or -1."""
        smaller, begin, end = np.zeros(len(low), np.int64), low, high
        for bit, before, zeros in zip(range(self.bits - 1, -1, -1), self.before, self.zeros):
            zero_begin, zero_end = before[begin], before[end]
            one = x >> bit & 1 == 1
            smaller += np.where(one, zero_end - zero_begin, 0)
            begin = np.where(one, zeros + begin - zero_begin, zero_begin)
            end = np.where(one, zeros + end - zero_end, zero_end)
        smaller = np.where(x >> self.bits > 0, high - low, smaller)
        found = smaller < high - low
        # The value that has so many smaller ones in its range.
        nth, begin, end = np.where(found, smaller, 0), low, high
        value = np.zeros(len(low), np.int64)
        for before, zeros in zip(self.before, self.zeros):
            zero_begin, zero_end = before[begin], before[end]
            one = nth >= zero_end - zero_begin
            nth = np.where(one, nth - (zero_end - zero_begin), nth)
            begin = np.where(one, zeros + begin - zero_begin, zero_begin)
            end = np.where(one, zeros + end - zero_end, zero_end)
            value = value << 1 | one
        return np.where(found, value, -1)


def block_periods(length: int) -> tuple[int, int]:
    """Periods that blocks of a length find: from the shortest stretch that must hold such a block
    to the one that must hold a block twice as long."""
    return 1 if length == LEAST_BLOCK else length * 3 // 2 - 1, length * 3 - 2


def _blocks(suffixes: Suffixes) -> tuple[np.ndarray, ...]:
    """Begin, length, level and number of equals of all dyadic blocks that have equals."""
    found = []
    for level in range(LEAST_BLOCK.bit_length() - 1, len(suffixes.ranks)):
        length = 1 << level
        places, sizes = suffixes.equal[level], suffixes.sizes[level]
        own = places % (length // 2) == 0
        found.append((places[own], np.full(own.sum(), length), np.full(own.sum(), level),
                      sizes[own]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def candidates(suffixes: Suffixes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block, period): blocks and distances at which they come again, progression by progression."""
    begins, lengths, levels, sizes = _blocks(suffixes)
    if not len(begins):
        return
    # Only places with an equal block of the least length can be asked for.
    least = LEAST_BLOCK.bit_length() - 1
    places = np.sort(suffixes.equal[least])
    inside = np.zeros(len(suffixes.array) + 1, bool)
    inside[places] = True
    slots = np.flatnonzero(inside[suffixes.array])
    successor = RangeSuccessor(np.searchsorted(places, suffixes.array[slots]))
    low = np.empty(len(begins), np.int64)
    for level in np.unique(levels).tolist():
        own = levels == level
        low[own] = np.searchsorted(slots, suffixes.ranks[level][begins[own]])
    high = low + sizes

    def next_place(which: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first equal of the blocks from ``place`` on in their windows, or -1."""
        found = successor(low[which], high[which], np.searchsorted(places, place))
        found = np.where(found >= 0, places[found], -1)
        return np.where(found <= last[which], found, -1)

    ranges = {n: block_periods(n) for n in np.unique(lengths).tolist()}
    last = begins + np.array([ranges[n][1] for n in lengths.tolist()])
    which = np.arange(len(begins))
    place = next_place(which, begins + np.array([ranges[n][0] for n in lengths.tolist()]))
    while True:
        which, place = which[place >= 0], place[place >= 0]
        if not len(which):
            return
        following = next_place(which, place + 1)
        step = following - place
        row = (following >= 0) & (step <= lengths[which] // 2)
        count = np.ones(len(which), np.int64)
        same = np.zeros(len(which), bool)
        if row.any():
            first, second, block = place[row], following[row], begins[which[row]]
            reach = first + step[row] + suffixes.agree(first, second)  # end of the repetition
            most = np.minimum((reach - first - lengths[which[row]]) // step[row],
                              (last[which[row]] - first) // step[row])
            count[row] = most + 1
            # Does the repetition around the block itself reach the progression?
            own = block + step[row]
            own_reach = own + suffixes.agree(block, own)
            same[row] = own_reach >= first + lengths[which[row]]
        # Then the block's distances are multiples of the step, and only the step itself counts.
        times_all = np.where(same, place - begins[which] == step, count)
        use = np.flatnonzero(times_all)
        for part in np.array_split(use, max(1, -(-int(times_all[use].sum()) // CANDIDATES))):
            times = times_all[part]
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            yield (np.repeat(begins[which[part]], times),
                   np.repeat(place[part] - begins[which[part]], times)
                   + nth * np.repeat(step[part], times))
        # On from the progression's last place, or from the next equal that is none's.
        end = place + np.where(row, (count - 1) * step, 0)
        place = np.where(row, next_place(which, end + 1), following)


def find_runs(values: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, length, period) of all runs, by begin, length and period.

    ``values`` are numbers of words; each text ends with a number of its own.
    """
    suffixes = Suffixes(values)
    found = []
    for block, period in candidates(suffixes):
        after = suffixes.agree(block, block + period)
        before = suffixes.agree_before(block, block + period)
        begin, length = block - before, before + after + period
        good = length >= np.maximum(least, 2 * period)
        if good.any():
            found.append(np.unique(np.stack([begin[good], length[good], period[good]]), axis=1))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    runs = np.unique(np.concatenate(found, axis=1), axis=1)
    # Of equal stretches the smallest period counts; others are its multiples.
    first = np.ones(runs.shape[1], bool)
    first[1:] = (runs[0, 1:] != runs[0, :-1]) | (runs[1, 1:] != runs[1, :-1])
    return runs[0, first], runs[1, first], runs[2, first]


def _with_ends(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words of a batch as numbers that differ between texts, each text closed by one of its own,
    and where the texts begin."""
    texts = len(words.first) - 1
    counts = words.counts()
    first = words.first + np.arange(texts + 1)
    text = np.repeat(np.arange(texts), counts)
    values = np.empty(first[-1], np.uint64)
    salt = mix(np.arange(texts, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    values[np.arange(len(text)) + text] = mix(words.hashes ^ salt[text])
    values[first[1:] - 1] = mix(salt + np.uint64(0x632BE59BD9B4E019))
    return values, first


def dropped_words(count: int, begin: np.ndarray, length: np.ndarray,
                  period: np.ndarray) -> np.ndarray:
    """Which words of a text are in a run after its first period."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, begin + period, 1)
    np.add.at(change, begin + length, -1)
    return np.cumsum(change[:-1]) > 0


def periodic_runs(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",),
                  collapsed: bool = True) -> DataFrame:
    """``carry``, n_words, runs (by start, then period) and, if wanted, collapsed_text: the words
    that no run holds after its first period, joined by one space."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, size=STEP_BYTES):
            words = Words(step.column("text"), lower=False)
            values, first = _with_ends(words)
            begin, length, period = find_runs(values)
            order = np.lexsort((period, begin))
            begin, length, period = begin[order], length[order], period[order]
            cuts = np.searchsorted(begin, first)
            start = begin - np.repeat(first[:-1], np.diff(cuts))
            columns = [step.column(i) for i in range(len(carry))]
            columns.append(pa.array(words.counts(), pa.int64()))
            columns.append(pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start, length, period)],
                    ["start", "length", "period"])))
            names = [*carry, "n_words", "runs"]
            if collapsed:
                texts = []
                for row in range(step.num_rows):
                    raw = words.data[words.offsets[row]:words.offsets[row + 1]].tobytes()
                    own = slice(cuts[row], cuts[row + 1])
                    kept = raw.split()
                    if own.start < own.stop:
                        drop = dropped_words(len(kept), start[own], length[own], period[own])
                        kept = [kept[i] for i in np.flatnonzero(~drop).tolist()]
                    texts.append(b" ".join(kept))
                columns.append(pa.array(texts, pa.binary()).cast(pa.string(), safe=False))
                names.append("collapsed_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), "n_words bigint", f"runs {RUNS}",
                        *(["collapsed_text string"] if collapsed else [])])
    return docs.select(*carry, "text").mapInArrow(search, schema)
