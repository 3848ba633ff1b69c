"""Toxicity by the nearest labelled examples, found exactly in a block-max inverted index.

Examples that are near copies of each other (by min-hashes of their shingles) would make the words
they happen to share look telling, so one of each such group is kept. Texts are TF-IDF vectors over
all their words (lower-cased ASCII, without punctuation). Document frequencies are counted over all
documents; words of the examples count the more the stronger their link with the label is among
these (one plus ``LINK`` times phi squared, which lies between 0 and 1 at any size of sample).

Similar examples lie together in small blocks. The lists of the ``COMMON`` words that most examples
have, which make most of the index, are kept by block, each with its largest weight. A query adds up
the short lists of all its other words, bounds by the blocks' largest weights what its common words
can add, and reads the common words' lists of the most promising blocks first, then those of all
blocks that can still reach the k-th best cosine. ``QUERIES`` texts are answered together: one
product of matrices gives their bounds, and one a block what its lists add for the texts that read
it. These are in single precision; what may be among the best by that is added up in double
precision. So the nearest examples are exact, and ``blocks_read`` tells how many of the ``blocks``
were read for a text. They vote with weights that fall with distance; a logistic
curve fitted on the examples' own votes, each without itself, calibrates the vote to a probability.
A text that shares no word with any example, whose cosine with everything is 0, gets the rate of the
examples without words.

The fit uses at most ``sample`` labelled documents per class, taken by a hash, and of these no more
than ``SAMPLE_BYTES`` of text, which bounds vocabulary and index; votes and rates are weighed so
that classes count as often as they are labelled. The sample is drawn by a window over two groups,
of about ``2 * sample`` ids each. All rows are scored, and each keeps its nearest examples as
evidence. Words of no example count in the length of a text's vector: ``WORDS`` of the most
frequent with their document frequency, the others with the largest that any of them has.

Edge cases: null and empty texts have no words; very long texts are scored whole; without labels of
both classes, or without a word in the examples, every score is the rate of the label, or 0; a
document with several labels is toxic if one says so; an id with several texts is an example by the
least of them; repeated rows get equal results; equal cosines go to the earlier example in the
index, whose order the fit determines; empty tables give empty results; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landinglake.llm.dealing import look_up, run_starts, steps
from landinglake.llm.tables import sample_each, stored, trimmed
from landinglake.llm.words import MARKS, Words, mix, shingle_sets

SAMPLE = 4000
SAMPLE_BYTES = 32_000_000
# How much more a term counts that tells the label by itself (phi squared is 1).
LINK = 100.0
# Words of no example whose document frequencies go to the tasks.
WORDS = 200_000
# Words that a task counts before it passes their numbers on.
HELD = 1_000_000
NEIGHBOURS = 25
EVIDENCE = 3
# Examples per block, words whose lists are kept by block, examples whose blocks are read at first,
# and queries answered together.
BLOCK = 8
COMMON = 512
FIRST = 512
QUERIES = 256
# Numbers by which similar examples are laid together.
SKETCH = 24
# Min-hashes by which copies among the examples are told.
SIGNS = 8
THRESHOLD = 0.3
# Added to distances, so that exact copies do not outvote everything.
NEAR = 0.1


def _terms(batch: pa.RecordBatch):
    """Row, term and count of every distinct word of every row of a batch."""
    words = Words(batch.column("text"), lower=True, breaks=MARKS)
    rows, terms = np.repeat(np.arange(batch.num_rows), words.counts()), words.hashes.copy()
    bounds = words.first.tolist()
    for begin, end in zip(bounds, bounds[1:]):
        terms[begin:end].sort()
    starts = run_starts(rows, terms)
    return rows[starts], terms[starts], np.diff(np.r_[starts, len(terms)])


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``sample`` documents per class, one per group of near
    copies."""
    marked = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .filter("toxic is not null and doc_id is not null")
    chosen = sample_each(marked, "toxic", sample, "doc_id").select("doc_id", "toxic")
    # At most two times ``sample`` ids, so the texts need not be shuffled; rows of one id meet as
    # one a task.
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
                  .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")),
                  "labelled")

    def sign(batches):
        for batch in steps(batches):
            values, first = shingle_sets(Words(batch.column("text"), lower=True), 5)
            full = np.append(values, np.uint64(0))  # keeps the last slice in bounds
            signs = [np.where(np.diff(first) > 0, np.minimum.reduceat(
                mix(full ^ np.uint64(seed + 1)), first[:-1]), 0) for seed in range(SIGNS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()),
                 pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64()),
                 *(pa.array(s.view(np.int64)) for s in signs)],
                names=["doc_id", "toxic", "bytes", *(f"s{i}" for i in range(SIGNS))])

    signed = rows.mapInArrow(sign, "doc_id bigint, toxic int, bytes bigint, " + ", ".join(
        f"s{i} bigint" for i in range(SIGNS))).toArrow()
    ids, toxic, size = (signed.column(c).to_numpy() for c in ("doc_id", "toxic", "bytes"))
    order = np.argsort(mix(ids.astype(np.int64).view(np.uint64)), kind="stable")
    fits = np.zeros(len(ids), bool)
    for own in (order[toxic[order] > 0], order[toxic[order] <= 0]):
        fits[own] = np.cumsum(size[own]) <= SAMPLE_BYTES
    kept = first_of_copies(ids[fits], np.column_stack(
        [signed.column(f"s{i}").to_numpy()[fits] for i in range(SIGNS)]))
    wanted = rows.sparkSession.createDataFrame([(i,) for i in kept], "doc_id bigint")
    return rows.join(F.broadcast(wanted), "doc_id")


def first_of_copies(ids: np.ndarray, signs: np.ndarray) -> list[int]:
    """The ids, in order, without those that agree with an earlier one in half of the signs.

    The number of rows is bounded by the sample. Each row is compared with the first kept row of
    each of its signs.
    """
    kept, holders = [], [{} for _ in range(signs.shape[1])]
    for row in np.argsort(ids, kind="stable").tolist():
        own = signs[row].tolist()
        earlier = {holders[i][sign] for i, sign in enumerate(own) if sign in holders[i]}
        if any(own) and any(2 * int((signs[other] == signs[row]).sum()) >= len(own)
                            for other in earlier):
            continue
        kept.append(int(ids[row]))
        for i, sign in enumerate(own):
            holders[i].setdefault(sign, row)
    return sorted(set(kept))


def linked_terms(rows: DataFrame, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """All terms of (toxic, text) rows, sorted, and the link (phi squared) of each with the
    label."""

    def count(batches):
        for batch in steps(batches):
            at, terms, _ = _terms(batch)
            toxic = batch.column("toxic").to_numpy()[at] > 0
            values, place = np.unique(terms, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)),
                 pa.array(np.bincount(place, toxic, len(values)).astype(np.int64)),
                 pa.array(np.bincount(place, ~toxic, len(values)).astype(np.int64))],
                names=["term", "toxic", "clean"])

    a, b = F.col("toxic"), F.col("clean")
    c, d = n_toxic - a, n_clean - b
    # A term of every row says nothing about the label.
    link = F.when(c + d > 0, F.pow(a * d - b * c, F.lit(2)) / (
        (a + b) * F.greatest(c + d, F.lit(1.0)) * float(n_toxic) * n_clean)).otherwise(0.0)
    found = (rows.mapInArrow(count, "term bigint, toxic bigint, clean bigint").groupBy("term")
             .agg(F.sum("toxic").cast("double").alias("toxic"),
                  F.sum("clean").cast("double").alias("clean"))
             .select("term", link.alias("link")).toArrow())
    terms = found.column("term").to_numpy().view(np.uint64)
    order = np.argsort(terms)
    return terms[order], found.column("link").to_numpy()[order]


def document_frequencies(docs: DataFrame, terms: np.ndarray, most: int = WORDS
                         ) -> tuple[np.ndarray, np.ndarray, int]:
    """Words, sorted, and in how many of ``docs`` each occurs: ``terms`` and, of the others, up to
    ``most`` of the most frequent; then the largest number that a word left out has."""

    def counted(held):
        terms = np.concatenate([own for own, _ in held])
        order = np.argsort(terms)
        terms = terms[order]
        starts = run_starts(terms)
        n = np.concatenate([n for _, n in held])[order]
        return pa.RecordBatch.from_arrays(
            [pa.array(terms[starts].view(np.int64)),
             pa.array(np.add.reduceat(n, starts) if len(starts) else n)], names=["term", "n"])

    def count(batches):
        held, size = [], 0
        for batch in steps(batches):
            held.append(np.unique(_terms(batch)[1], return_counts=True))
            size += len(held[-1][0])
            if size >= HELD:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    listed = docs.sparkSession.createDataFrame(pa.table(
        {"term": pa.array(terms.view(np.int64)), "listed": pa.array(np.ones(len(terms), bool))}))
    # The terms are those of a sample bounded in bytes.
    counts = stored(docs.select("text").mapInArrow(trimmed(count), "term bigint, n bigint")
                    .groupBy("term").agg(F.sum("n").alias("n"))
                    .join(F.broadcast(listed), "term", "left")
                    .select("term", "n", F.col("listed").isNotNull().alias("listed")), "counts")
    # Ninths of doublings: some hundred classes of frequency at any size.
    level = F.floor(F.log2("n") * 9)
    classes = sorted(((r.level, r.words, r.most) for r in counts.filter("not listed").groupBy(
        level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("most"))
        .collect()), reverse=True)
    taken, least, rest = 0, 1 << 30, 0
    for own, words, largest in classes:
        if taken + words > most:
            rest = largest
            break
        taken, least = taken + words, own
    found = counts.filter(F.col("listed") | (level >= least)).select("term", "n").toArrow()
    words = found.column("term").to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], found.column("n").to_numpy()[order], rest


def laid_together(vectors: list[tuple[np.ndarray, np.ndarray]], terms: np.ndarray,
                  block: int = BLOCK) -> np.ndarray:
    """An order of the vectors (numbers of ``terms``, weights) in which similar ones are near: they
    are halved along their widest direction, down to blocks."""
    signs = (terms[:, None] >> np.arange(SKETCH, dtype=np.uint64) & np.uint64(1)).astype(float) - .5
    sketch = np.array([weights @ signs[own] for own, weights in vectors]).reshape(-1, SKETCH)
    order, open_ = [np.zeros(0, int)], [np.arange(len(vectors))]
    while open_:
        rows = open_.pop()
        if len(rows) <= block:
            order.append(rows)
            continue
        off = sketch[rows] - sketch[rows].mean(0)
        widest = np.linalg.eigh(off.T @ off)[1][:, -1]
        rows = rows[np.argsort(off @ widest, kind="stable")]
        half = -(-len(rows) // block) // 2 * block
        open_ += [rows[half:], rows[:half]]
    return np.concatenate(order)


class BlockMaxIndex:
    """Unit vectors (numbers of terms, weights, none negative) by term. The lists of the most
    common terms are kept by block, with the largest weight of each term in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int,
                 block: int = BLOCK, common: int = COMMON):
        self.size, self.block = len(vectors), block
        self.blocks = -(-len(vectors) // block)
        terms = np.concatenate([v[0] for v in vectors]) if vectors else np.zeros(0, int)
        weights = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0)
        owners = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
        held = np.bincount(terms, minlength=n_terms)
        top = np.argsort(-held, kind="stable")[:common]
        self.place = np.full(n_terms, -1, np.int32)
        self.place[top] = np.arange(len(top))
        own = self.place[terms] >= 0
        # By block and common term, in single precision; by vector, as they are.
        self.lists = np.zeros((self.blocks, len(top), block), np.float32)
        self.lists[owners[own] // block, self.place[terms[own]], owners[own] % block] = weights[own]
        self.bounds = np.ascontiguousarray(self.lists.max(axis=2).T)
        self.common, self.common_weights = self.place[terms[own]], weights[own]
        self.common_offsets = np.searchsorted(owners[own], np.arange(len(vectors) + 1))
        # The share by which a sum of products in single precision may be off.
        self.rough = (len(top) + 8) * 2.0 ** -24
        terms, weights, owners = terms[~own], weights[~own], owners[~own]
        order = np.lexsort((owners, terms))
        self.owners, self.weights = owners[order], weights[order]
        self.offsets = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int,
                without: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Numbers and cosines of the ``k`` vectors nearest to a unit vector, best first, fewer
        if fewer have a cosine above 0; and how many blocks were read for it."""
        return next(self.nearest_each([(terms, weights, without)], k))

    def nearest_each(self, queries: list[tuple[np.ndarray, np.ndarray, int]], k: int
                     ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """What ``nearest`` gives for each of the queries (terms, weights, without)."""
        # Groups of about the same size.
        groups = -(-len(queries) // QUERIES)
        for group in range(groups):
            yield from self._nearest(queries[len(queries) * group // groups:
                                             len(queries) * (group + 1) // groups], k)

    def _nearest(self, queries, k):
        sums = np.empty((len(queries), self.blocks * self.block))
        exact = np.zeros((len(queries), len(self.bounds)))
        for row, (terms, weights, _) in enumerate(queries):
            place = self.place[terms]
            common = place >= 0
            exact[row, place[common]] = weights[common]
            sums[row] = self._short_lists(terms[~common], weights[~common])
        rough = exact.astype(np.float32)
        # Cosines where the common lists are read, what the short ones add elsewhere.
        flat = sums.astype(np.float32)
        found = flat.reshape(len(queries), self.blocks, self.block)
        bounds = rough @ self.bounds
        bounds += reduce(np.maximum, (found[:, :, i] for i in range(self.block)))
        bounds *= 1 + 2 * self.rough
        rows, without = np.arange(len(queries)), np.array([q[2] for q in queries])

        def read(wanted):
            # One product a block, with the queries that want it.
            for block, own in enumerate(np.ascontiguousarray(wanted.T)):
                if len(own := np.flatnonzero(own)):
                    found[own, block] += rough[own] @ self.lists[block]
            flat[rows[without >= 0], without[without >= 0]] = 0

        # The most promising blocks first; they tell what the others have to reach.
        promising = bounds > 0
        first = min(self.blocks, -(-FIRST // self.block))
        best = np.argpartition(-bounds, first - 1, axis=1)[:, :first]
        wanted = np.zeros_like(promising)
        np.put_along_axis(wanted, best, True, axis=1)
        read(wanted & promising)
        near = np.take_along_axis(found, best[:, :, None], axis=1).reshape(len(queries), -1)
        least = np.zeros(len(queries), np.float32)
        if near.shape[1] >= k:
            least = np.maximum(0, np.partition(near, -k, axis=1)[:, -k]) * np.float32(
                1 - 4 * self.rough)
        more = promising & ~wanted & (bounds >= least[:, None])
        read(more)
        blocks = ((wanted & promising) | more).sum(axis=1).tolist()
        for row in range(len(queries)):
            at = np.flatnonzero((flat[row] >= least[row]) & (flat[row] > 0))
            if len(at) > k:
                # What may be among the best is added up as it is.
                near = flat[row, at]
                at = at[near >= np.partition(near, -k)[-k] * (1 - 4 * self.rough)]
            cosines = sums[row, at] + self._common_sums(exact[row], at)
            order = np.lexsort((at, -cosines))[:k]
            yield at[order], cosines[order], blocks[row]

    def _short_lists(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the terms that are not common add to the cosines of a query."""
        begin = self.offsets[terms]
        sizes = self.offsets[terms + 1] - begin
        at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        # All places are inside; clipping only spares a copy.
        products = np.take(self.weights, at, mode="clip")
        products *= np.repeat(weights, sizes)
        return np.bincount(np.take(self.owners, at, mode="clip"), products,
                           self.blocks * self.block)

    def _common_sums(self, weights: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """What the common terms of a query add to its cosines with the vectors ``numbers``."""
        begin, end = self.common_offsets[numbers], self.common_offsets[numbers + 1]
        sums, some = np.zeros(len(numbers)), end > begin
        if some.any():
            own = [slice(*pair) for pair in zip(begin[some].tolist(), end[some].tolist())]
            products = weights[np.concatenate([self.common[each] for each in own])]
            products *= np.concatenate([self.common_weights[each] for each in own])
            sizes = (end - begin)[some]
            sums[some] = np.add.reduceat(products, np.cumsum(sizes) - sizes)
        return sums


@dataclass
class Model:
    rate: float  # score of texts without a word of the examples
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))  # weighed by the link
    number: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # of a term, or -1
    other: float = 0.0  # idf of all other words
    index: BlockMaxIndex | None = None
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    worth: np.ndarray = field(default_factory=lambda: np.zeros(0))
    neighbours: int = NEIGHBOURS
    curve: tuple[float, float] = (1.0, 0.0)

    def vectors(self, batch: pa.RecordBatch):
        """(row, numbers of terms, weights) of every row of a batch that has a word: the unit
        vector, less what no example has."""
        rows, words, counts = _terms(batch)
        # In order, so that neighbours in the table are looked up one after the other.
        order = np.argsort(words)
        known, at = np.empty(len(words), bool), np.empty(len(words), np.int64)
        known[order], at[order] = look_up(self.words, words[order])
        weights = 1 + np.log(counts)
        weights *= np.where(known, self.idf[at], self.other) if len(self.idf) else self.other
        numbers = np.where(known, self.number[at], -1) if len(self.idf) else np.full(len(at), -1)
        starts = run_starts(rows)
        ends = np.r_[starts[1:], len(rows)][:len(starts)]
        for begin, end in zip(starts.tolist(), ends.tolist()):
            own = weights[begin:end]
            held = numbers[begin:end] >= 0
            yield (int(rows[begin]), numbers[begin:end][held].astype(np.int64),
                   own[held] / np.linalg.norm(own))

    def vote(self, numbers: np.ndarray, cosines: np.ndarray) -> float:
        weights = self.worth[numbers] / (NEAR + np.maximum(0.0, 1 - cosines))
        return float(weights @ self.toxic[numbers] / weights.sum())

    def calibrated(self, vote: float | None) -> float:
        if vote is None:
            return self.rate
        slope, shift = self.curve
        return 1 / (1 + math.exp(-(slope * _logit(vote) + shift)))


def _logit(share: float) -> float:
    share = min(max(share, 0.005), 0.995)
    return math.log(share / (1 - share))


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic curve, by damped Newton steps."""
    design = np.c_[x, np.ones(len(x))]
    fit = np.array([1.0, 0.0])
    ridge = np.diag([1e-2, 1e-2]) * weights.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ fit, -30, 30)))
        slope = design.T @ (weights * (p - y)) + ridge @ (fit - [1.0, 0.0])
        curve = (design * (weights * p * (1 - p))[:, None]).T @ design + ridge
        fit = fit - np.linalg.solve(curve, slope)
    return max(0.0, float(fit[0])), float(fit[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, link: float = LINK,
        neighbours: int = NEIGHBOURS) -> Model:
    """Fit on at most ``sample`` documents per class of ``labels`` (doc_id, toxic). A term that
    tells the label by itself counts ``link`` times more."""
    rows = stored(labelled_sample(docs, labels, sample), "examples")
    counts = {r.toxic > 0: r.n for r in rows.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    of_class = {r.toxic > 0: r.n for r in labels.groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).filter("toxic is not null").groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model(float(True in counts))
    # What one example of a class stands for.
    share = {toxic: of_class[toxic] / n for toxic, n in counts.items()}
    plain_rate = of_class[True] / (of_class[True] + of_class[False])
    terms, links = linked_terms(rows, counts[True], counts[False])
    if not len(terms):
        return Model(plain_rate)
    total = docs.count()
    words, n, rest = document_frequencies(docs, terms)
    known, number = look_up(terms, words)
    idf = np.log1p(total / (1 + n)) * np.where(known, 1 + link * links[number], 1)
    model = Model(plain_rate, words, idf, np.where(known, number, -1).astype(np.int32),
                  math.log1p(total / (1 + rest)), neighbours=neighbours)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def vectors(batches):
        for batch in steps(batches):
            own = {row: (numbers.tobytes(), weights.tobytes())
                   for row, numbers, weights in sent.value.vectors(batch)}
            pairs = [own.get(row, (b"", b"")) for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()),
                 *(pa.array(c, pa.binary()) for c in zip(*pairs))],
                names=["doc_id", "toxic", "terms", "weights"])

    # At most two times ``sample`` rows of at most ``SAMPLE_BYTES`` of text a class.
    found = rows.mapInArrow(vectors, "doc_id bigint, toxic int, terms binary, weights binary").toArrow()
    sent.destroy()
    examples = sorted((r["doc_id"], float(r["toxic"] > 0), np.frombuffer(r["terms"], np.int64),
                       np.frombuffer(r["weights"])) for r in found.to_pylist())
    with_terms = [e for e in examples if len(e[2])]
    order = laid_together([(e[2], e[3]) for e in with_terms], terms)
    with_terms = [with_terms[i] for i in order.tolist()]
    model.rate = _rate([e[1] for e in examples if not len(e[2])], share, plain_rate)
    model.ids = np.array([e[0] for e in with_terms], np.int64)
    model.toxic = np.array([e[1] for e in with_terms])
    model.worth = np.array([share[e[1] > 0] for e in with_terms])
    model.index = BlockMaxIndex([(e[2], e[3]) for e in with_terms], len(terms))
    votes = _own_votes(rows, model)
    if len(votes):
        weights = np.where(votes[:, 1] > 0, share[True], share[False])
        model.curve = logistic(np.array([_logit(v) for v in votes[:, 0]]), votes[:, 1], weights)
    return model


def _own_votes(rows: DataFrame, model: Model) -> np.ndarray:
    """Vote and label of every example that has neighbours, found without itself."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def vote(batches):
        model = sent.value
        place = {int(doc): i for i, doc in enumerate(model.ids)}
        for batch in steps(batches):
            found, ids = [], batch.column("doc_id").to_pylist()
            queries = [(terms, weights, place[ids[row]])
                       for row, terms, weights in model.vectors(batch)]
            for (_, _, own), (numbers, cosines, _) in zip(
                    queries, model.index.nearest_each(queries, model.neighbours)):
                if len(numbers):
                    found.append((int(model.ids[own]), model.vote(numbers, cosines),
                                  model.toxic[own]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*found)) or [[]] * 3,
                                                (pa.int64(), pa.float64(), pa.float64()))],
                names=["doc_id", "vote", "toxic"])

    found = rows.mapInArrow(vote, "doc_id bigint, vote double, toxic double").toArrow().sort_by("doc_id")
    sent.destroy()
    return np.column_stack([found.column(c).to_numpy() for c in ("vote", "toxic")])


def _rate(labels: list[float], share: dict, otherwise: float) -> float:
    toxic = sum(labels) * share[True]
    clean = (len(labels) - sum(labels)) * share[False]
    return toxic / (toxic + clean) if labels else otherwise


_RESULT = ("doc_id bigint, score double, predicted int, "
           "evidence array<struct<doc_id:bigint,similarity:double,toxic:int>>, "
           "blocks_read int, blocks int")


def score_toxicity(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, evidence, blocks_read, blocks) for every row of ``docs``
    (doc_id, text)."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = known.value
        for batch in steps(batches):
            scores = [model.rate] * batch.num_rows
            evidence, held = [(np.zeros(0, int), np.zeros(0))], np.zeros(batch.num_rows + 1, np.int32)
            read, blocks = [0] * batch.num_rows, 0
            if model.index is not None and model.index.size:
                blocks = model.index.blocks
                rows = list(model.vectors(batch))
                found = model.index.nearest_each(
                    [(terms, weights, -1) for _, terms, weights in rows], model.neighbours)
                for (row, _, _), (numbers, cosines, read[row]) in zip(rows, found):
                    scores[row] = model.calibrated(
                        model.vote(numbers, cosines) if len(numbers) else None)
                    evidence.append((numbers[:EVIDENCE], cosines[:EVIDENCE]))
                    held[row + 1] = len(evidence[-1][0])
            best, similarity = (np.concatenate(c) for c in zip(*evidence))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32()),
                 pa.ListArray.from_arrays(np.cumsum(held, dtype=np.int32), pa.StructArray.from_arrays(
                     [pa.array(model.ids[best]), pa.array(similarity),
                      pa.array(model.toxic[best].astype(np.int32))],
                     names=["doc_id", "similarity", "toxic"])),
                 pa.array(read, pa.int32()), pa.array([blocks] * batch.num_rows, pa.int32())],
                names=["doc_id", "score", "predicted", "evidence", "blocks_read", "blocks"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(score), _RESULT)
