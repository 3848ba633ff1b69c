"""Token counts of whole documents without making their ids.

A SentencePiece BPE model whose pieces never reach across the start of a word tokenises each
pre-token (a word with the spaces before it, or a line end and what follows it) by itself. So the
pieces of every distinct pre-token of the corpus are counted once, and a document's count is the
sum over its pre-token frequencies joined with that table.

The join is in two parts. The most frequent pre-tokens, at most ``head_entries`` of them and at most
``head_bytes`` long together, go to the tasks as a table of proven size and are summed where the
text is read, which also takes the hot keys out of the shuffle. All other pre-tokens of a document
go through a shuffled join on the pre-token.

Edge cases: a null or empty text has no tokens and, like any text, one row; repeated rows and ids
each keep their row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landinglake.llm.tables import stored

HEAD_ENTRIES = 150_000
HEAD_BYTES = 4_000_000
HEAD_TOKEN_BYTES = 256
# Distinct pre-tokens a task gathers before it passes their counts on.
FLUSH_ENTRIES = 300_000
SPACE = "▁"

# After a space is put before the text: spaces and what follows, or a line end and what follows.
_RUNS = re.compile(r" +[^ \n]*|\n[^ \n]*").findall
_ODD = re.compile(r"  |\n | \n|^[ \n]|[ \n]$|" + SPACE).search


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without its last leading space; the empty string is a space
    alone. A line end at the front stays, as such a pre-token has no space of its own."""
    if not text:
        return []
    if _ODD(text):
        text = text.replace(SPACE, " ")
        return [t[1:] if t[0] == " " else t for t in _RUNS(" " + text)]
    return text.replace("\n", " \n").split(" ")


class PieceCounter:
    """Pieces of a pre-token by the library, checked to be independent of its neighbours."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        whole = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(SPACE in piece.lstrip(SPACE) or " " in piece or "\n" in piece for piece in whole):
            raise ValueError("the model has pieces that reach across words")
        if "".join(self.model.encode(" a", out_type=str)) != SPACE * 2 + "a":
            raise ValueError("the model does not keep spaces, or puts none before the text")

    def counts(self, tokens: list[str]) -> list[int]:
        found = self.model.encode(tokens, num_threads=1)
        # A line end first: the space that the library puts before it does not exist here. The
        # empty pre-token is a space, for which the library returns nothing.
        return [len(ids) - 1 if token[:1] == "\n" else len(ids) or 1
                for token, ids in zip(tokens, found)]


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (text or "" for text in batch.column("text").to_pylist())


def pre_token_totals(docs: DataFrame) -> DataFrame:
    """(token, total): every distinct pre-token of all texts, and how often it occurs."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in _texts(batch):
                seen.update(pre_tokens(text))
                if len(seen) >= FLUSH_ENTRIES:
                    yield _frame(seen)
                    seen.clear()
        yield _frame(seen)

    def _frame(seen):
        return pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
            names=["token", "n"])

    parts = docs.select("text").mapInArrow(partial, "token string, n bigint")
    return parts.groupBy("token").agg(F.sum("n").alias("total"))


def piece_table(docs: DataFrame, model_path: str) -> DataFrame:
    """(token, total, pieces), each distinct pre-token tokenised once; a stored table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counter.counts(batch.column(0).to_pylist()), pa.int64())],
                names=["token", "total", "pieces"])

    return stored(pre_token_totals(docs).mapInArrow(
        count, "token string, total bigint, pieces bigint"), "pieces")


def frequent(pieces: DataFrame, entries: int = HEAD_ENTRIES, max_bytes: int = HEAD_BYTES) -> dict:
    """The most frequent pre-tokens and their pieces, within both bounds.

    How many pre-tokens lie in each step of frequency is counted first, so that no more than
    ``entries`` rows leave the tasks.
    """
    pieces = pieces.filter(F.octet_length("token") <= HEAD_TOKEN_BYTES)
    step = F.floor(8 * F.log2("total"))
    counts = pieces.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, taken = None, 0
    for row in sorted(counts, key=lambda r: -r.step):
        taken += row.n
        if taken > entries:
            break
        least = row.step
    if least is None:
        return {}
    head, size = {}, 0
    rows = pieces.filter(step >= least).select("token", "total", "pieces").collect()
    for row in sorted(rows, key=lambda r: (-r.total, r.token)):
        size += len(row.token.encode()) + 8
        if size > max_bytes:
            break
        head[row.token] = row.pieces
    return head


def token_counts(docs: DataFrame, model_path: str, limit: int, head_entries: int = HEAD_ENTRIES,
                 head_bytes: int = HEAD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    pieces = piece_table(docs, model_path)
    head = spark.sparkContext.broadcast(frequent(pieces, head_entries, head_bytes))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # keeps the lists below small
                yield from _split_rows(batch.slice(at, 512), known)

    def _split_rows(batch, known):
        rows, tokens, counts = [], [], []
        sizes = batch.column("n_bytes").to_pylist()
        for row, (doc_id, n_bytes, text) in enumerate(zip(
                batch.column("doc_id").to_pylist(), sizes, _texts(batch))):
            found = Counter(pre_tokens(text))
            total, rest = 0, []
            for token, n in found.items():
                each = known(token)
                if each is None:
                    rest.append(token)
                    counts.append(n)
                else:
                    total += n * each
            rows.append((doc_id, n_bytes, total, len(rest)))
            tokens += rest
        if not rows:
            return
        ids, sizes, totals, rests = zip(*rows)
        offsets = [0]
        for n in rests:
            offsets.append(offsets[-1] + n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(totals, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens, pa.string())),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(counts, pa.int64()))],
            names=["row_id", "doc_id", "n_bytes", "known", "tokens", "counts"])

    # The row's number tells repeated ids apart; the table is written before it is used twice.
    numbered = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id",
                           F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
                           .alias("n_bytes"), "text")
    rows = stored(numbered.mapInArrow(
        split, "row_id bigint, doc_id bigint, n_bytes bigint, known bigint, "
               "tokens array<string>, counts array<bigint>"), "frequencies")
    rest = rows.select("row_id", F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
    rest = (rest.select("row_id", F.col("t.tokens").alias("token"), F.col("t.counts").alias("n"))
            .join(pieces.select("token", "pieces"), "token")
            .groupBy("row_id").agg(F.sum(F.col("n") * F.col("pieces")).alias("rest")))
    total = F.col("known") + F.coalesce("rest", F.lit(0))
    return (rows.select("row_id", "doc_id", "n_bytes", "known").join(rest, "row_id", "left")
            .select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")))
