"""Best-fit packing of tokenised documents into fixed-length training sequences.

Documents become pieces of at most ``max_tokens`` ids; only longer documents are cut. Pieces are
dealt to groups by a hash of their key, and within a group an online best-fit packer places them,
long ones first. It keeps a fixed number of open sequences in a bitset keyed by free space: the
lowest set bit at or above the piece's length is the best fit, and when all places are taken the
fullest open sequence closes. State is bounded by ``open_bins``, not by the group.

Edge cases: a null or empty text is the closing id alone (one piece of length 1); repeated rows
and repeated ids each get pieces of their own; an empty table gives an empty result; other columns
of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landinglake.llm.tables import give_back, stored, trimmed

MAX_TOKENS = 2048
CLOSING_ID = 0
# Open sequences of a packer, and pieces dealt to one packer.
OPEN_BINS = 16_384
PIECES_PER_GROUP = 32_768
# Entries of a worker's cache of chunks and pre-tokens; a full one starts afresh.
CACHE_ENTRIES = 300_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class ChunkIds(dict):
    """Ids of space-free chunks, as bytes of little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    chunks in turn. Plain Latin chunks are split here and each lower-case pre-token goes through
    the model once; everything else goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Latin letters, digits and ASCII marks: one code point each, stable under NFC.
        self.plain = regex.compile(r"[!-;=-~À-ÖØ-öø-į]*").fullmatch
        self.split = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.bytes_of = _byte_letters()
        give_back()  # what reading the vocabulary took

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isprintable() and "<" not in chunk or self.plain(chunk):
            text = chunk.lower()
            found = self._plain_ids(text)
            if text == chunk and text in self:  # a pre-token by itself
                return found
        else:
            found = _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        return self._keep(chunk, found)

    def _keep(self, chunk: str, found: bytes) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[chunk] = found
        return found

    def _plain_ids(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._pre_token(chunk)
        if chunk[:-1].isalpha() and chunk[-1] in ",.;:!?":  # most of the others
            return self._pre_token(chunk[:-1]) + self._pre_token(chunk[-1])
        return b"".join(map(self._pre_token, self.split(chunk)))

    def _pre_token(self, text: str) -> bytes:
        found = self.get(text)
        if found is None:
            letters = text if text.isascii() else "".join(
                self.bytes_of[b] for b in text.encode())
            found = self._keep(text, _packed([t.id for t in self.model.tokenize(letters)]))
        return found

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: Latin-1 characters
    that can be seen stand for themselves, the others are numbered from 256."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(seen)]
    letters = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
                 closing_id: int = CLOSING_ID) -> DataFrame:
    """One row per piece: document, number, start in its ids, length and CRC-32 of the ids."""
    closing = int(closing_id).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkIds(tokenizer_path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = (chunks.ids(text.as_py()) if text.is_valid else b"") + closing
                for number, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    part = ids[at:at + 4 * max_tokens]
                    rows.append((doc_id, number, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(pieces), PIECES)


class BestFit:
    """Online best fit into sequences of ``capacity`` with at most ``open_bins`` open ones."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # bit f is set while a sequence with f free places is open
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.opened = 0

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.free ^= 1 << free
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The sequence that takes the next piece, and the piece's offset in it."""
        fitting = self.free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            free, number = self.capacity, self.opened
            self.opened += 1
        rest = free - length
        if rest:
            self.bins[rest].append(number)
            self.free |= 1 << rest
            self.open += 1
        return number, self.capacity - free


def pack_pieces(pieces: DataFrame, groups: int, capacity: int = MAX_TOKENS,
                open_bins: int = OPEN_BINS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (the columns of ``PIECES``)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, current = None, None
        for batch in batches:
            placed = []
            for group, length in zip(batch.column("group").to_pylist(),
                                     batch.column("length").to_pylist()):
                if group != current:
                    packer, current = BestFit(capacity, open_bins), group
                number, offset = packer.place(length)
                placed.append(((group << 40) + number, offset))
            ids, offsets = zip(*placed) if placed else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*batch.schema.names[1:], "sequence_id", "offset"])

    group = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int")
    dealt = pieces.select(group.alias("group"), *pieces.columns)
    return (dealt.repartitionById(groups, "group")
            .sortWithinPartitions("group", F.desc("length"), "doc_id", "piece", "ids_crc32")
            .mapInArrow(trimmed(pack), PIECES + ", sequence_id bigint, offset bigint"))


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS,
                   closing_id: int = CLOSING_ID, open_bins: int = OPEN_BINS,
                   pieces_per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Pack ``docs`` (doc_id, text): ``PIECES`` plus sequence_id and offset.

    The tokenised pieces (numbers only, no ids) are written once, as their count sets the number
    of groups; text is read once.
    """
    pieces = stored(token_pieces(docs, tokenizer_path, max_tokens, closing_id), "pieces")
    return pack_pieces(pieces, max(1, -(-pieces.count() // pieces_per_group)), max_tokens, open_bins)
