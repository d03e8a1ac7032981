"""Harmonic packing of token ids into sequences of a fixed capacity.

A piece of length r belongs to class k, the largest k with r <= capacity / k; a sequence of class k
takes exactly k pieces of that class, whatever they are. A document may be cut, so it is cut where
classes end: whole sequences first, then, as long as the rest would leave a gap that matters, a
piece of exactly capacity // (k + 1) tokens, which fills class k + 1 without a gap. The rest gets
smaller very fast, and from class ``fine`` on a rest is packed as it is.

Workers are independent: each keeps one open sequence per class, with sequence numbers that hold
its partition number. At its end a worker closes its open sequences by laying their pieces end to
end, cut at the capacity, so that at most one sequence per worker stays short.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LATIN, Rows, byte_level, load_tokenizer, row_key, rows_of

CAPACITY, FINE = 4096, 32
#: Distinct words whose ids a task remembers.
WORDS = 500_000
END_ID = 2

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Known(dict):
    """Remembers what ``make`` gives for a key."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        self[key] = value = self.make(key)
        return value


class WordIds:
    """The library's ids of texts as little-endian unsigned 32-bit integers.

    This BPE drops white space and never merges across it, so what stands between white space is cut
    into words and given to the library's model once, and remembered here. Texts with special strings
    or rare scripts go to the library whole.
    """

    #: The word pattern in the tokenizer's file, and the same for Latin script; no word holds white space.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    LATIN = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]++|[0-9]|(?:[^\s\w]|_)++")

    def __init__(self, path: str | None):
        self.tokenizer = load_tokenizer(path or word_bpe_path())
        self.model = self.tokenizer.model
        self.by_word = self.PATTERN in self.tokenizer.to_str(False).replace("\\\\", "\\")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.words, self.chunks = Known(self.word), Known(self.chunk)

    def word(self, word: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(byte_level(word))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.LATIN.findall(chunk)))

    def of(self, text: str) -> bytes:
        if self.by_word and LATIN.fullmatch(text) and not (self.special and self.special.search(text)):
            if len(self.chunks) > WORDS:
                self.chunks.clear()
                self.words.clear()
            return b"".join(map(self.chunks.__getitem__, text.lower().split()))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


def pieces_of(tokens: int, capacity: int = CAPACITY, fine: int = FINE) -> Iterator[tuple[int, int]]:
    """(length, class) of the pieces of a document, in its order."""
    for _ in range(tokens // capacity):
        yield capacity, 1
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        if k >= fine or rest == capacity // k:
            yield rest, k
            return
        head = capacity // (k + 1)
        yield head, k + 1
        rest -= head


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
    capacity: int = CAPACITY, fine: int = FINE, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers (null if not wanted). A null
    text counts as empty: its document is the end id alone. A null id stays null; rows that repeat an id
    are documents of their own. An empty table gives no piece. Sequences are to be padded to the
    capacity. Numbers depend on the partitions of the input, which a file scan repeats exactly when a
    task runs again.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end, out = WordIds(path), END_ID.to_bytes(4, "little"), Rows(PIECES, 5_000)
        sequences, open_ = 0, {}

        def put(id_, start, total, data, sequence, offset):
            out.add(id_, start, len(data) // 4, zlib.crc32(data), total, row_key(sequence), offset, data if with_ids else None)

        for id_, text_ in rows_of(batches):
            data = ids_of.of(text_ or "") + end
            total, start = len(data) // 4, 0
            for length, k in pieces_of(total, capacity, fine):
                bin_ = open_.setdefault(k, [])
                bin_.append((id_, start, total, data[4 * start : 4 * (start + length)]))
                start += length
                if len(bin_) == k:
                    offset = 0
                    for piece in open_.pop(k):
                        put(*piece, sequences, offset)
                        offset += len(piece[3]) // 4
                    sequences += 1
            if out.full():
                yield out.take()
        offset = 0
        for _, bin_ in sorted(open_.items()):
            for id_, start, total, data in bin_:
                while data:
                    if offset == capacity:
                        sequences, offset = sequences + 1, 0
                    part, data = data[: 4 * (capacity - offset)], data[4 * (capacity - offset) :]
                    put(id_, start, total, part, sequences, offset)
                    offset, start = offset + len(part) // 4, start + len(part) // 4
        yield out.take()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return rows.mapInArrow(packed, schema)
