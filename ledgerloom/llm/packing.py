"""Documents packed into training sequences by harmonic classes.

A document's tokens are cut into whole sequences and a rest, and the rest into pieces whose lengths are powers of
two. Every piece length is the capacity divided by a whole number k, its class, and a bin of class k takes exactly k
pieces, so bins close full. Each task packs the documents of its own partition: it holds at most one open bin per
class and needs nothing from other tasks. When a task ends, its open bins hold less than one sequence per class; laid
out longest first they fill whole sequences again, and what is left goes into sequences whose lengths are powers of
two, which take no padding.

Nothing is shuffled, no document is dropped, and memory does not grow with the input.

Cases: a null or empty text is the end-of-document token alone; a null doc_id stays null; repeated rows are packed
again each time; the string of a special token inside a text is that token; very long texts give many whole sequences; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CAPACITY = 1024
END = 0
#: Characters for which both tokenizer libraries cut words alike; other texts go to the slower one.
COMMON = r"[^\t\n\r\x20-\x7e\xa1-ſ]"
BYTES_PER_BATCH = 8 << 20
SCHEMA = "doc_id bigint, start bigint, ids binary, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class Encoder:
    """Token ids of texts by a byte-level vocabulary file.

    The vocabulary comes as a tokenizer file and as ranks. The rank library is several times faster and gives the same
    ids; it takes the texts whose characters all lie in ``COMMON``, the tokenizer file the others. The string of a
    special token inside a text is that token, as the tokenizer file has it by default, and goes there too; with
    ``plain_text`` it is text like any other.
    """

    def __init__(self, vocabulary: str, ranks: str, plain_text: bool = False) -> None:
        import base64
        import json

        import public_tokenizers
        import tiktoken

        self.file, self.plain_text = public_tokenizers.path(vocabulary), plain_text
        with open(public_tokenizers.path(ranks), "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.uncommon = re.compile(COMMON).search
        with open(self.file) as text:
            added = [t["content"] for t in json.load(text)["added_tokens"] if not (plain_text and t["special"])]
        self.literal = re.compile("|".join(map(re.escape, added)) or r"(?!)").search

    @cached_property
    def tokenizer(self) -> Tokenizer:
        from tokenizers import Tokenizer

        read = Tokenizer.from_file(self.file)
        read.encode_special_tokens = self.plain_text
        return read

    def __call__(self, text: str) -> list[int]:
        if self.uncommon(text) or self.literal(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def cut(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole sequences, then powers of two, longest first."""
    pieces = [(at, capacity) for at in range(0, tokens - capacity + 1, capacity)]
    at = len(pieces) * capacity
    size = capacity
    while at < tokens:
        if tokens - at >= size:
            pieces.append((at, size))
            at += size
        size //= 2
    return pieces


class Packer:
    """Bins of one task. A piece is (length, anything); full bins come back as (sequence number, [(offset, piece)])."""

    def __init__(self, capacity: int = CAPACITY) -> None:
        self.capacity, self.open, self.made = capacity, {}, 0

    def _close(self, pieces: list[tuple]) -> tuple[int, list[tuple[int, tuple]]]:
        placed, at = [], 0
        for piece in pieces:
            placed.append((at, piece))
            at += piece[0]
        self.made += 1
        return self.made - 1, placed

    def add(self, piece: tuple) -> list[tuple[int, list[tuple[int, tuple]]]]:
        waiting = self.open.setdefault(piece[0], [])
        waiting.append(piece)
        if len(waiting) < self.capacity // piece[0]:
            return []
        self.open[piece[0]] = []
        return [self._close(waiting)]

    def rest(self) -> list[tuple[int, list[tuple[int, tuple]]]]:
        """The open bins, longest pieces first: whole sequences, then one sequence per binary digit of the remainder."""
        left = [piece for size in sorted(self.open, reverse=True) for piece in self.open[size]]
        self.open = {}
        total = sum(piece[0] for piece in left)
        bins = [self.capacity] * (total // self.capacity) + [1 << b for b in reversed(range(self.capacity.bit_length())) if total % self.capacity >> b & 1]
        closed, at = [], 0
        for size in bins:
            filled, first = 0, at
            while filled < size:
                filled += left[at][0]
                at += 1
            closed.append(self._close(left[first:at]))
        return closed


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: (doc_id, start, ids as little-endian 32-bit numbers, length, doc_tokens, sequence_id, offset).

    ``capacity`` has to be a power of two. Sequence numbers are unique: the task's number, then a running one.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity has to be a power of two")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, packer = Encoder(vocabulary, ranks), Packer(capacity)
        base = TaskContext.get().partitionId() << 40
        columns: list[list] = [[] for _ in range(7)]
        held = 0

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            for c in columns:
                c.clear()
            return made

        def keep(closed: list) -> None:
            nonlocal held
            for number, placed in closed:
                for offset, (length, doc_id, start, ids, tokens) in placed:
                    for column, value in zip(columns, (doc_id, start, ids, length, tokens, base + number, offset)):
                        column.append(value)
                    held += len(ids) + 100

        for rows in batches:
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                ids = encode(text or "")
                ids.append(end)
                data, tokens = np.array(ids, "<u4"), len(ids)
                for start, length in cut(tokens, capacity):
                    keep(packer.add((length, doc_id, start, data[start : start + length].tobytes(), tokens)))
                if held > BYTES_PER_BATCH:
                    held = 0
                    yield batch()
        keep(packer.rest())
        yield batch()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
