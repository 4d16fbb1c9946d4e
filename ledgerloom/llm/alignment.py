"""Alignment of two tokenizers' tokens of one text by interval coalescing.

A text is written as tokens A (byte-level vocabulary, of the text with a space in front) and tokens B (piece vocabulary,
which adds that space itself). Both cut the same bytes, so every token is an interval. All tokens are sorted by start; a
running maximum of their ends shows where a group breaks: at each start that reaches it. A group holds the tokens of
both sides that overlap, directly or through others, and ends where an A and a B token end together. That pair of tokens
is a link; overlaps inside a group are expanded on request (``overlaps``).

How often an id pair is linked is counted over all documents. Of two tokens that end together the shorter one's bytes
are the end of the longer one's, so all pairs that can be linked follow from the two vocabularies: a list of a few
hundred thousand (``Vocabularies.pairs``), whatever the corpus. Every task counts in an array over that list, and the
summed counts, which the same list bounds, go back to the tasks that add them up per document.

Cases: a text that is null or empty, or whose joined A or B bytes differ from space and text (pieces that were
normalised), has no tokens and gets zeros; special tokens' strings are plain text; a null doc_id stays null; repeated
rows are aligned, and counted, each time; a text of any length is one row; ties for the highest count are all best; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.packing import Encoder
from ledgerloom.llm.tables import written

A_FILE, A_RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
B_FILE = "piece_bpe_32k.model"


class Entries:
    """The bytes of every entry of a vocabulary, in one array."""

    def __init__(self, entries: list[bytes]) -> None:
        self.entries = entries
        self.size = np.array([len(x) for x in entries], np.int64)
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.start = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of the entries one after another."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.arange(ends[-1]) + np.repeat(self.start[ids] - ends + size, size)].tobytes() if len(ids) else b""


class Vocabularies:
    """Both tokenizers, the bytes of every entry, and the id pairs that can be linked."""

    def __init__(self, a_file: str = A_FILE, a_ranks: str = A_RANKS, b_file: str = B_FILE) -> None:
        import public_tokenizers
        import sentencepiece

        self.encoder = Encoder(a_file, a_ranks, plain_text=True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b_file))
        self.a = Entries(sorted(self.encoder.ranks, key=self.encoder.ranks.get))
        pieces = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        self.b = Entries([bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids A and B of one text; none where the bytes do not come back."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        a, b = np.array(self.encoder(" " + text), np.int64), self.pieces.encode_as_numpy(text).astype(np.int64)
        data = b" " + text.encode()
        return (a, b) if self.a.joined(a) == data and self.b.joined(b) == data else none

    @cached_property
    def pairs(self) -> np.ndarray:
        """All (A id << 32 | B id) of which one is the end of the other, sorted."""
        by_a, by_b = {}, {}
        for known, entries in ((by_a, self.a.entries), (by_b, self.b.entries)):
            for i, data in enumerate(entries):
                known.setdefault(data, []).append(i)
        made = set()
        for data, ids in by_a.items():
            for cut in range(len(data)):
                made.update((a, b) for b in by_b.get(data[cut:], ()) for a in ids)
        for data, ids in by_b.items():
            for cut in range(len(data)):
                made.update((a, b) for a in by_a.get(data[cut:], ()) for b in ids)
        return np.sort(np.array([a << 32 | b for a, b in made], np.int64))

    @cached_property
    def written(self) -> list[str]:
        """Decimal ids with what follows them: A inside and at the end of its side of a group, then B the same."""
        a, b = range(len(self.a.entries)), range(len(self.b.entries))
        return [*(f"{i}," for i in a), *(f"{i}|" for i in a), *(f"{i}," for i in b), *(f"{i};" for i in b)]


def coalesce(a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, side, group, start, end) of the tokens of one text in order of groups, A before B, from their lengths in bytes."""
    ends = np.concatenate((np.cumsum(a_size), np.cumsum(b_size)))
    starts = ends - np.concatenate((a_size, b_size))
    token = np.concatenate((np.arange(len(a_size)), np.arange(len(b_size))))
    side = np.repeat(np.array([0, 1], np.int8), (len(a_size), len(b_size)))
    order = np.lexsort((ends, side, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.cumsum(breaks) - 1
    sides = np.lexsort((token[order], side[order], group))
    order, group = order[sides], group[sides]
    return token[order], side[order], group, starts[order], ends[order]


def links(token: np.ndarray, side: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A position, B position) of the tokens that end together."""
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    low, high = np.searchsorted(ends[b], ends[a], "left"), np.searchsorted(ends[b], ends[a], "right")
    count = high - low
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return token[np.repeat(a, count)], token[b[at]]


def overlaps(token: np.ndarray, side: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A position, B position) of the tokens that share a byte."""
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    low, high = np.searchsorted(ends[b], starts[a], "right"), np.searchsorted(starts[b], ends[a], "left")
    count = np.maximum(high - low, 0)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return token[np.repeat(a, count)], token[b[at]]


ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, linked binary"


def aligned(docs: DataFrame, a_file: str = A_FILE, a_ranks: str = A_RANKS, b_file: str = B_FILE, pairs: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, linked) of every row.

    ``linked`` names the pair of every link by its place in ``Vocabularies.pairs``, as little-endian 32-bit numbers, sorted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabularies(a_file, a_ranks, b_file).pairs if pairs is None else pairs)

    def run(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        known, pairs = Vocabularies(a_file, a_ranks, b_file), shared.value
        names = known.written.__getitem__
        # Where the four lists of ``written`` begin.
        begin = np.cumsum([0, *[len(known.a.entries)] * 2, len(known.b.entries)])
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        for batch in batches:
            columns: list[list] = [[] for _ in kinds]
            for text in batch.column(1).to_pylist():
                a, b = known.encode(text)
                if not len(a):
                    row = (0, 0, 0, 0, "", b"")
                else:
                    token, side, group, _, ends = coalesce(known.a.size[a], known.b.size[b])
                    ids = np.where(side == 0, a[np.where(side == 0, token, 0)], b[np.where(side == 1, token, 0)])
                    closes = np.ones(len(token), bool)
                    closes[:-1] = (side[1:] != side[:-1]) | (group[1:] != group[:-1])
                    shown = "".join(map(names, (ids + begin[2 * side + closes]).tolist()))
                    first, second = links(token, side, ends)
                    place = np.searchsorted(pairs, a[first] << 32 | b[second]).astype("<u4")
                    row = (len(a), len(b), int(group[-1]) + 1, len(first), sha256(shown[:-1].encode()).hexdigest(), np.sort(place).tobytes())
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], [x.split()[0] for x in ALIGNED.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ALIGNED)


def link_counts(found: DataFrame) -> DataFrame:
    """(place, n) of every id pair that is linked: its place in ``Vocabularies.pairs`` and how often."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for batch in batches:
            every = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")
            counts = np.bincount(every, minlength=len(total))
            counts[: len(total)] += total
            total = counts
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(total[place], pa.int64())], ["place", "n"])

    return found.select("linked").mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))


def counted_pairs(found: DataFrame, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, n, best) of ``link_counts`` with whether a count is the highest of its B id.

    There are at most as many as pairs that can be linked at all, so they fit everywhere.
    """
    counted = link_counts(found).toArrow()
    place, n = counted.column("place").to_numpy(), counted.column("n").to_numpy()
    b = pairs[place] & 0xFFFFFFFF
    most = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, b, n)
    return place, n, n == most[b]


def pair_counts(docs: DataFrame, a_file: str = A_FILE, a_ranks: str = A_RANKS, b_file: str = B_FILE) -> DataFrame:
    """(a, b, n, best): the id pairs linked in ``docs``, their count, and whether it is the highest of their B id."""
    import pyarrow as pa

    pairs = Vocabularies(a_file, a_ranks, b_file).pairs
    place, n, best = counted_pairs(aligned(docs, a_file, a_ranks, b_file, pairs), pairs)
    return docs.sparkSession.createDataFrame(pa.table({"a": pairs[place] >> 32, "b": pairs[place] & 0xFFFFFFFF, "n": n, "best": best}))


def digests(docs: DataFrame, a_file: str = A_FILE, a_ranks: str = A_RANKS, b_file: str = B_FILE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    pairs = Vocabularies(a_file, a_ranks, b_file).pairs
    found = written(aligned(docs, a_file, a_ranks, b_file, pairs), "alignments")
    place, n, highest = counted_pairs(found, pairs)
    counts, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    counts[place], best[place] = n, highest
    # As long as the list of pairs that can be linked, at most.
    shared = docs.sparkSession.sparkContext.broadcast((counts, best))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts, best = shared.value
        for batch in batches:
            rows = [np.frombuffer(x, "<u4") for x in batch.column(5).to_pylist()]
            sums = [pa.array([int(v[x].sum()) for x in rows], pa.int64()) for v in (best, counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *sums, batch.column(6)], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    read = found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "linked", "groups_sha256")
    return read.mapInArrow(run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
