"""Benchmark passages in documents, up to edits.

Texts are compared as words (letters and digits, lower-cased). The CGK embedding walks through a word sequence with a
random walk: at step j it writes the current word and moves on or stays, by a random bit drawn for (j, word). Two
sequences a few edits apart fall into step again after each edit, so their embeddings differ in few places: edit
distance becomes Hamming distance, and sampling places of the embedding is a locality-sensitive hash. Each of
``REPEATS`` repetitions has its own walk and its own sampled places.

An item is indexed from several places inside it (``STRIDE`` words apart), and the walk starts at every word of a
document, so an edit spoils only the places it touches: a passage is found if one of its stretches samples alike in one
repetition. A hit names an item and the item-sized window it would fill; the window is verified by the exact edit
distance, with free ends for what stands around the passage. A document holds an item if at most ``1 - similarity`` of
the item's words have to be edited.

Items of fewer than ``SHORT`` words are looked up by pieces: an item that may have k edits is cut into k + 1 pieces, and
one of them stands unedited in whatever matches, so all of these items are found.

Hits of one item that lie close together are verified by one window that holds the windows of all of them.

The benchmark is read in blocks of a bounded number of words, one pass over the documents per block, so what is sent to
the tasks has a bound whatever its size. Repeats of an item are indexed once, with their number, and unfolded in the
found rows. Documents are not shuffled.

Cases: null or empty texts hold nothing; items without words match nothing; an item of fewer than five words is
held only without edits, so a match of a few words is possible only for an item of a few words; repeated documents
and items are each reported; null ids are reported as null; empty tables give no rows; other columns are passed on by
``drop_contaminated`` and not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

WORD = r"\w+"
SIMILARITY = 0.8
REPEATS = 6
STEPS = 14
SAMPLED = 6
STRIDE = 2
#: Items of fewer words are found by unedited pieces instead of walks. At least ``STEPS``, as walks stay inside items.
SHORT = 24
#: Bound on the words of a block of items.
WORDS_PER_BLOCK = 2_000_000
#: Words of documents that are walked at once.
WORDS_PER_WALK = 1 << 18


def mixed(x: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = np.asarray(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chains(words: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first one, two, ... words."""
    made, chain = [], np.uint64(0)
    for word in words.astype(np.uint64):
        chain = mixed(np.array([chain + word], np.uint64))[0]
        made.append(chain)
    return made


@dataclass
class Repetition:
    """One walk: ``moves[j, w]`` is whether word w moves the walk on at step j; ``places`` are the sampled steps."""

    moves: np.ndarray
    places: list[int]
    keys: list[np.ndarray] = field(default_factory=list)
    owners: np.ndarray | None = None
    starts: np.ndarray | None = None


def repetitions(n_words: int, repeats: int, steps: int, sampled: int, seed: int) -> list[Repetition]:
    random = np.random.default_rng(seed)
    made = []
    for _ in range(repeats):
        places = sorted([0, *(random.choice(np.arange(1, steps), sampled - 1, replace=False)).tolist()])
        made.append(Repetition(random.integers(0, 2, (steps, n_words + 2), dtype=np.int8), places))
    return made


class Index:
    """Items of a block, their words numbered from 1 (0 is any other word), and the sampled embeddings of their stretches."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float, repeats: int, steps: int, sampled: int, stride: int, seed: int = 11, times: list[int] | None = None) -> None:
        self.similarity, self.steps = similarity, steps
        self.words: dict[str, int] = {}
        #: Per item its id, its words and how often the benchmark repeats it.
        self.ids, self.items, self.times = [], [], []
        for (item_id, text), n in zip(items, times or [1] * len(items)):
            found = re.findall(WORD, (text or "").lower())
            if found:
                self.ids.append(item_id)
                self.times.append(n)
                self.items.append(np.array([self.words.setdefault(w, len(self.words) + 1) for w in found], np.int32))
        self.sets = [frozenset(item.tolist()) for item in self.items]
        self.end = len(self.words) + 1
        self.walks = repetitions(len(self.words), repeats, steps, sampled, seed) if self.items else []
        flat, owner, start, first = [], [], [], []
        at = 0
        self._index_pieces()
        for i, item in enumerate(self.items):
            if len(item) < SHORT:
                continue
            flat.append(np.concatenate((item, np.full(steps, self.end, np.int32))))
            last = max(0, len(item) - steps)
            begins = sorted({*range(0, last + 1, stride), last})
            owner += [i] * len(begins)
            start += begins
            first += [at + b for b in begins]
            at += len(item) + steps
        if not flat:
            self.walks = []
            return
        flat, first = np.concatenate(flat), np.array(first)
        self.owner, self.start = np.array(owner), np.array(start)
        self.begins = np.zeros(len(self.words) + 2, bool)
        self.begins[flat[first]] = True
        for walk in self.walks:
            at, chain = first.copy(), np.zeros(len(first), np.uint64)
            order = np.arange(len(first))
            for j in range(steps):
                if j in walk.places:
                    chain = mixed(chain + flat[at].astype(np.uint64))
                    walk.keys.append(np.unique(chain))
                at = at + walk.moves[j, flat[at]]
            order = np.argsort(chain, kind="stable")
            walk.owners, walk.starts, walk.keys[-1] = self.owner[order], self.start[order], chain[order]

    def _index_pieces(self) -> None:
        """Pieces of the short items, one more than an item may have edits: one of them stands unedited in every match."""
        found: list[tuple[int, int, int, np.ndarray]] = []
        for i, item in enumerate(self.items):
            if len(item) < SHORT:
                cuts = np.linspace(0, len(item), self.allowed(i) + 2).astype(int)
                found += [(int(chains(item[a:b])[-1]), i, int(a), item[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        longest = max((len(piece) for *_, piece in found), default=0)
        self.prefixes = [np.unique(np.array([chains(piece)[m] for *_, piece in found if len(piece) > m], np.uint64)) for m in range(longest)]
        self.pieces = []
        for m in range(1, longest + 1):
            of = sorted((key, i, at) for key, i, at, piece in found if len(piece) == m)
            self.pieces.append((np.array([x[0] for x in of], np.uint64), np.array([x[1] for x in of], np.int64), np.array([x[2] for x in of], np.int64)))

    def _piece_hits(self, words: np.ndarray) -> Iterator[np.ndarray]:
        begin = np.arange(len(words) - self.steps)
        chain = np.zeros(len(begin), np.uint64)
        for m, (prefixes, (keys, owners, offsets)) in enumerate(zip(self.prefixes, self.pieces)):
            inside = begin + m < len(words)
            begin, chain = begin[inside], chain[inside]
            chain = mixed(chain + words[begin + m].astype(np.uint64))
            alike = prefixes[np.minimum(np.searchsorted(prefixes, chain), len(prefixes) - 1)] == chain
            begin, chain = begin[alike], chain[alike]
            low = np.searchsorted(keys, chain, "left")
            times = np.searchsorted(keys, chain, "right") - low
            entry = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
            yield np.stack((owners[entry], np.repeat(begin, times) - offsets[entry]), 1)

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, window start) for a run of word numbers that ends in ``steps`` ends; starts may lie before the run."""
        found = list(self._piece_hits(words))
        seeds = np.flatnonzero(self.begins[words[: len(words) - self.steps]]) if self.walks else np.zeros(0, np.int64)
        for walk in self.walks:
            at, begin, chain = seeds, seeds, np.zeros(len(seeds), np.uint64)
            nth = 0
            for j in range(walk.places[-1] + 1):
                here = words[at]
                if j in walk.places:
                    chain = mixed(chain + here.astype(np.uint64))
                    keys = walk.keys[nth]
                    spot = np.minimum(np.searchsorted(keys, chain), len(keys) - 1)
                    alike = keys[spot] == chain
                    at, begin, chain, here = at[alike], begin[alike], chain[alike], here[alike]
                    nth += 1
                    if not len(at):
                        break
                at = at + walk.moves[j, here]
            if len(at):
                low = np.searchsorted(walk.keys[-1], chain, "left")
                times = np.searchsorted(walk.keys[-1], chain, "right") - low
                entry = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
                found.append(np.stack((walk.owners[entry], np.repeat(begin, times) - walk.starts[entry]), 1))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(found), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def allowed(self, item: int) -> int:
        return int((1 - self.similarity) * len(self.items[item]) + 1e-9)


def edits(item: np.ndarray, window: np.ndarray) -> int:
    """Least edits that turn ``item`` into a stretch of ``window``: insertions, deletions and substitutions of words."""
    n = len(window)
    steps = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for i, word in enumerate(item, 1):
        near = np.empty(n + 1, np.int64)
        near[0] = i
        near[1:] = np.minimum(row[:-1] + (window != word), row[1:] + 1)
        row = np.minimum.accumulate(near - steps) + steps
    return int(row.min())


def matches(index: Index, texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
    """(text number, item number, edits) of the items that texts hold; the window with the fewest edits counts."""
    if not index.items:
        return
    known, end, steps = index.words.get, index.end, index.steps
    find = re.compile(WORD).findall

    def walked(chunk: list[tuple[int, list[str]]]) -> Iterator[tuple[int, int, int]]:
        runs, bounds = [], [0]
        for _, words in chunk:
            runs.append(np.fromiter((known(w, 0) for w in words), np.int32, len(words)))
            runs.append(np.full(steps, end, np.int32))
            bounds.append(bounds[-1] + len(words) + steps)
        flat, starts = np.concatenate(runs), np.array(bounds)
        best: dict[tuple[int, int], int] = {}
        done: dict[tuple[int, int], list[int]] = {}
        for item, at in zip(*(x.tolist() for x in index.candidates(flat))):
            slack = index.allowed(item)
            # a window looked at reaches far enough to hold those of all hits at most this far away
            near = slack // 2 if len(index.items[item]) >= SHORT else 0
            # a start before the run belongs to the document its hit lies in
            doc = int(np.searchsorted(starts, min(max(at, 0) + len(index.items[item]) - 1, len(flat) - 1), "right")) - 1
            for d in {int(np.searchsorted(starts, max(at, 0), "right")) - 1, doc}:
                if best.get((d, item)) == 0 or any(abs(at - seen) <= near for seen in done.get((d, item), ())):
                    continue
                low, high = starts[d], starts[d + 1] - steps
                window = flat[max(low, at - slack - near) : max(0, min(high, at + len(index.items[item]) + slack + near))]
                if not len(window):
                    continue
                done.setdefault((d, item), []).append(at)
                # every word of the item that the window lacks takes an edit
                if len(index.sets[item].difference(window.tolist())) > slack:
                    continue
                cost = edits(index.items[item], window)
                if cost <= slack and cost < best.get((d, item), slack + 1):
                    best[d, item] = cost
        for (d, item), cost in sorted(best.items()):
            yield chunk[d][0], item, cost

    chunk, size = [], 0
    for number, text in enumerate(texts):
        words = find((text or "").lower())
        if words:
            chunk.append((number, words))
            size += len(words)
        if size > WORDS_PER_WALK:
            yield from walked(chunk)
            chunk, size = [], 0
    if chunk:
        yield from walked(chunk)


def indexes(benchmark: DataFrame, similarity: float = SIMILARITY, words_per_block: int = WORDS_PER_BLOCK, **walk: int) -> Iterator[Index]:
    """The benchmark's items in blocks of about ``words_per_block`` words."""
    walk = {"repeats": REPEATS, "steps": STEPS, "sampled": SAMPLED, "stride": STRIDE} | walk
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("times"))
    words = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-words // (6 * words_per_block)) or 1
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(((r["item_id"], r["text"], r["times"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield Index([r[:2] for r in rows], similarity, times=[r[2] for r in rows], **walk)


def contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, **walk: int) -> DataFrame:
    """(doc_id, item_id, edits, item_words) of every row of ``docs`` and every item it holds."""
    schema = "doc_id bigint, item_id bigint, edits int, item_words int, times bigint"
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = None
    for index in indexes(benchmark, similarity, **walk):
        def run(batches: Iterator, index: Index = index) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                rows = list(matches(index, batch.column(1).to_pylist()))
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([index.ids[r[1]] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()),
                    pa.array([len(index.items[r[1]]) for r in rows], pa.int32()), pa.array([index.times[r[1]] for r in rows], pa.int64()),
                ], ["doc_id", "item_id", "edits", "item_words", "times"])

        part = texts.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found.select("doc_id", "item_id", "edits", "item_words", F.explode(F.sequence(F.lit(1), "times"))).drop("col")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, **walk: int) -> DataFrame:
    """``docs``, with all columns, without the rows that hold an item."""
    at = docs.columns.index("text")
    for index in indexes(benchmark, similarity, **walk):
        def run(batches: Iterator, index: Index = index) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[r[0] for r in matches(index, batch.column(at).to_pylist())]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
