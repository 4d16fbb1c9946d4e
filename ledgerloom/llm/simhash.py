"""SimHash near duplicates by bit-sliced comparison.

Documents become 64-bit fingerprints of their word shingles. Two fingerprints with at most two differing bits agree
on at least two of four 16-bit bands, so every pair of bands is a bucket key, and pairs that share no bucket are
never compared. Inside a bucket the fingerprints stand vertically: bit plane b holds bit b of 64 fingerprints in one
word. A fingerprint is compared with a word's 64 at once: each plane's differences are added to counters that are
bit planes themselves, by carry-save steps, and a word is abandoned once all its counters are over the radius.

Equal fingerprints are merged before anything else. A bucket of more than ``block`` fingerprints is cut into blocks,
and its pairs of blocks are compared in separate groups, so no task gets an unbounded group. A group returns one link
per fingerprint at most (to the smallest of its part), not all pairs. Components are closed over the links.

Cases: a null or empty text, or one of white space only, has the fingerprint zero and links like any other; null ids
count as rows and are never the smallest id unless a component has no other; repeated rows stay repeated; an empty
table gives no rows; other columns are passed on by ``keep_one`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.tables import id_key, written

SHINGLE = 3
SEED = 42
RADIUS = 2
BANDS = 4
BLOCK = 4096
#: Words of 64 comparisons that are carried at once.
CARRIED = 1 << 16


def shingle_hashes(text: bytes, width: int = SHINGLE) -> list[int]:
    """A hash of every shingle of UTF-8 text; a text of fewer words is one shingle, one without words has none."""
    import xxhash

    words = text.lower().split()
    if not words:
        return []
    digest, line = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) < width:
        return [digest(line, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-width])).tolist() if len(words) > width else [0]
    return [digest(line[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of UTF-8 text."""
    hashes = shingle_hashes(text, width)
    if not hashes:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, version, fp) of every row; ``version`` is a hash of the text."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = pa.array([fingerprint(t or b"", width) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], ["doc_id", "version", "fp"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("version"), F.col("text").cast("binary"))
    return texts.mapInArrow(run, "doc_id bigint, version bigint, fp bigint")


def _over(ones: np.ndarray, twos: np.ndarray, more: np.ndarray, radius: int) -> np.ndarray:
    return more | (ones | twos, twos, ones & twos, np.zeros_like(ones))[radius]


def close_pairs(queries: np.ndarray, of: np.ndarray, planes: np.ndarray, valid: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``queries``, lane) of the lanes within ``radius``. Query i is compared with word ``of[i]`` of the planes."""
    at = np.arange(len(queries))
    words, ones = of, np.zeros(len(queries), np.uint64)
    twos, more = ones.copy(), ones.copy()
    for first in range(0, 64, 8):
        for bit in range(first, first + 8):
            differ = planes[bit][words] ^ (np.uint64(0) - ((queries >> np.uint64(bit)) & np.uint64(1)))
            carry = ones & differ
            ones ^= differ
            more |= twos & carry
            twos ^= carry
        alive = valid[words] & ~_over(ones, twos, more, radius)
        left = alive != 0
        if not left.all():
            at, words, queries, ones, twos, more, alive = (x[left] for x in (at, words, queries, ones, twos, more, alive))
        if not len(at):
            return at, at
    which, lane = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return at[which], words[which] * 64 + lane


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` with the sets of a[i] and b[i] joined; every entry points at the smallest row of its set."""
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        apart = low != high
        if not apart.any():
            return parent
        a, b = a[apart], b[apart]
        np.minimum.at(parent, high[apart], low[apart])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def local_roots(group: np.ndarray, side: np.ndarray, crossed: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows sorted by group, the first row of the part each row is linked to.

    In a ``crossed`` group only rows of different sides are compared, the first side with the second.
    """
    n = len(group)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, n))
    of_row = np.repeat(np.arange(len(first)), size)
    asks = np.where(crossed, side == side[first][of_row], True)
    answers = np.where(crossed, ~asks, True)
    targets = np.flatnonzero(answers & (size[of_row] > 1))
    asking = np.flatnonzero(asks & (size[of_row] > 1))
    parent = np.arange(n)
    if not len(targets) or not len(asking):
        return parent
    per_group = np.bincount(of_row[targets], minlength=len(first))
    words = -(-per_group // 64)
    word_at = np.concatenate(([0], np.cumsum(words)))
    rank = np.arange(len(targets)) - np.concatenate(([0], np.cumsum(per_group)))[of_row[targets]]
    lane = word_at[of_row[targets]] * 64 + rank
    lanes = int(word_at[-1]) * 64
    row_of = np.zeros(lanes, np.int64)
    row_of[lane] = targets
    flags = np.zeros(lanes, np.uint8)
    flags[lane] = 1
    valid = np.packbits(flags, bitorder="little").view(np.uint64)
    bits = fp.view(np.uint64)
    planes = np.zeros((64, len(valid)), np.uint64)
    for bit in range(64):
        flags[lane] = (bits[targets] >> np.uint64(bit)) & np.uint64(1)
        planes[bit] = np.packbits(flags, bitorder="little").view(np.uint64)
    # compared pair by pair of (row, word), a bounded number at a time
    often = words[of_row[asking]]
    ends = np.cumsum(often)
    at = 0
    while at < len(asking):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CARRIED, "right")))
        rows, times = asking[at:upto], often[at:upto]
        ask = np.repeat(rows, times)
        within = np.arange(len(ask)) - np.repeat(np.cumsum(times) - times, times)
        which, hit = close_pairs(bits[ask], word_at[of_row[ask]] + within, planes, valid, radius)
        parent = _merge(parent, ask[which], row_of[hit])
        at = upto
    return parent


def bucket_links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(u, v): links among the distinct fingerprints ``prints`` (fp) that connect what lies within ``radius``."""
    width = 64 // BANDS
    parts = [F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(BANDS)]
    pairs = list(combinations(range(BANDS), BANDS - radius))
    keys = F.array(*[F.concat_ws(":", F.lit(t), *[parts[i] for i in chosen]) for t, chosen in enumerate(pairs)])
    keyed = prints.select("fp", F.explode(F.transform(keys, lambda k: F.xxhash64(k))).alias("key"))
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block).select(F.col("key").alias("large_key"), F.ceil(F.col("n") / block).alias("blocks"))
    marked = keyed.join(large, F.col("key") == F.col("large_key"), "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    cut = marked.select("key", "fp", F.coalesce(own, F.lit(0)).alias("side"), F.explode(others).alias("other"))
    cut = cut.select("key", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"), "side", "fp")
    dealt = cut.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "side", "fp")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def links(rows: list[np.ndarray]) -> pa.RecordBatch:
            key, a, b, side, fp = rows
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            roots = local_roots(np.cumsum(new), side, a != b, fp, radius)
            linked = np.flatnonzero(fp[roots] != fp)
            return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[roots[linked]])], ["u", "v"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            if not len(rows[0]):
                continue
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]) | (rows[2] != rows[2][-1]))
            whole = int(last[-1]) + 1 if len(last) else 0
            held = [x[whole:] for x in rows]
            if whole:
                yield links([x[:whole] for x in rows])
        if held is not None and len(held[0]):
            yield links(held)

    return dealt.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(doc_id, version, fp, component_id, root) of every row; ``root`` is the smallest fingerprint of the component."""
    prints = written(fingerprints(docs, width), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    found = components(bucket_links(distinct.select("fp"), radius, block))
    members = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    firsts = members.join(distinct, F.col("node") == F.col("fp")).select("node", "root", "first")
    least = firsts.groupBy(F.col("root").alias("of")).agg(F.min("first").alias("smallest"))
    linked = firsts.join(least, F.col("root") == F.col("of")).select("node", "root", "smallest")
    named = distinct.join(linked, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("named_fp"), F.coalesce("smallest", "first").alias("component_id"), F.coalesce("root", "fp").alias("root"))
    # Written, so that both sides of the join come straight from a shuffle and a fingerprint of very many copies can be split.
    named = written(named, "named-fingerprints")
    return prints.join(named, F.col("fp") == F.col("named_fp")).select("doc_id", "version", "fp", "component_id", "root")


def keep_least(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs``, with all columns, with one row of each root of ``found`` (doc_id, version, root): the smallest id, and of that the smallest version."""
    # null ids come last: a component without any other has one of them
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), id_key("doc_id").alias("id"), "version")
    kept = found.groupBy("root").agg(F.min(order).alias("one")).select(F.col("one.id").alias("__id"), F.col("one.version").alias("__version")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), id_key("doc_id").alias("__id"), F.xxhash64("text").alias("__version"))
    one = keyed.join(kept, ["__id", "__version"], "left_semi").dropDuplicates(["__id", "__version"])
    return one.select("__row.*")


def keep_one(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs``, with all columns, with one row of each component: its smallest id, and of that the text with the smallest hash."""
    return keep_least(docs, near_duplicates(docs, width, radius).select("doc_id", "version", "root"))


def digests(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
