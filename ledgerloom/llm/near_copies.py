"""Near duplicates by the Jaccard similarity of word shingles: candidates by bands, then an exact check.

A text is the set of its shingles of five words; two texts are near duplicates if their sets have a similarity of 0.8
or more. At that similarity 64-bit SimHash fingerprints differ in about ten bits, too many for buckets of equal bands,
so the candidates come from minima of hashed shingles: 64 of them, in ``BANDS`` bands of four. Two texts of similarity
0.8 agree on a band with a probability of 0.41 and miss each other in all with one of 0.0002.

Equal sets are merged before anything else. A bucket of more than ``block`` sets is cut into blocks whose pairs are
compared in separate groups, by the share of equal minima. In a group each set names the sets that are alike by that
estimate, at first the ``NAMED`` most alike if there are more, so the number of links does not grow with the square of a
group. Every named pair is checked with the shingles themselves before components are closed over what passes. If any
set had more to name, it names ``MORE`` times as many next, now only sets outside its component, until none has more:
then every pair that can be alike has been checked or lies inside one component, and no link is lost.

Cases: texts without words are alike; a text of fewer than five words is one shingle; null ids count as rows and are
never the smallest id unless a component has no other; repeated rows stay repeated; an empty table gives no rows;
other columns are passed on by ``keep_one`` and not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.simhash import keep_least, shingle_hashes
from ledgerloom.llm.tables import id_key, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 4
BLOCK = 1024
#: Partners a set names in one group of a bucket in the first round, and by how much that grows from round to round.
NAMED = 8
MORE = 16
#: Standard deviations of the estimate by which a pair may fall short of the similarity and is still checked.
SLACK = 4.0
MULTIPLIERS = np.random.default_rng(17).integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles, sorted; none for a text without words."""
    return np.unique(np.array(shingle_hashes(text, width), np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest shingle under each of the orders, as 32 bits."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at : at + 512, None] * MULTIPLIERS).min(0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def sketches(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, version, node, size, bands, sketch) of every row; ``node`` is a hash of the set of shingles."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            nodes, sizes, bands, marks = [], [], [], []
            for text in batch.column(2).to_pylist():
                hashes = shingle_set(text or b"", width)
                least = minima(hashes)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63))
                sizes.append(len(hashes))
                bands.append([xxhash.xxh64_intdigest(part.tobytes(), seed) - (1 << 63) for seed, part in enumerate(least.reshape(BANDS, ROWS))])
                marks.append(least.astype("<u2").tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "node", "size", "bands", "sketch"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("version"), F.col("text").cast("binary"))
    return texts.mapInArrow(run, "doc_id bigint, version bigint, node bigint, size int, bands array<bigint>, sketch binary")


def alike(
    marks: np.ndarray, sizes: np.ndarray, roots: np.ndarray, asks: np.ndarray, answers: np.ndarray, similarity: float, named: int
) -> tuple[np.ndarray, np.ndarray, bool]:
    """(asking, answering) rows of one group whose estimate and sizes allow the similarity, the ``named`` best of each; whether there are more.

    Rows of one root are linked already.
    """
    least = similarity - SLACK * (similarity * (1 - similarity) / marks.shape[1]) ** 0.5
    found, more = [], False
    step = max(1, (1 << 22) // max(1, len(answers) * marks.shape[1]))
    for at in range(0, len(asks), step):
        part = asks[at : at + step]
        share = (marks[part][:, None, :] == marks[answers][None, :, :]).mean(2)
        low, high = np.minimum(sizes[part][:, None], sizes[answers]), np.maximum(sizes[part][:, None], sizes[answers])
        share[(low < similarity * high - 1e-9) | (roots[part][:, None] == roots[answers])] = -1
        if len(answers) > named:
            more = more or bool(((share >= least).sum(1) > named).any())
            top = np.argpartition(-share, named - 1, axis=1)[:, :named]
        else:
            top = np.broadcast_to(np.arange(len(answers)), share.shape)
        which, nth = np.nonzero(np.take_along_axis(share, top, 1) >= least)
        found.append((part[which], answers[top[which, nth]]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]), more


def candidates(distinct: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK, named: int = NAMED) -> DataFrame:
    """(u, v) with u < v: pairs of the distinct sets ``distinct`` (node, size, bands, sketch, root) that have to be checked.

    Rows (0, null) say that sets had more than ``named`` sets of other roots to name.
    """
    keyed = distinct.where("size > 0").select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("shared_key"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    marked = keyed.join(shared, F.col("key") == F.col("shared_key")).select("key", "node", "blocks")
    marked = marked.join(distinct.select(F.col("node").alias("of"), "size", "sketch", "root"), F.col("node") == F.col("of"))
    cut = marked.select("key", "node", "size", "sketch", "root", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("side"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cut = cut.select("key", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"), "side", "node", "size", "sketch", "root")
    dealt = cut.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "side", "node")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def pairs(rows: list[np.ndarray]) -> pa.RecordBatch:
            key, a, b, side, node, size, sketch, root = rows
            new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            marks = np.frombuffer(b"".join(sketch), "<u2").reshape(len(sketch), -1)
            us, vs, more = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], False
            for low, high in zip(new.tolist(), [*new[1:].tolist(), len(key)]):
                if high - low < 2:
                    continue
                every = np.arange(high - low)
                if a[low] == b[low]:
                    sides = [(every, every)]
                else:
                    first = side[low:high] == a[low]
                    sides = [(every[first], every[~first]), (every[~first], every[first])]
                for asks, answers in sides:
                    if len(asks) and len(answers):
                        u, v, further = alike(marks[low:high], size[low:high], root[low:high], asks, answers, similarity, named)
                        more = more or further
                        us.append(node[low:high][u])
                        vs.append(node[low:high][v])
            u, v = np.concatenate(us), np.concatenate(vs)
            both = np.unique(np.stack((np.minimum(u, v), np.maximum(u, v)), 1), axis=0)
            said = ([0], [None]) if more else ([], [])
            return pa.RecordBatch.from_arrays([pa.array([*both[:, i].tolist(), *said[i]], pa.int64()) for i in (0, 1)], ["u", "v"])

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
                yield pairs([x[:whole] for x in rows])
        if held is not None and len(held[0]):
            yield pairs(held)

    return dealt.mapInArrow(run, "u bigint, v bigint").distinct()


def checked(pairs: DataFrame, docs: DataFrame, distinct: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (u, v) whose sets of shingles have the similarity, from the texts of the rows ``distinct`` (node, one) names."""
    asked = pairs.select(F.explode(F.array("u", "v")).alias("asked")).distinct()
    wanted = distinct.join(asked, F.col("node") == F.col("asked")).select(F.col("one.id").alias("id"), F.col("one.version").alias("version"))
    texts = docs.select(id_key(F.col("doc_id").cast("bigint")).alias("id"), F.xxhash64("text").alias("version"), F.col("text").cast("binary").alias("text"))
    texts = texts.join(wanted, ["id", "version"], "left_semi").dropDuplicates(["id", "version"])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for batch in batches:
            sets = [shingle_set(t or b"", width) for t in batch.column(0).to_pylist()]
            nodes = [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "shingles"])

    sets = written(texts.select("text").mapInArrow(run, "node bigint, shingles array<bigint>"), "shingle-sets")
    first, second = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    common = F.size(F.array_intersect("su", "sv"))
    both = pairs.join(first, "u").join(second, "v").select("u", "v", common.alias("common"), (F.size("su") + F.size("sv")).alias("total"))
    return both.where(F.col("common") >= F.lit(similarity) * (F.col("total") - F.col("common")) - 1e-9).select("u", "v")


def shared_links(made: DataFrame, also: DataFrame) -> DataFrame:
    """(u, v): links among the sets of rows that have the same ``part`` in ``also`` (doc_id, version, part)."""
    key = [id_key("doc_id").alias("id"), "version"]
    held = made.select(*key, "node").join(also.select(*key, "part").distinct(), ["id", "version"]).select("part", "node").distinct()
    first = held.groupBy(F.col("part").alias("of")).agg(F.min("node").alias("least"))
    return held.join(first, F.col("part") == F.col("of")).where("node > least").select(F.col("least").alias("u"), F.col("node").alias("v"))


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY, block: int = BLOCK, named: int = NAMED, also: DataFrame | None = None
) -> DataFrame:
    """(doc_id, version, root) of every row; rows of one root are one component. Rows of one ``part`` in ``also`` are linked as well."""
    made = written(sketches(docs, width), "sketches")
    distinct = made.groupBy("node").agg(F.min("size").alias("size"), F.min("bands").alias("bands"), F.min("sketch").alias("sketch"), F.min(F.struct(id_key("doc_id").alias("id"), "version")).alias("one"))
    distinct = written(distinct, "distinct-sketches").withColumn("root", F.col("node"))
    bare, links = distinct, None if also is None else shared_links(made, also)
    while True:
        named_pairs = written(candidates(distinct, similarity, block, named), "candidates")
        passed = checked(named_pairs.where("v is not null"), docs, bare, width, similarity)
        links = passed if links is None else links.unionByName(passed)
        links = written(links, "near-links")
        found = components(links).select(F.col("node").alias("of"), F.col("root").alias("least"))
        if named_pairs.where("v is null").isEmpty():
            break
        named *= MORE
        distinct = bare.join(found, F.col("node") == F.col("of"), "left").withColumn("root", F.coalesce("least", "node")).select(*bare.columns)
    joined = made.select("doc_id", "version", "node").join(found, F.col("node") == F.col("of"), "left")
    return joined.select("doc_id", "version", F.coalesce("least", "node").alias("root"))


def keep_one(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY, also: DataFrame | None = None) -> DataFrame:
    """``docs``, with all columns, with one row of each component: its smallest id, and of that the text with the smallest hash."""
    return keep_least(docs, near_duplicates(docs, width, similarity, also=also))
