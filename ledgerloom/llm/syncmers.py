"""Document fingerprints from closed syncmers.

A text is its words between white space. Of all runs of ``K`` words those are anchors whose smallest inner run of ``S``
words, by hash, is the first or the last one. Whether a run is an anchor depends on its own words alone: the same
passage has the same anchors in every text, wherever it stands, so anchors of two texts can be matched by position
(``shared_anchors``). At least one of any ``K - S + 1`` neighbouring runs is an anchor.

A fingerprint is the ``SIZE`` smallest different anchor hashes, as hexadecimal digits; it is taken over the whole text. The
likeness of two fingerprints is the share of both texts' anchors that are common (twice the common ones by all of both),
estimated from the smallest hashes of the two together and exact for texts of up to ``SIZE`` anchors.

``followed`` compares each document with the next one in descending order of doc_id. The order is found by one
range-partitioned sort of (id, hash of the text) and prefix sums; each text is shuffled once, and of the next text only
the part that is used. Everything runs in SQL functions.

Cases: a null text is an empty one; a text without words has an empty fingerprint, alike only to another empty one; a
text of fewer than ``K`` words has one anchor, all its words; a null doc_id stands after all others and stays null; of
rows with one doc_id the text with the smaller hash comes first; rows equal in doc_id and text are one document and each
has its result; a single document is followed by itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.numbering import number_sorted
from ledgerloom.llm.tables import NO_ID, id_key

K, S = 5, 2
SIZE = 64
SPACE = " \t\n\x0b\f\r"


def word_hashes(text: Column) -> Column:
    """A hash of each word."""
    trimmed = F.trim(text, F.lit(SPACE))
    words = F.split(trimmed, f"[{SPACE}]+", -1)
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(F.transform(words, lambda w: F.xxhash64(w)))


def anchor_places(hashes: Column, k: int = K, s: int = S) -> Column:
    """Places (from 0) of the runs of ``k`` words that are closed syncmers; ``hashes`` should be a plain column."""
    inner = F.transform(F.sequence(F.lit(0), F.size(hashes) - s), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(s)]))
    bound = F.transform(F.array(inner), lambda g: F.filter(
        F.sequence(F.lit(0), F.size(hashes) - k),
        lambda i: F.least(F.get(g, i), F.get(g, i + (k - s))) <= (F.least(*[F.get(g, i + j) for j in range(1, k - s)]) if k - s > 2 else F.get(g, i + 1)),
    ))
    whole = F.array(F.lit(0))
    return F.when(F.size(hashes) >= k, F.get(bound, 0)).when(F.size(hashes) > 0, whole).otherwise(F.array().cast("array<int>"))


def anchor_hashes(hashes: Column, k: int = K, s: int = S) -> Column:
    """The 32-bit hashes of the anchors in order."""
    return F.transform(anchor_places(hashes, k, s), lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(hashes, i + 1, k)), 32))


def anchors(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """``docs`` with ``anchors``: an array of (place, hash), places counted in words from 0."""
    hashed = docs.withColumn("__hashes", word_hashes(F.coalesce("text", F.lit(""))))
    found = F.arrays_zip(anchor_places(F.col("__hashes"), k, s).alias("place"), anchor_hashes(F.col("__hashes"), k, s).alias("hash"))
    return hashed.withColumn("anchors", found).select(*docs.columns, "anchors")


def shared_anchors(a: Column, b: Column) -> Column:
    """(place in a, place in b) of every anchor of ``a`` that ``b`` has too, at its first place there."""
    first = F.transform(a, lambda x: F.struct(x["place"].alias("a"), F.array_position(F.transform(b, lambda y: y["hash"]), x["hash"]).alias("at")))
    return F.transform(F.filter(first, lambda x: x["at"] > 0), lambda x: F.struct(x["a"].alias("a"), F.get(b, (x["at"] - 1).cast("int"))["place"].alias("b")))


def smallest(hashes: Column, k: int = K, s: int = S, size: int = SIZE) -> Column:
    """The smallest different anchor hashes, sorted."""
    return F.slice(F.sort_array(F.array_distinct(anchor_hashes(hashes, k, s))), 1, size)


def shown(values: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits a hash."""
    return F.array_join(F.transform(values, lambda v: F.lpad(F.lower(F.hex(v)), 8, F.lit("0"))), "")


def likeness(a: Column, b: Column, size: int = SIZE) -> Column:
    """Share of common anchors of two texts from their smallest hashes, 0 to 1."""
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    common = F.size(F.array_intersect(F.array_intersect(least, a), b))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(2.0 * common / (common + F.size(least)))


def fingerprints(docs: DataFrame, k: int = K, s: int = S, size: int = SIZE) -> DataFrame:
    """``docs`` with ``fingerprint``."""
    hashed = docs.withColumn("__hashes", word_hashes(F.coalesce("text", F.lit(""))))
    return hashed.withColumn("fingerprint", shown(smallest(F.col("__hashes"), k, s, size))).select(*docs.columns, "fingerprint")


def successors(keyed: DataFrame) -> DataFrame:
    """(id, version, before, before_version, take): whom each document follows, and how many of its first code points that one takes."""
    distinct = keyed.groupBy("id", "version").agg(F.max("n_chars").alias("n_chars"))
    placed = number_sorted(distinct, [F.col("id").desc(), F.col("version")], name="place")
    last = placed.agg(F.max("place").alias("last"))
    # One row.
    before = placed.join(F.broadcast(last)).select(
        F.when(F.col("place") == F.col("last"), 1).otherwise(F.col("place") + 1).alias("place"),
        F.col("id").alias("before"), F.col("version").alias("before_version"), F.floor(F.col("n_chars") / 3).cast("int").alias("take"))
    return placed.select("id", "version", "place").join(before, "place").drop("place")


def followed(docs: DataFrame, k: int = K, s: int = S, size: int = SIZE) -> DataFrame:
    """(doc_id, text, edited, smallest, edited_smallest, next_smallest) of every row.

    ``edited`` is the text with its last third replaced by the beginning of the next document's text.
    """
    texts = docs.select(id_key(F.col("doc_id").cast("bigint")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.withColumn("version", F.xxhash64("text"))
    follows = successors(keyed.select("id", "version", F.char_length("text").alias("n_chars")))
    printed = keyed.withColumn("hashes", word_hashes(F.col("text"))).withColumn("smallest", smallest(F.col("hashes"), k, s, size)).drop("hashes")
    # Both sides read one shuffle of the texts.
    dealt = printed.repartition("id", "version")
    heads = dealt.join(follows, ["id", "version"]).select("before", "before_version", F.expr("left(text, take)").alias("head"), F.col("smallest").alias("next_smallest"))
    heads = heads.dropDuplicates(["before", "before_version"]).withColumnsRenamed({"before": "id", "before_version": "version"})
    kept = F.expr("left(text, char_length(text) - char_length(text) div 3)")
    both = dealt.join(heads, ["id", "version"]).withColumn("edited", F.concat(kept, "head")).withColumn("hashes", word_hashes(F.col("edited")))
    return both.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "text", "edited", "smallest", smallest(F.col("hashes"), k, s, size).alias("edited_smallest"), "next_smallest")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    return followed(docs).select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        shown(F.col("smallest")).alias("fingerprint"), shown(F.col("edited_smallest")).alias("edited_fingerprint"),
        likeness(F.col("smallest"), F.col("edited_smallest")).alias("near_edited"), likeness(F.col("smallest"), F.col("next_smallest")).alias("near_next"),
    )
