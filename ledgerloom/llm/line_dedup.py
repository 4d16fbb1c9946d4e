"""Lines that repeat across documents, as keep bitmaps.

A line's key is the line without white space at its ends, A-Z lower-cased. A key of ``min_chars`` code points or
more that ``min_docs`` documents or more hold is boilerplate: all its lines go, but those of the document with the
largest id that holds it.

The keys travel as 128-bit hashes, never as text. Equal keys of one document are merged first, then keys are counted
per slice of documents, so that a key which a third of all documents hold is a few rows when it is range-partitioned
by hash and sorted by document; reading each range in order, the first row of a hash is its first occurrence, and the
counts that follow it decide whether the key is boilerplate. The result is a bitmap per document, compressed to the
runs of dropped lines; documents that lose nothing have no row. Text is read again only where the bitmaps are applied.

Cases: a null or empty text is one empty line; lines of white space only are short and stay; a null doc_id is a
document smaller than all others; rows that share a doc_id are one document for the counts and keep their own
bitmaps; an empty table gives an empty result; other columns are passed on by ``drop_lines`` and not read elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.tables import ascii_lower, id_key, written

MIN_CHARS = 40
MIN_DOCS = 5
SPACE = " \t\n\x0b\f\r"
#: Slices of documents in which a key is counted before its rows meet.
SLICES = 32


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, version, pos, h1, h2) of every line with a key that is long enough; ``version`` tells rows of one id apart."""
    keys = F.transform(split_lines(F.col("text")), lambda line, i: F.struct(i.alias("pos"), ascii_lower(F.trim(line, F.lit(SPACE))).alias("key")))
    long_ones = F.filter(keys, lambda x: F.length(x["key"]) >= min_chars)
    hashes = F.transform(long_ones, lambda x: F.struct(x["pos"].alias("pos"), F.xxhash64(x["key"]).alias("h1"), F.xxhash64(F.lit(1), x["key"]).alias("h2")))
    rows = docs.select(id_key("doc_id").alias("doc"), F.xxhash64("text").alias("version"), F.explode(hashes).alias("line"))
    return rows.select("doc", "version", "line.pos", "line.h1", "line.h2")


def boilerplate(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, holder) of the keys that enough documents hold; ``holder`` is the document that keeps its lines."""
    slices = lines.select("h1", "h2", "doc").distinct().groupBy("h1", "h2", F.pmod(F.xxhash64("doc"), F.lit(SLICES)).alias("slice"))
    counted = slices.agg(F.count("*").alias("docs"), F.max("doc").alias("doc"))
    ranges = counted.repartitionByRange("h1", "h2")
    ordered = Window.partitionBy("h1", "h2").orderBy(F.col("doc").desc())
    whole = Window.partitionBy("h1", "h2")
    first = ranges.select("h1", "h2", "doc", F.row_number().over(ordered).alias("nth"), F.sum("docs").over(whole).alias("all_docs"))
    return first.where((F.col("nth") == 1) & (F.col("all_docs") >= min_docs)).select("h1", "h2", F.col("doc").alias("holder"))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, version, n_dropped, runs) of documents that lose lines; ``runs`` are (first, length) of dropped lines in order."""
    lines = written(line_keys(docs, min_chars), "line-keys")
    repeated = boilerplate(lines, min_docs).withColumnsRenamed({"h1": "k1", "h2": "k2"})
    same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    dropped = lines.join(repeated, same).where("doc <> holder").select("doc", "version", "pos").distinct()
    nth = F.row_number().over(Window.partitionBy("doc", "version").orderBy("pos"))
    islands = dropped.withColumn("island", F.col("pos") - nth).groupBy("doc", "version", "island").agg(F.min("pos").alias("first"), F.count("*").cast("int").alias("length"))
    run = F.struct("first", "length")
    return islands.groupBy("doc", "version").agg(F.sum("length").alias("n_dropped"), F.sort_array(F.collect_list(run)).alias("runs"))


def kept_text(text: Column, runs: Column) -> Column:
    """``text`` without the lines of ``runs``; null runs keep all of it."""
    lines = split_lines(text)
    flags = F.flatten(F.transform(runs, lambda r, i: F.concat(
        F.array_repeat(F.lit(True), r["first"] - F.when(i > 0, F.get(runs, i - 1)["first"] + F.get(runs, i - 1)["length"]).otherwise(0)),
        F.array_repeat(F.lit(False), r["length"]),
    )))
    kept = F.filter(F.arrays_zip(lines.alias("line"), flags.alias("keep")), lambda x: F.coalesce(x["keep"], F.lit(True)))
    return F.when(runs.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))


def with_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``__runs`` and ``__n_dropped``, null where a document keeps all its lines."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc").alias("__doc"), F.col("version").alias("__version"), F.col("n_dropped").alias("__n_dropped"), F.col("runs").alias("__runs")
    )
    return docs.join(bitmaps, (id_key(docs["doc_id"]) == F.col("__doc")) & (F.xxhash64(docs["text"]) == F.col("__version")), "left").drop("__doc", "__version")


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with every column, boilerplate lines cut out of ``text`` and ``n_chars``, if there, counted anew."""
    marked = with_bitmaps(docs, min_chars, min_docs)
    changed = F.col("__runs").isNotNull()
    marked = marked.withColumn("text", F.when(changed, kept_text(F.col("text"), F.col("__runs"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        marked = marked.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return marked.select(*docs.columns)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    marked = with_bitmaps(docs.select("doc_id", "text"))
    return marked.select(
        "doc_id", F.size(split_lines(F.col("text"))).cast("bigint").alias("n_lines"), F.coalesce(F.col("__n_dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("__runs")).cast("binary"), 256).alias("kept_sha256"),
    )


LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
lines as (select doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from split),
keyed as (select *, {LOWER_SQL.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from lines),
repeated as (select key, max(doc_id) as holder from keyed where length(key) >= {MIN_CHARS} group by key having count(distinct doc_id) >= {MIN_DOCS}),
marked as (select k.*, r.key is not null and k.doc_id <> r.holder as gone from keyed k left join repeated r on k.key = r.key)
select doc_id, count(*) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256 from marked group by doc_id"""
