"""CSV records with line breaks between quotes, read by as many tasks as a file has blocks.

A reader that allows such breaks has to start at the beginning of a file, so a file is one task. Here lines are read in
blocks, and whether a line begins inside a quoted value is found afterwards. What a line does to that is one of four
things, whatever stands before it: it leaves all as it is, it turns it round, or it ends outside or inside in any case. These
compose, so the state at every line of a block, for both states the block may begin in, is a running fold; a block as
a whole is one step of the same fold over the blocks of its file. A task reads the lines of a block in their order, so the
files are read twice and no line is shuffled: once for what each block does as a whole, which is one row a block and is
broadcast, and once for the records, which are stored on the way. Only the pieces of records that stretch over several blocks
are shuffled.

A value is quoted if its first character is a quote; two quotes in it are one; what follows the closing quote up to the
separator is text, and so are quotes inside a value that is not quoted. Lines end with a line feed, with or without a
carriage return, and are joined by a line feed. Empty lines between records are passed over. A file whose last quote is
not closed ends in one broken record."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ledgerloom.sources.workspace import new_dir

_LINE = ["_file", "_block"]


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, _text): the lines of all files; each task has those of a block one after the other, in their order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    text = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    where = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    return lines.select(*where, text.alias("_text"))


def ends_inside(text: Column, separator: str) -> Column:
    """Whether a line ends inside a quoted value if it begins outside one (``from_0``) or inside one (``from_1``); null without quotes.

    One fold over what stands between its quotes.
    """
    def step(state: Column, part: Column) -> Column:
        # a quote stands between two parts: it closes, or opens at the beginning of a value
        opens = state["before"].endswith(separator) | (state["first"] & (state["before"] == ""))

        def to(inside: Column) -> Column:
            return F.when(state["before"].isNull(), inside).otherwise(~inside & opens)

        return F.struct(to(state["from_0"]).alias("from_0"), to(state["from_1"]).alias("from_1"), state["before"].isNull().alias("first"), part.alias("before"))

    start = F.struct(F.lit(False).alias("from_0"), F.lit(True).alias("from_1"), F.lit(False).alias("first"), F.lit(None).cast("string").alias("before"))
    start = start.cast("struct<from_0:boolean,from_1:boolean,first:boolean,before:string>")
    parts = F.split(F.replace(text, F.lit('""'), F.lit("")), '"', -1)
    return F.when(text.contains('"'), F.aggregate(parts, start, step))


def _folded(steps: DataFrame, group: list[str], order: str) -> DataFrame:
    """Adds ``_before_0`` and ``_before_1``: the state before each step if its group begins outside, or inside.

    A step takes outside to ``_to_0`` and inside to ``_to_1``. Since the last step that ends alike from both, only turns count.
    """
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.count_if(F.col("_to_0") & ~F.col("_to_1")).over(earlier) % 2, F.lit(0)) == 1
    steps = steps.withColumn("_turned", turns)
    # the fixed state as it would have to be at the beginning of the group for turns alone to lead to it
    fixed = F.when(F.col("_to_0") == F.col("_to_1"), F.col("_to_0") != F.col("_turned"))
    last = F.last(fixed, ignorenulls=True).over(earlier)
    return steps.withColumns({f"_before_{i}": F.coalesce(last, F.lit(bool(i))) != F.col("_turned") for i in (0, 1)})


def _after(i: int) -> Column:
    return F.when(F.col(f"_before_{i}"), F.col("_to_1")).otherwise(F.col("_to_0"))


def states_before(to_0: np.ndarray, to_1: np.ndarray, inside: bool) -> np.ndarray:
    """The state before each line if the first one begins ``inside``, as ``_folded`` tells it of rows."""
    turns = to_0 & ~to_1
    turned = (np.cumsum(turns) - turns) % 2 == 1
    last = np.maximum.accumulate(np.where(to_0 == to_1, np.arange(len(to_0)), -1))
    last = np.concatenate(([-1], last[:-1]))
    return np.where(last < 0, inside, to_0[last] ^ turned[last]) ^ turned


def _stretches(batches: Iterator) -> Iterator:
    """(new, at, batch): the batches cut where a block begins, whether one does, and the place of the first line in its block."""
    import pyarrow.compute as pc

    block, at = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0), batch.column(1)
        other = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
        for low, high in pairwise([0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]):
            here = (file[low].as_py(), start[low].as_py())
            new = here != block
            block, at = here, 0 if new else at
            yield new, at, batch.slice(low, high - low)
            at += high - low


def _flags(batch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(bool)


_SUMMARY = "_file string, _block bigint, _to_0 boolean, _to_1 boolean, _opened_0 bigint, _opened_1 bigint, _line bigint"


def _summaries(batches: Iterator) -> Iterator:
    """One row per block: the state it ends in and the last line that opens a value, from either state, and its first line that is not empty."""
    import pyarrow as pa

    schema = pa.schema([("_file", pa.string()), ("_block", pa.int64()), *[(f"_to_{i}", pa.bool_()) for i in (0, 1)], *[(f"_opened_{i}", pa.int64()) for i in (0, 1)], ("_line", pa.int64())])
    row: dict | None = None
    for new, at, batch in _stretches(batches):
        if new:
            if row:
                yield pa.RecordBatch.from_pylist([row], schema)
            row = {"_file": batch.column(0)[0].as_py(), "_block": batch.column(1)[0].as_py(), "_to_0": False, "_to_1": True, "_opened_0": None, "_opened_1": None, "_line": None}
        to_0, to_1, told = _flags(batch, "_to_0"), _flags(batch, "_to_1"), _flags(batch, "_told")
        for i in (0, 1):
            before = states_before(to_0, to_1, row[f"_to_{i}"])
            after = np.where(before, to_1, to_0)
            opened = np.flatnonzero(~before & after)
            if len(opened):
                row[f"_opened_{i}"] = at + int(opened[-1])
            row[f"_to_{i}"] = bool(after[-1])
        if row["_line"] is None and told.any():
            row["_line"] = at + int(np.argmax(told))
    if row:
        yield pa.RecordBatch.from_pylist([row], schema)


def _blocks(steps: DataFrame) -> DataFrame:
    """(_file, _block, _inside, _open, _first): the state a block begins in, the line its open record began at, the file's first record."""
    blocks = steps.select(*_LINE, "_to_0", "_to_1", (F.col("_text") != "").alias("_told")).mapInArrow(_summaries, _SUMMARY)
    blocks = _folded(blocks, ["_file"], "_block")
    by_file = Window.partitionBy("_file").orderBy("_block")

    def placed(at: Column) -> Column:
        return F.when(at.isNotNull(), F.struct("_block", at.alias("_at")))

    opened_here = placed(F.when(F.col("_before_0"), F.col("_opened_1")).otherwise(F.col("_opened_0")))
    return blocks.select(
        *_LINE, F.col("_before_0").alias("_inside"),
        F.last(opened_here, ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, -1)).alias("_open"),
        F.first(placed(F.col("_line")), ignorenulls=True).over(by_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_first"),
    )


_PIECES = "_file string, _record string, _header boolean, _whole boolean, _begun_block bigint, _begun_at bigint, _block bigint"


def _pieces(batches: Iterator) -> Iterator:
    """The records of each block; of a record that other blocks hold a part of, the piece in this block (not ``_whole``) and where it began."""
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [part.split()[0] for part in _PIECES.split(", ")]
    file, block, first, inside = None, 0, (None, None), False
    held: list[str] = []  # lines of the record that is open, which began at ``begun``
    begun: tuple = (None, None)

    def rows(texts: pa.Array, header: np.ndarray, whole: bool, start: tuple = (None, None)) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays([
            pa.repeat(pa.scalar(file, pa.string()), n), texts, pa.array(header, pa.bool_()), pa.repeat(pa.scalar(whole), n),
            *[pa.repeat(pa.scalar(v, pa.int64()), n) for v in (*start, block)]], names)

    def piece() -> pa.RecordBatch:
        return rows(pa.array(["\n".join(held)], pa.string()), np.array([begun == first]), False, begun)

    for new, at, batch in _stretches(batches):
        if new:
            if held:
                yield piece()
                held = []
            told = {c: batch.column(c)[0].as_py() for c in batch.schema.names if c not in ("_text", "_to_0", "_to_1")}
            file, block, inside = told["_file"], told["_block"], told["_inside"]
            first, begun = (told["_first_block"], told["_first_at"]), (told["_open_block"], told["_open_at"])
        to_0, to_1, text = _flags(batch, "_to_0"), _flags(batch, "_to_1"), batch.column("_text")
        before = states_before(to_0, to_1, inside)
        alone = ~before & ~to_0
        filled = np.flatnonzero(alone & pc.not_equal(text, "").to_numpy(zero_copy_only=False))
        if len(filled):
            yield rows(text.take(pa.array(filled)), (filled + at == first[1]) & (block == first[0]), True)
        part = np.flatnonzero(~alone)
        begins = np.flatnonzero(~before[part])  # places among the lines of ``part`` where a record begins
        if len(part) and (not len(begins) or begins[0]):  # lines of a record that began before
            upto = int(begins[0]) if len(begins) else len(part)
            held += text.take(pa.array(part[:upto])).to_pylist()
            closed = len(begins) > 0 or upto < len(part) or not to_1[part[upto - 1]]
            if closed:
                whole = begun[0] == block
                yield rows(pa.array(["\n".join(held)], pa.string()), np.array([begun == first]), True) if whole else piece()
                held = []
        inside = bool((to_1 if before[-1] else to_0)[-1])
        if len(begins):
            ends = np.append(begins[1:], len(part))
            if inside:  # the last one goes on
                last = part[begins[-1]:]
                held, begun = text.take(pa.array(last)).to_pylist(), (block, at + int(last[0]))
                begins, ends = begins[:-1], ends[:-1]
            if len(begins):
                texts = text.take(pa.array(part[begins[0]:ends[-1]]))
                offsets = pa.array(np.append(begins, ends[-1]) - begins[0], pa.int32())
                starts = part[begins] + at
                yield rows(pc.binary_join(pa.ListArray.from_arrays(offsets, texts), "\n"), (starts == first[1]) & (block == first[0]), True)
    if held:
        yield piece()


def records_of(lines: DataFrame, separator: str) -> DataFrame:
    """(_file, _record, _header): the records of ``lines_of``, stored once, and whether one is the first of its file."""
    steps = lines.withColumn("_ends", ends_inside(F.col("_text"), separator))
    steps = steps.select(*_LINE, "_text", *[F.coalesce(F.col(f"_ends.from_{i}"), F.lit(bool(i))).alias(f"_to_{i}") for i in (0, 1)])
    places = [F.col(f"{c}.{k}").alias(f"{c}{k}") for c in ("_open", "_first") for k in ("_block", "_at")]
    blocks = _blocks(steps).select(*_LINE, "_inside", *places)
    pieces = steps.join(F.broadcast(blocks), _LINE).select(*_LINE, "_text", "_to_0", "_to_1", "_inside", *blocks.columns[3:]).mapInArrow(_pieces, _PIECES)
    stored = new_dir(lines.sparkSession, "csv-records")
    pieces.write.option("compression", "zstd").parquet(stored)
    pieces = lines.sparkSession.read.schema(pieces.schema).parquet(stored)
    several = pieces.where("not _whole").groupBy("_file", "_begun_block", "_begun_at").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("_block", "_record")))["_record"], "\n").alias("_record"), F.bool_or("_header").alias("_header"))
    return pieces.where("_whole").select("_file", "_record", "_header").unionByName(several.select("_file", "_record", "_header"))


def read_records(spark: SparkSession, path: str, schema: T.StructType, separator: str, options: dict[str, str], broken: str) -> DataFrame:
    """The rows of CSV files as ``spark.read`` with ``multiLine`` gives them, in the columns of ``schema`` (texts, and ``broken``).

    A file whose header does not name the columns of ``schema`` in their order fails the read.
    """
    names = [n for n in schema.fieldNames() if n != broken]
    parser = {k: v for k, v in options.items() if k not in ("header", "multiLine", "enforceSchema")} | {"sep": separator, "columnNameOfCorruptRecord": broken}
    records = records_of(lines_of(spark, path), separator)
    values = F.from_csv("_record", F.lit(", ".join(f"`{f.name}` string" for f in schema.fields)), parser)
    parsed = records.withColumn("_values", values)
    titles = F.array(*[F.lower(F.col("_values").getField(n)) for n in names])
    same = titles == F.array(*[F.lit(n.lower()) for n in names])
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("_file"), F.lit(": "), F.col("_record"))).cast("boolean")
    kept = F.when(~F.col("_header"), True).when(same & F.col("_values").getField(broken).isNull(), False).otherwise(other)
    return parsed.where(kept).select("_values.*")
