"""Row numbers that do not put a whole key on one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.sizing import told_apart
from ledgerloom.sources.workspace import new_dir

COPIES_PER_PIECE = 100_000
#: Sums that number_sorted sends to every task; of more it makes a shuffled join.
FEW = 200_000


def rank_copies(df: DataFrame, group: list[Column | str], name: str = "ranking", copies_per_piece: int = COPIES_PER_PIECE) -> DataFrame:
    """Number the rows of each ``group`` from 1.

    Of each row a hash of its group travels; rows that have theirs alone are the first of their group where they lie. The others
    travel once, by that hash, and a sort along it numbers them. Rows of a hash that has more than
    ``copies_per_piece`` of them are counted on the map side first, so a line repeated a billion times travels as one row
    with its count. There is at most one such hash per ``copies_per_piece`` rows of input, so their list is small.
    """
    columns = df.columns
    alone, others, counts = told_apart(df, group)
    large = F.broadcast(counts.where(F.col("_n") > copies_per_piece).select("_dealt"))
    small = others.join(large, "_dealt", "left_anti").repartition("_dealt")
    place = F.row_number().over(Window.partitionBy("_dealt", *group).orderBy(*columns)).cast("bigint")
    counted = _rank_counted(others.join(large, "_dealt", "left_semi").select(*columns), group, name, copies_per_piece)
    return alone.select(*columns, F.lit(1).cast("bigint").alias(name)).unionByName(small.select(*columns, place.alias(name))).unionByName(counted)


def _rank_counted(df: DataFrame, group: list[Column | str], name: str, copies_per_piece: int) -> DataFrame:
    """``rank_copies`` by counts of equal rows.

    A window only sums counts over the distinct rows of a group. Copies unfold last, in pieces of a bounded number, so
    that none of them is held as a list.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    first, last = F.col("_before") + 1, F.col("_before") + F.col("_n")
    step = F.lit(copies_per_piece).cast("bigint")
    pieces = placed.select(*columns, last.alias("_last"), F.explode(F.sequence(first, last, step)).alias("_from"))
    return pieces.select(*columns, F.explode(F.sequence("_from", F.least(F.col("_from") + step - 1, F.col("_last")))).alias(name))


def number_within(df: DataFrame, partition: list[str], order: list[str], name: str = "id", levels: list[Column | str] | None = None) -> DataFrame:
    """``row_number`` per ``partition`` along ``order``, which has to be a total order.

    ``levels`` cut the order into stretches, coarse before fine (a day, a time of it, an order): together they follow
    the order and are its beginning. Rows are counted per stretch, a window per level sums the counts of the stretches
    before, and only the rows of one finest stretch are sorted together. By default the first column of the order is
    the only level.
    """
    levels = levels or order[:1]
    named = {f"_level_{i}": F.col(x) if isinstance(x, str) else x for i, x in enumerate(levels)}
    # A struct key is never null and compares its nulls as equal, so the rows are dealt out once for join and window.
    keyed = df.withColumns(named).withColumn("_stretch", F.struct(*partition, *named))
    parts = list(named)
    counted = keyed.groupBy("_stretch").agg(F.count("*").alias("_n"))
    starts = None
    for depth in range(len(parts), 0, -1):
        inside = [F.col(f"_stretch.{c}") for c in (*partition, *parts[: depth - 1])]
        earlier = Window.partitionBy(*inside).orderBy(F.col(f"_stretch.{parts[depth - 1]}")).rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        wider = F.struct(*[c.alias(n) for c, n in zip(inside, (*partition, *parts[: depth - 1]))]) if inside else F.struct(F.lit(0))
        if starts is None:
            starts = placed.select("_stretch", wider.alias("_wider"), "_before")
        else:
            above = placed.select(F.col("_stretch").alias("_above"), wider.alias("_next"), F.col("_before").alias("_more"))
            starts = starts.join(above, F.col("_wider") == F.col("_above")).select("_stretch", F.col("_next").alias("_wider"), (F.col("_before") + F.col("_more")).alias("_before"))
        counted = placed.groupBy(wider.alias("_stretch")).agg(F.sum("_n").alias("_n"))
    within = Window.partitionBy("_stretch").orderBy(*order)
    numbered = keyed.join(starts.select("_stretch", "_before"), "_stretch").withColumn("_nth", F.row_number().over(within))
    return numbered.select(*df.columns, (F.col("_before") + F.col("_nth")).alias(name))


def number_sorted(df: DataFrame, order: list[Column | str], partition: list[str] | None = None, name: str = "id") -> DataFrame:
    """``row_number`` along ``order`` (per ``partition``), from one sort of the rows and prefix sums of partition sizes.

    The rows are range-partitioned once by partition and order and stored as they are sorted, each with the number of its
    task and its place there. Counts per task and key are then added up over the tasks before, and the stored rows meet
    these sums, of which there are as many as tasks and keys; up to ``FEW`` are sent to every task, so that the rows are not
    shuffled again to meet them. A key of any size, also one whose rows agree in all but the last column of the order, is spread over
    as many tasks as its rows need, and nothing is computed twice. The order has to be total where ties matter.
    """
    spark, keys = df.sparkSession, partition or []
    # The upper bits of the running number are the task's.
    marks = {"_task": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumns(marks)
    path = new_dir(spark, "numbered")
    ranged.write.option("compression", "zstd").parquet(path)
    # A struct is never null and compares its nulls as equal.
    stored = spark.read.schema(ranged.schema).parquet(path).withColumn("_piece", F.struct("_task", *keys))
    pieces = stored.groupBy("_piece").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*[F.col(f"_piece.{k}") for k in keys]).orderBy("_piece._task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select("_piece", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    if pieces.select("_piece").limit(FEW + 1).count() <= FEW:
        shifts = F.broadcast(shifts)
    return stored.join(shifts, "_piece").select(*df.columns, (F.col("_place") + F.col("_shift")).alias(name))
