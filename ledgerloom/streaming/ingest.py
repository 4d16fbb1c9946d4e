"""Incremental pick-up: each run takes the files it has not seen, and only their settlements are redone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom.sources.feeds import BROKEN, CSV_READ, text_schema, typed
from ledgerloom.sources.sinks import replace_keys


def ingest_new_files(
    spark: SparkSession, folder: str, schema: str, landing: str, checkpoint: str, separator: str = ",",
    rejects: str | None = None, partitions: list[str] | None = None,
) -> None:
    """Appends the files not taken before to the landing table and returns when they are done.

    The checkpoint remembers the files, so a second run over the same folder adds nothing. A file whose header is not
    the schema's fails the run. Rows that do not parse go to ``rejects`` (by default next to the landing table) with a
    checkpoint of their own. A landing table partitioned by settlement is read only where it is redone.
    """
    wanted = T.StructType.fromDDL(schema)
    names = wanted.fieldNames()
    files = spark.readStream.schema(text_schema(names)).options(**CSV_READ).option("sep", separator).option("columnNameOfCorruptRecord", BROKEN)
    rows, bad = typed(files.csv(folder), wanted, {n: n for n in names})
    for frame, path, state, split in ((rows, landing, checkpoint, partitions or []), (bad, rejects or f"{landing}-rejects", f"{checkpoint}-rejects", [])):
        query = (
            frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", state).partitionBy(*split)
            .outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()


def refresh_settlements(
    spark: SparkSession,
    landing: str,
    schema: str,
    target: str,
    checkpoint: str,
    job: Callable[[DataFrame], DataFrame],
    keys: list[str],
    landed_by: str | None = None,
) -> None:
    """Runs ``job`` over the whole settlements that new lines belong to and replaces their rows in the target.

    A settlement may arrive in several files, so a batch only tells which settlements to redo; their
    lines are read from the landing table, of which only the partitions of these settlements are opened where it is
    partitioned by ``landed_by``. The target is partitioned by ``keys``: rows the job no longer yields disappear with
    the old partition, and a repeated batch changes nothing. ``read_keyed`` reads the target.
    """

    def redo(batch: DataFrame, _: int) -> None:
        touched = batch.select(*keys).distinct()
        lines = batch.sparkSession.read.schema(schema).parquet(landing)
        if landed_by:
            # one value per settlement of the batch
            lines = lines.where(F.col(landed_by).isin([r[0] for r in touched.select(landed_by).distinct().collect()]))
        replace_keys(job(lines.join(touched, keys, "left_semi")), touched, target, keys)

    query = (
        spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(redo)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
