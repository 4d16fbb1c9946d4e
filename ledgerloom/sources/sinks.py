"""Writers of tables and export files. Files are split by partition columns, never by a driver loop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerloom.sources.feeds import CSV_WRITE

# Sort order inside the ERP files.
FILE_ORDER = {
    "sales": ["division", "style", "sku300"],
    "credits": ["division", "style", "color"],
    "adjustments": ["division", "style", "color_code"],
}


def full_refresh(df: DataFrame, path: str) -> None:
    """Replaces the stored table with the rows of ``df``; zstd takes a quarter less of the disk than the default for statement lines."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replaces only the partitions that occur in ``df``; writing the same rows again changes nothing."""
    (
        _by_partition(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path)
    )


GONE = "_gone"


def replace_keys(df: DataFrame, touched: DataFrame, path: str, keys: list[str]) -> None:
    """Replaces the rows of all ``touched`` keys in a table partitioned by exactly these keys; ``read_keyed`` reads it.

    A touched key without rows gets one row that only says so, in the same write as the others: all touched keys, also
    null ones, are published by one commit of dynamic partitions, nothing is deleted afterwards and no key passes through
    the driver. A job that fails before that commit leaves the old rows; running it again gives the new ones.
    """
    kept = df.withColumn(GONE, F.lit(False)).persist()
    # Structs compare their nulls as equal.
    key = F.struct(*[F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys])
    gone = touched.select(key.alias("_key")).distinct().join(kept.select(key.alias("_key")).distinct(), "_key", "left_anti")
    rows = gone.select(*[F.col(f"_key.{k}").alias(k) if k in keys else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in df.columns], F.lit(True).alias(GONE))
    replace_partitions(kept.unionByName(rows), path, keys)
    kept.unpersist()


def read_keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table that ``replace_keys`` keeps."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(GONE, T.BooleanType())])).parquet(path).where(~F.col(GONE)).select(*schema.fieldNames())


def _by_partition(df: DataFrame, partitions: list[str]) -> DataFrame:
    """One task per small partition, several for a large one."""
    return df.hint("rebalance", *[F.col(c) for c in partitions])


MONTH = "end_month"


def store_statements(lines: DataFrame, path: str) -> None:
    """Statement lines stored by the month their settlement ends in; lines without an end date have a month of their own.

    Months that occur in ``lines`` are replaced as a whole, so a delivery that holds a month completely can be repeated.
    """
    replace_partitions(lines.withColumn(MONTH, F.coalesce(F.date_format("end_date", "yyyy-MM"), F.lit("none"))), path, [MONTH])


def read_statements(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``store_statements`` stored, with the month."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])).parquet(path)


def export_csv(df: DataFrame, path: str, order: list[str] | None = None, separator: str = ",", packed: str = "none") -> None:
    """A CSV export with a header, globally sorted where an order is given. Of the codecs, ``bzip2`` leaves files that several tasks may read."""
    rows = df.orderBy(*order) if order else df
    rows.write.mode("overwrite").options(**CSV_WRITE).option("sep", separator).option("compression", packed).csv(path)


def export_partitioned(
    df: DataFrame, path: str, partitions: list[str], order: list[str], packed: str = "none", then: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """CSV files per partition value, sorted inside each file. A value without rows gets no file.

    ``then`` adds what the files show besides (columns of a small table, say) when the rows have been dealt out, so it does not travel.
    """
    dealt = _by_partition(df, partitions)
    (
        (then(dealt) if then else dealt).sortWithinPartitions(*partitions, *order)
        .write.mode("overwrite").options(**CSV_WRITE).option("compression", packed).partitionBy(*partitions).csv(path)
    )


def statement_file(start: Column, end: Column, account: Column, settlement: Column) -> Column:
    """Name of the reference file of an exported settlement; ``exported_statements`` reads it back."""
    return F.concat(F.lit("Settlements Data "), start.cast("string"), F.lit(" - "), end.cast("string"), F.lit(" "), account, F.lit(" "), settlement.cast("string"), F.lit(".csv"))


def export_statements(lines: DataFrame, path: str) -> None:
    """The lines of each settlement below a folder named after account, period and settlement."""
    name = statement_file(F.col("start_date"), F.col("end_date"), F.col("account_name"), F.col("settlement_id"))
    export_partitioned(lines.withColumn("file", name), path, ["file"], ["posted_date", "order_id", "sku"])
