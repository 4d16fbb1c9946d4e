"""Readers of the ERP and marketplace feeds.

Columns are taken by the names in the header, whatever their order, and a column that is missing is an error. Every
value is read as text and then typed; a row with a value that does not parse, or with too many or too few values, is
never passed on with a hole in it but goes to the rejects.

``load_feed`` reads a feed once: the pass that stores rows and rejects also counts them, in all and per fault, as
observed metrics. A feed with a larger share of rejects than it may have fails with these counts, and the named readers
allow none unless told so; the stored rejects stay where they are for inspection."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerloom.functions.sizing import unique
from ledgerloom.params import PREPACK_SLOTS
from ledgerloom.sources.records import read_records
from ledgerloom.sources.workspace import new_dir

# File name stems of the feeds; dated feeds carry the day as mmddyy.
INVENTORY_STEM = "MARKETPLACE_INVENTORY"
PREPACK_STEM = "MARKETPLACE_PREPACK"
UPC_SKU_STEM = "UPC_SKU_Data"
WAREHOUSE_STEM = "WAREHOUSE_INFO"
OVERRIDE_FILE = "WAREHOUSES.csv"

INVENTORY_SCHEMA = (
    "division int, div_name string, sub_div int, sub_div_desc string, warehouse int, warehouse_name string, season string, "
    "style string, color string, pack_dim string, size string, upc string, asin string, carton_qty int, avail_in_stock int, "
    "wip int, in_transit int, cost decimal(12,2), sku200 string, size_scale string"
)
PREPACK_SCHEMA = (
    "division int, prepack_code string, season string, size_scale_1 string, size_scale_2 string, size_scale_3 string, "
    "prepack_desc string, total_units int, "
    + ", ".join(f"size_{i} string, qty_{i} int" for i in range(1, PREPACK_SLOTS + 1))
)
WAREHOUSE_COLUMNS = [
    "warehouse", "name", "address_1", "city_state", "country", "zip_postal_code", "currency", "whse_type", "company_number",
    "warehouse_locator", "trading_partner_id",
]
WAREHOUSE_SCHEMA = "warehouse int, " + ", ".join(f"{c} string" for c in WAREHOUSE_COLUMNS[1:])
UPC_SKU_SCHEMA = "upc string, sku string, style string"
FX_SCHEMA = "settlement_id bigint, exchange_value decimal(20,10)"
OVERRIDE_SCHEMA = "warehouse int, exclude string, priority string"
REFERENCE_SCHEMA = (
    "id int, transaction_type string, fee_category string, fee_type string, credit_memo_class string, credit_memo_sub_class string, "
    "notes string, class_code string, subclass_code string"
)
SETTLEMENT_SCHEMA = (
    "account_name string, settlement_id bigint, currency string, start_date date, end_date date, posted_date timestamp_ntz, "
    "order_id string, sku string, transaction_type string, amount_type string, amount_description string, amount decimal(12,2), "
    "quantity_purchased int, status string"
)


CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# A missing value is nothing between separators, a blank is two quotes; no text stands for null.
CSV_READ = {**CSV, "multiLine": "true", "nullValue": "\u0000", "emptyValue": "", "enforceSchema": "false"}
CSV_WRITE = {**CSV, "nullValue": "", "emptyValue": '""'}
BROKEN = "_broken_record"


def plain_name(name: str) -> str:
    """A column name without case, blanks and punctuation."""
    return re.sub(r"\W+", "_", name.strip().lower())


def _struct(spark: SparkSession, schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, BROKEN]])


def checked(rows: DataFrame, wanted: T.StructType, names: dict[str, str]) -> DataFrame:
    """Rows of text (column -> name in the file) as the columns of ``wanted``, with ``_faults`` and ``_record``.

    ``_faults`` names the columns whose value does not parse, or the broken record; ``_record`` is then the whole row as
    JSON, and null for a sound row.
    """
    def text(field: T.StructField) -> Column:
        value = F.col(f"`{names[field.name]}`")
        # a blank is no number or date, and no fault either
        return value if isinstance(field.dataType, T.StringType) else F.when(F.trim(value) != "", value)

    def value(field: T.StructField) -> Column:
        return text(field).try_cast(field.dataType)

    faults = [F.when(text(f).isNotNull() & value(f).isNull(), F.lit(f.name)) for f in wanted.fields if not isinstance(f.dataType, T.StringType)]
    faults.append(F.when(F.col(BROKEN).isNotNull(), F.lit(BROKEN)))
    marked = rows.withColumn("_faults", F.array_compact(F.array(*faults)))
    record = F.when(F.size("_faults") > 0, F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])))
    return marked.select(*[value(f).alias(f.name) for f in wanted.fields], F.array_join("_faults", ",").alias("_faults"), record.alias("_record"))


def typed(rows: DataFrame, wanted: T.StructType, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows of text as rows of ``wanted``, and the rejects: the columns at fault and the whole row as JSON."""
    return _parted(checked(rows, wanted, names), wanted)


def _parted(rows: DataFrame, wanted: T.StructType) -> tuple[DataFrame, DataFrame]:
    good = rows.where(F.col("_faults") == "").select(*wanted.fieldNames())
    return good, rows.where(F.col("_faults") != "").select(F.col("_faults").alias("faults"), F.col("_record").alias("record"))


def feed_texts(
    spark: SparkSession, path: str, schema: str | T.StructType, separator: str = ",", by_position: bool = False, in_blocks: bool = False
) -> tuple[DataFrame, T.StructType, dict[str, str]]:
    """The rows of CSV files as text, the wanted schema and the name of each wanted column in the files.

    All files of ``path`` must have the header of the first; another one fails the read. ``in_blocks`` lets several tasks
    read one file, at the price of a shuffle of its lines: for few large files.
    """
    wanted = _struct(spark, schema)
    header = spark.read.options(**CSV_READ).option("sep", separator).csv(path).columns
    if by_position:
        if len(header) != len(wanted.fields):
            raise ValueError(f"{path}: {len(header)} columns where {len(wanted.fields)} are expected")
        names = dict(zip(wanted.fieldNames(), header))
    else:
        known = {plain_name(h): h for h in header}
        missing = [f.name for f in wanted.fields if plain_name(f.name) not in known]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)} in the header {', '.join(header)}")
        names = {f.name: known[plain_name(f.name)] for f in wanted.fields}
    if in_blocks:
        return read_records(spark, path, text_schema(header), separator, CSV_READ, BROKEN), wanted, names
    reader = spark.read.schema(text_schema(header)).options(**CSV_READ).option("sep", separator).option("columnNameOfCorruptRecord", BROKEN)
    return reader.csv(path), wanted, names


def read_feed(
    spark: SparkSession, path: str, schema: str | T.StructType, separator: str = ",", by_position: bool = False, in_blocks: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files, both lazy: each scans the files (or their stored lines) when it is read."""
    return typed(*feed_texts(spark, path, schema, separator, by_position, in_blocks))


class RejectedRows(ValueError):
    """A feed held more rows that do not parse than it may."""

    def __init__(self, path: str, counts: dict[str, int], stored: str):
        self.counts, self.stored = counts, stored
        faults = ", ".join(f"{name} {n}" for name, n in counts.items() if n and name not in ("rows", "rejected"))
        super().__init__(f"{path}: {counts['rejected']} of {counts['rows']} rows do not parse ({faults}); they are stored in {stored}")


@dataclass
class Feed:
    """A feed as it was loaded: rows, rejects, and how many of each (``counts``: rows, rejected, and per column at fault)."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]
    stored: str

    def counted(self) -> DataFrame:
        """(fault, rows) of the faults that occurred; a row with several faults counts for each."""
        faults = [(k.removeprefix("column "), n) for k, n in self.counts.items() if n and k not in ("rows", "rejected")]
        return self.rows.sparkSession.createDataFrame(faults, "fault string, rows bigint")


def load_feed(
    spark: SparkSession, path: str, schema: str | T.StructType, separator: str = ",", by_position: bool = False, max_share: float = 0.0,
    in_blocks: bool = False,
) -> Feed:
    """Reads CSV files in one pass that stores sound rows and rejects apart and counts both.

    More rejects than ``max_share`` of the rows raise ``RejectedRows``. A header without rows is an empty feed.
    """
    texts, wanted, names = feed_texts(spark, path, schema, separator, by_position, in_blocks)
    rows = checked(texts, wanted, names).withColumn("_rejected", F.col("_faults") != "")
    kinds = [f.name for f in wanted.fields if not isinstance(f.dataType, T.StringType)] + [BROKEN]
    held = F.split("_faults", ",")
    seen = Observation()
    counted = rows.observe(
        seen, F.count("*").alias("rows"), F.count_if("_rejected").alias("rejected"),
        # observed metrics are not compiled: the faults of a sound row are not split
        *[F.count_if(F.col("_rejected") & F.array_contains(held, kind)).alias(kind if kind == BROKEN else f"column {kind}") for kind in kinds],
    )
    stored = new_dir(spark, "feed")
    counted.write.option("compression", "zstd").partitionBy("_rejected").parquet(stored)
    counts = dict(seen.get)
    back = spark.read.schema(rows.schema).parquet(stored)
    good, bad = back.where("not _rejected").select(*wanted.fieldNames()), back.where("_rejected")
    if counts["rejected"] > max_share * counts["rows"]:
        raise RejectedRows(path, counts, stored)
    return Feed(good, bad.select(F.col("_faults").alias("faults"), F.col("_record").alias("record")), counts, stored)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, separator: str = ",", max_share: float = 0.0) -> DataFrame:
    """The rows of ``load_feed``."""
    return load_feed(spark, path, schema, separator, max_share=max_share).rows


def dated(stem: str, day: dt.date) -> str:
    return f"{stem}_{day:%m%d%y}"


def read_inventory_feed(spark: SparkSession, folder: str, day: dt.date, max_share: float = 0.0) -> DataFrame:
    return read_csv(spark, f"{folder}/*{dated(INVENTORY_STEM, day)}*", INVENTORY_SCHEMA, "|", max_share)


def read_prepack_feed(spark: SparkSession, folder: str, day: dt.date, max_share: float = 0.0) -> DataFrame:
    return read_csv(spark, f"{folder}/*{dated(PREPACK_STEM, day)}*", PREPACK_SCHEMA, "|", max_share)


def read_upc_sku(spark: SparkSession, folder: str, day: dt.date, max_share: float = 0.0) -> DataFrame:
    return read_csv(spark, f"{folder}/*{dated(UPC_SKU_STEM, day)}*", UPC_SKU_SCHEMA, max_share=max_share)


def read_warehouse_info(spark: SparkSession, folder: str, max_share: float = 0.0) -> DataFrame:
    """The eleven columns are named by position, whatever the header says."""
    return load_feed(spark, f"{folder}/*{WAREHOUSE_STEM}*", WAREHOUSE_SCHEMA, by_position=True, max_share=max_share).rows


def read_warehouse_override(spark: SparkSession, folder: str, max_share: float = 0.0) -> DataFrame:
    return unique(read_csv(spark, f"{folder}/{OVERRIDE_FILE}", OVERRIDE_SCHEMA, max_share=max_share), ["warehouse"], "warehouse override")


def read_fee_reference(spark: SparkSession, path: str, max_share: float = 0.0) -> DataFrame:
    return read_csv(spark, path, REFERENCE_SCHEMA, max_share=max_share)


def read_fx_rates(spark: SparkSession, path: str, max_share: float = 0.0) -> DataFrame:
    """Sheet export with free-form headers, keyed by settlement; a repeated settlement fails the read."""
    return unique(read_csv(spark, path, FX_SCHEMA, max_share=max_share), ["settlement_id"], "exchange rates")


def read_table(spark: SparkSession, source: str | dict[str, str]) -> DataFrame:
    """A stored table: a Parquet path or the options of a partitioned JDBC read.

    JDBC options should name ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``,
    or a single task reads the whole table.
    """
    if isinstance(source, str):
        return spark.read.parquet(source)
    if "partitionColumn" not in source:
        raise ValueError("a JDBC source needs partitionColumn, lowerBound, upperBound and numPartitions")
    return spark.read.format("jdbc").options(**source).load()


#: Rows that one task may read of a table whose rows unfold into several each (a row group of Arrow's default length), and files
#: whose footers say how a table is cut.
ROWS_A_TASK, FOOTERS = 1 << 20, 8


def dealt_out(df: DataFrame, rows_a_task: int = ROWS_A_TASK, by: list[str] | None = None) -> DataFrame:
    """``df``, a stored Parquet table, on enough tasks, shuffled only if its files do not give as many.

    Rows are dealt by a hash of the columns ``by``, which together should tell most rows apart. Without them they are dealt
    in turn, and Spark sorts every task's rows before it does so.

    A row group is read by one task, whatever its size. The footers of some files tell how many rows a group has; no row
    is read. A table that every core has a part of, with no more than ``rows_a_task`` in any, stays as it is.
    """
    rows = _rows_to_deal(df, rows_a_task)
    if not rows:
        return df
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -int(-rows // rows_a_task)), *(by or []))


def cut_finely(df: DataFrame, path: str, rows_a_task: int = ROWS_A_TASK // 2) -> DataFrame:
    """``df`` as ``dealt_out`` gives it, for a table that is read many times: it is stored once at ``path``, in the order it has,
    in files so small that Spark gives no task more than ``rows_a_task`` of their rows. No row is shuffled, now or when it is read."""
    if not _rows_to_deal(df, rows_a_task):
        return df
    spark = df.sparkSession
    # a file counts as many bytes more as opening it costs, and a task takes files up to its bytes
    share = min(1, _bytes(spark, "spark.sql.files.openCostInBytes") / _bytes(spark, "spark.sql.files.maxPartitionBytes"))
    df.write.option("maxRecordsPerFile", max(1, int(rows_a_task * share))).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _rows_to_deal(df: DataFrame, rows_a_task: int) -> float:
    """About how many rows a stored table has, if its files do not give enough tasks; otherwise 0."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files, sizes, rows, largest, groups = df.inputFiles(), [], 0, 0, 0
    if not files:
        return 0
    for file in files[:FOOTERS]:
        found = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(found)
        try:
            counts = [block.getRowCount() for block in reader.getRowGroups()]
        finally:
            reader.close()
        sizes.append(found.getLength())
        rows, groups, largest = rows + sum(counts), groups + len(counts), max([largest, *counts])
    share = len(files) / len(sizes)
    rows, groups, size = rows * share, groups * share, sum(sizes) * share
    cores = spark.sparkContext.defaultParallelism
    # as Spark cuts files for a scan
    cut = min(_bytes(spark, "spark.sql.files.maxPartitionBytes"), max(_bytes(spark, "spark.sql.files.openCostInBytes"), size / cores))
    tasks = min(groups, max(1, size / cut))
    return 0 if tasks >= cores and max(rows / tasks, largest) <= rows_a_task else max(rows, 1)


def _bytes(spark: SparkSession, name: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))


# How the reference file of an exported settlement is named.
STATEMENT_FILE = r"Settlements Data (\S+) - (\S+) (\S+) (\d+)\.csv"


def exported_statements(spark: SparkSession, folder: str) -> DataFrame:
    """(account_name, settlement_id, start_date, end_date) of the settlements that were exported to ``folder``.

    The names of the files (or of the folders they lie in) are the done-marker; no file is opened, and the listing stays
    distributed. Other files, and names that hold no settlement, are passed over. A folder that does not exist has none.
    """
    columns = "account_name string, settlement_id bigint, start_date date, end_date date"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], columns)
    # of this source's columns only the content would open the files
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(F.replace("path", F.lit("%20"), F.lit(" ")).alias("path"))
    part = [F.regexp_extract("path", STATEMENT_FILE, i) for i in range(1, 5)]
    found = names.where(F.col("path").rlike(STATEMENT_FILE))
    return found.select(part[2].alias("account_name"), part[3].cast("bigint").alias("settlement_id"), part[0].try_cast("date").alias("start_date"), part[1].try_cast("date").alias("end_date")).distinct()


def union_store_codes(spark: SparkSession, sheets: dict[str, str]) -> DataFrame:
    """A few named sheets (store name -> CSV path) under each other, store name first, columns aligned by name; ``union_sheets`` takes any number."""
    frames = [
        spark.read.options(**CSV_READ).csv(path).select(F.lit(store).alias("store"), "*") for store, path in sheets.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_sheets(spark: SparkSession, folder: str, columns: list[str], store: Column | None = None, max_columns: int = 64) -> DataFrame:
    """All sheets below ``folder`` under each other: the store, then ``columns`` by the names in each sheet's own header, null where it has none.

    One scan reads the values of all sheets by position, whatever their headers; the first line of every sheet, from a
    scan of their beginnings, says which position a name has there. Nothing comes to the driver and no sheet is named in
    the code. ``store`` is taken from the column ``path``, by default the name of the file. A header of more than
    ``max_columns`` names fails the read.
    """
    folders = {**CSV_READ, "multiLine": "false", "recursiveFileLookup": "true"}
    path = F.replace(F.col("_metadata.file_path"), F.lit("%20"), F.lit(" ")).alias("path")
    generic = [f"_c{i}" for i in range(max_columns + 1)]
    schema = ", ".join(f"{c} string" for c in generic)
    lines = spark.read.option("recursiveFileLookup", "true").text(folder).where("_metadata.file_block_start = 0")
    first = lines.select(path, "value", F.monotonically_increasing_id().alias("_at")).groupBy("path").agg(F.min_by("value", "_at").alias("_header"))
    header = first.withColumn("_names", F.from_csv("_header", F.lit(schema), {"quote": '"', "escape": '"'})).withColumn("_names", F.array(*[F.lower(F.trim(f"_names.{c}")) for c in generic]))
    wide = F.raise_error(F.concat(F.lit(f"more than {max_columns} columns in "), F.col("path")))
    header = header.select("path", F.when(F.get("_names", F.lit(max_columns)).isNotNull(), wide).otherwise(F.col("_names")).alias("_names"))
    # the reader drops the first line of every file
    rows = spark.read.schema(schema).options(**folders | {"enforceSchema": "true"}).csv(folder).select(path, F.array(*generic).alias("_values"))
    joined = rows.join(header, "path")
    place = [F.array_position("_names", F.lit(c.lower())) for c in columns]
    named = F.regexp_extract("path", r"([^/]+?)(\.csv)?$", 1) if store is None else store
    return joined.select(named.alias("store"), *[F.when(at > 0, F.get("_values", at.cast("int") - 1)).alias(c) for at, c in zip(place, columns)])
