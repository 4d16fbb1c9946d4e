"""Feeds, exports, schema jobs and incremental runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import quality
from ledgerloom.sources import feeds, sinks, workspace
from ledgerloom.streaming.ingest import ingest_new_files, refresh_settlements


def test_dated_feed_reads_only_its_day(spark, tmp_path):
    header = "upc,sku,style\n"
    (tmp_path / "UPC_SKU_Data_030421.csv").write_text(header + '1,a,""\n2,,x\n')
    (tmp_path / "UPC_SKU_Data_030321.csv").write_text(header + "9,z,z\n")
    rows = feeds.read_upc_sku(spark, str(tmp_path), dt.date(2021, 3, 4)).collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "a", ""), ("2", None, "x")]


def test_rate_sheet_headers_are_normalised(spark, tmp_path):
    (tmp_path / "fx.csv").write_text("Settlement ID,Exchange Value\n14980914411,17.83794208\n")
    row = feeds.read_fx_rates(spark, str(tmp_path / "fx.csv")).first()
    assert row["settlement_id"] == 14980914411 and str(row["exchange_value"]) == "17.8379420800"


def test_jdbc_source_must_be_partitioned(spark):
    with pytest.raises(ValueError):
        feeds.read_table(spark, {"url": "jdbc:none", "dbtable": "t"})


def test_new_files_are_taken_once(spark, tmp_path):
    incoming, landing, state = (str(tmp_path / n) for n in ("incoming", "landing", "state"))
    for day in ("a", "b"):
        spark.createDataFrame([(day, 1), (day, 2)], "k string, v int").coalesce(1).write.mode("append").option("header", True).csv(incoming)
        for _ in range(2):
            ingest_new_files(spark, incoming, "k string, v int", landing, state)
    assert sorted(map(tuple, spark.read.parquet(landing).collect())) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def test_late_lines_redo_their_settlement_only(spark, tmp_path):
    incoming, landing, state, target, state2 = (str(tmp_path / n) for n in ("incoming", "landing", "state", "target", "state2"))
    schema = "settlement_id int, amount int"
    for rows in ([(1, 5), (2, 7)], [(1, 6)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").option("header", True).csv(incoming)
        ingest_new_files(spark, incoming, schema, landing, state)
        refresh_settlements(
            spark, landing, schema, target, state2, lambda lines: lines.groupBy("settlement_id").agg(F.sum("amount").alias("total")),
            ["settlement_id"])
    assert sorted((r["settlement_id"], r["total"]) for r in spark.read.parquet(target).where('not _gone').collect()) == [(1, 11), (2, 7)]


def test_partition_export_writes_no_file_for_empty_groups(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("USD", True, 2, "b"), ("USD", True, 1, ""), ("CAD", False, 3, None)], "currency string, connected boolean, n int, t string")
    sinks.export_partitioned(df, path, ["currency", "connected"], ["n"])
    folders = sorted(str(p.relative_to(path)) for p in (tmp_path / "out").glob("*/*") if p.is_dir())
    assert folders == ["currency=CAD/connected=false", "currency=USD/connected=true"]
    back = feeds.read_csv(spark, path, df.schema).select(*df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


class _Session:
    """Stands in for a cluster session."""

    def __init__(self, folder):
        self.conf = self.sparkContext = self
        self.folder, self.master = folder, "yarn"

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return None


def test_workspace_is_the_shared_folder():
    assert workspace.new_dir(_Session("hdfs://x/shared/"), "raw").startswith("hdfs://x/shared/raw-")
    with pytest.raises(ValueError):
        workspace.new_dir(_Session(None), "raw")


def test_stores_are_aligned_by_column_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("Code,Name\n1,a\n")
    (tmp_path / "two.csv").write_text("Code,City\n2,x\n")
    df = feeds.union_store_codes(spark, {"One": str(tmp_path / "one.csv"), "Two": str(tmp_path / "two.csv")})
    assert df.columns == ["store", "Code", "Name", "City"]
    assert sorted(map(tuple, df.collect())) == [("One", "1", "a", None), ("Two", "2", None, "x")]


def test_column_profile(spark):
    df = spark.createDataFrame(
        [("12", "1.50", "abc", None, 1234567890, dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 1, 5), True, 0),
         ("nan", "22.255", "x" * 60, None, 5, dt.datetime(2021, 1, 2), dt.datetime(2021, 1, 2), False, None)],
        "a string, b string, c string, d string, e bigint, f timestamp_ntz, g timestamp_ntz, h boolean, i int")
    got = {r["column_name"]: (r["target_type"], r["zero_or_null"]) for r in quality.profile_column_types(df).collect()}
    assert got == {"a": ("INTEGER", False), "b": ("NUMERIC(12,4)", False), "c": ("VARCHAR(100)", False), "d": ("INTEGER", True), "e": ("BIGINT", False),
                   "f": ("DATE", False), "g": ("DATETIME", False), "h": ("BOOLEAN", False), "i": ("INTEGER", True)}


def test_text_width_buckets(spark):
    widths = {1: "VARCHAR(5)", 5: "VARCHAR(10)", 10: "VARCHAR(15)", 15: "VARCHAR(25)", 25: "VARCHAR(50)", 50: "VARCHAR(100)", 100: "VARCHAR(255)", 255: "VARCHAR(255)", 256: "TEXT"}
    df = spark.createDataFrame([tuple("x" * n for n in widths)], ", ".join(f"c{n} string" for n in widths))
    assert {int(r["column_name"][1:]): r["target_type"] for r in quality.profile_column_types(df).collect()} == widths


def test_widening_plan(spark):
    cases = [("INT(11)", "INTEGER", False, "keep"), ("BIGINT", "INTEGER", False, "keep"), ("INT", "BIGINT", False, "change"), ("DATE", "VARCHAR(25)", False, "keep"),
             ("FLOAT(12,2)", "INTEGER", False, "keep"), ("DECIMAL(20,2)", "DECIMAL(12,2)", False, "keep"), ("NUMERIC(12,2)", "NUMERIC(20,4)", False, "change"),
             ("VARCHAR(25)", "VARCHAR(50)", False, "widen"), ("VARCHAR(50)", "VARCHAR(25)", False, "keep"), ("VARCHAR(25)", "BIGINT", False, "keep"),
             ("VARCHAR(5)", "TEXT", False, "change"), ("TEXT", "VARCHAR(5)", False, "keep"), ("INT", "VARCHAR(5)", True, "keep"), ("TINYINT(1)", "BOOLEAN", False, "keep")]
    stored = spark.createDataFrame([(f"c{i}", c[0]) for i, c in enumerate(cases)], "column_name string, stored_type string")
    incoming = spark.createDataFrame([(f"c{i}", c[1], c[2]) for i, c in enumerate(cases)], "column_name string, target_type string, zero_or_null boolean")
    got = {r["column_name"]: r["action"] for r in quality.schema_widening_plan(stored, incoming).collect()}
    assert got == {f"c{i}": c[3] for i, c in enumerate(cases)}


def test_headers_and_nulls(spark):
    df = spark.createDataFrame([(None, "None", None), (2, "x", 1.5)], "`A B` int, `C` string, `D` double")
    assert quality.normalize_headers(df).columns == ["a_b", "c", "d"]
    assert sorted(map(tuple, quality.null_normalize(df).collect()), key=str) == [(0, "", None), (2, "x", 1.5)]


def test_csv_round_trip_is_lossless(spark, tmp_path):
    values = ["  lead", "trail  ", "a\nb", "a\r\nb", "\\N", 'q"x', "", None, "back\\slash", "back\\", ",", "null", '""', "\t", "é😀", "'"]
    df = spark.createDataFrame([(i, v, values[-i - 1]) for i, v in enumerate(values)], "n int, t string, u string")
    for separator in (",", "|"):
        path = str(tmp_path / f"out{ord(separator)}")
        sinks.export_csv(df, path, ["n"], separator)
        rows, rejects = feeds.read_feed(spark, path, df.schema, separator)
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, df.collect())) and rejects.count() == 0
    sinks.export_partitioned(df.withColumn("p", F.col("n") % 2), str(tmp_path / "parts"), ["p"], ["n"])
    assert sorted(map(tuple, feeds.read_csv(spark, str(tmp_path / "parts"), df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_columns_are_taken_by_name_and_bad_rows_are_rejected(spark, tmp_path):
    (tmp_path / "UPC_SKU_Data_030421.csv").write_text("sku,style,UPC\na,x,1\n")
    assert [tuple(r) for r in feeds.read_upc_sku(spark, str(tmp_path), dt.date(2021, 3, 4)).collect()] == [("1", "a", "x")]
    (tmp_path / "WAREHOUSES.csv").write_text("Warehouse,Exclude,Priority\n297A,X,\n298,,1\n299\n300,,,9\n,X,\n")
    rows, rejects = feeds.read_feed(spark, str(tmp_path / "WAREHOUSES.csv"), feeds.OVERRIDE_SCHEMA)
    assert sorted(map(tuple, rows.collect()), key=str) == [(298, None, "1"), (None, "X", None)]
    assert sorted((r["faults"], "297A" in r["record"]) for r in rejects.collect()) == [("_broken_record", False), ("_broken_record", False), ("warehouse", True)]
    with pytest.raises(ValueError, match="no column priority"):
        (tmp_path / "w.csv").write_text("warehouse,exclude\n1,X\n")
        feeds.read_feed(spark, str(tmp_path / "w.csv"), feeds.OVERRIDE_SCHEMA)
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("warehouse,exclude,priority\n1,X,\n")
    (tmp_path / "two" / "b.csv").write_text("exclude,warehouse,priority\nX,1,\n")
    with pytest.raises(Exception):
        feeds.read_feed(spark, str(tmp_path / "two"), feeds.OVERRIDE_SCHEMA)[0].collect()


def test_repeated_rate_fails_the_read(spark, tmp_path):
    (tmp_path / "fx.csv").write_text("Settlement ID,Exchange Value\n1,17.5\n1,17.6\n")
    with pytest.raises(Exception, match="exchange rates: more than one row for settlement_id = 1"):
        feeds.read_fx_rates(spark, str(tmp_path / "fx.csv")).collect()


def test_bad_lines_do_not_land(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("k,v\nx,1\ny,one\n")
    where = [str(tmp_path / n) for n in ("in", "landing", "state")]
    ingest_new_files(spark, where[0], "k string, v int", where[1], where[2])
    assert [tuple(r) for r in spark.read.parquet(where[1]).collect()] == [("x", 1)]
    assert [r["faults"] for r in spark.read.parquet(where[1] + "-rejects").collect()] == ["v"]


def test_shrinking_settlement_leaves_nothing_behind(spark, tmp_path):
    incoming, landing, state, target, state2 = (str(tmp_path / n) for n in ("incoming", "landing", "state", "target", "state2"))
    schema = "settlement_id int, currency string, amount int"
    # a currency whose amounts cancel out yields no row
    job = lambda lines: lines.groupBy("settlement_id", "currency").agg(F.sum("amount").alias("total")).where("total <> 0")
    for rows in ([(1, "USD", 5), (1, "CAD", 2), (2, "USD", 7), (3, "USD", 1)], [(1, "CAD", -2), (2, "USD", -7)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").options(**feeds.CSV_WRITE).csv(incoming)
        ingest_new_files(spark, incoming, schema, landing, state, partitions=["settlement_id"])
        refresh_settlements(spark, landing, schema, target, state2, job, ["settlement_id"], landed_by="settlement_id")
    assert sorted((r["settlement_id"], r["currency"], r["total"]) for r in spark.read.parquet(target).where('not _gone').collect()) == [(1, "USD", 5), (3, "USD", 1)]


def test_a_feed_with_rejects_fails_unless_allowed(spark, tmp_path):
    (tmp_path / "WAREHOUSES.csv").write_text("warehouse,exclude,priority\n297,X,1\n297A,X,2\n298,,\n299,X\n")
    with pytest.raises(feeds.RejectedRows) as failed:
        feeds.read_warehouse_override(spark, str(tmp_path))
    assert failed.value.counts["rows"] == 4 and failed.value.counts["rejected"] == 2
    assert "warehouse 1" in str(failed.value) and "_broken_record 1" in str(failed.value)
    # what was refused stays stored
    kept = spark.read.parquet(failed.value.stored).where("_rejected = 'true'").collect()
    assert any("297A" in r["_record"] for r in kept) and len(kept) == 2
    assert sorted(r["warehouse"] for r in feeds.read_warehouse_override(spark, str(tmp_path), max_share=0.5).collect()) == [297, 298]
    with pytest.raises(feeds.RejectedRows):
        feeds.read_warehouse_override(spark, str(tmp_path), max_share=0.49)


def test_a_feed_is_read_once_for_rows_rejects_and_counts(spark, tmp_path):
    (tmp_path / "rates.csv").write_text("Settlement ID,Exchange Value\n1,17.5\nx,18\n2,y\nz,w\n")
    feed = feeds.load_feed(spark, str(tmp_path / "rates.csv"), feeds.FX_SCHEMA, max_share=1.0)
    # the file may go: nothing reads it again
    (tmp_path / "rates.csv").unlink()
    assert [r["settlement_id"] for r in feed.rows.collect()] == [1]
    assert sorted(r["faults"] for r in feed.rejects.collect()) == ["exchange_value", "settlement_id", "settlement_id,exchange_value"]
    assert {r["fault"]: r["rows"] for r in feed.counted().collect()} == {"settlement_id": 2, "exchange_value": 2}
    assert (feed.counts["rows"], feed.counts["rejected"]) == (4, 3)


def test_a_feed_of_a_header_alone_is_empty(spark, tmp_path):
    (tmp_path / "rates.csv").write_text("settlement_id,exchange_value\n")
    feed = feeds.load_feed(spark, str(tmp_path / "rates.csv"), feeds.FX_SCHEMA)
    assert feed.rows.count() == 0 and feed.rejects.count() == 0 and feed.counts["rows"] == 0


def test_replaced_keys_lose_their_rows_also_null_ones(spark, tmp_path):
    schema = "k string, n bigint, v string"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    path, keys = str(tmp_path / "table"), ["k", "n"]
    first = rows(("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 3, "p"), (None, None, "q"), ("a/b =", 4, "r"))
    sinks.replace_keys(first, first, path, keys)
    read = lambda: sorted(map(tuple, sinks.read_keyed(spark, path, first.schema).collect()), key=str)
    assert read() == sorted(map(tuple, first.collect()), key=str)
    for _ in range(2):
        # null keys and one with odd characters get no rows any more, one key gets other rows, one is not touched
        sinks.replace_keys(rows(("a", 1, "w")), rows(("a", 1, ""), (None, 3, ""), (None, None, ""), ("a/b =", 4, ""), ("new", 9, "")), path, keys)
        assert read() == [("a", 1, "w"), ("b", 2, "z")]
    sinks.replace_keys(rows((None, 3, "back")), rows((None, 3, "")), path, keys)
    assert read() == sorted([("a", 1, "w"), ("b", 2, "z"), (None, 3, "back")], key=str)


def test_a_job_that_fails_leaves_the_old_rows(spark, tmp_path):
    schema = "k string, v int"
    path = str(tmp_path / "table")
    first = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    sinks.replace_keys(first, first, path, ["k"])
    broken = first.select("k", F.when(F.col("k") == "b", F.raise_error(F.lit("no")).cast("int")).otherwise(F.lit(7)).alias("v"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_keys(broken, first, path, ["k"])
    assert sorted(map(tuple, sinks.read_keyed(spark, path, first.schema).collect())) == [("a", 1), ("b", 2)]


def test_exported_settlements_are_known_by_their_file_names(spark, tmp_path):
    for name in ("Settlements Data 2021-01-01 - 2021-01-14 acct_0 77.csv", "Settlements Data 2021-01-01 - 2021-01-14 acct_1 78.csv", "desktop.ini", "Settlements Data acct_0.csv"):
        (tmp_path / name).write_text("x\n")
    found = {tuple(map(str, r)) for r in feeds.exported_statements(spark, str(tmp_path)).collect()}
    assert found == {("acct_0", "77", "2021-01-01", "2021-01-14"), ("acct_1", "78", "2021-01-01", "2021-01-14")}
    assert feeds.exported_statements(spark, str(tmp_path / "missing")).count() == 0


def test_sheets_with_unlike_headers_are_read_by_name(spark, tmp_path):
    (tmp_path / "North 1.csv").write_text('Code,Name\n1,"a, b"\n2,\n')
    (tmp_path / "South.csv").write_text("City , CODE\nx,3\n")
    (tmp_path / "Empty.csv").write_text("Code,Name\n")
    df = feeds.union_sheets(spark, str(tmp_path), ["code", "name", "city"])
    assert sorted(map(tuple, df.collect()), key=str) == [("North 1", "1", "a, b", None), ("North 1", "2", None, None), ("South", "3", None, "x")]
    with pytest.raises(Exception, match="more than 1 columns"):
        feeds.union_sheets(spark, str(tmp_path), ["code"], max_columns=1).collect()


def test_profile_of_numbers_no_decimal_holds(spark):
    df = spark.createDataFrame([(1e40, "123456789012345678901234567890", "1e400", 0.5), (float("nan"), "1", "2", -1e300), (None, None, None, 2.0)], "a double, b string, c string, d double")
    got = {r["column_name"]: (r["target_type"], r["max_length"], r["null_count"]) for r in quality.profile_column_types(df).collect()}
    # 1e400 is no number that anything here holds, so its column stays text
    assert got == {"a": ("DOUBLE", 41, 2), "b": ("NUMERIC(38,2)", 30, 1), "c": ("VARCHAR(10)", 5, 1), "d": ("DOUBLE", 304, 0)}


def test_profile_states_merge(spark):
    rows = [(str(i) if i % 3 else "x" * i, i * 0.25, None if i % 4 else i) for i in range(40)]
    df = spark.createDataFrame(rows, "a string, b double, c int")
    parts = [quality.profile_state(df.where(f"b % 3 {op}")) for op in ("< 1", "between 1 and 1.99", ">= 2")]
    merged = quality.profile_types(quality.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, quality.profile_column_types(df).collect()))
    with pytest.raises(Exception, match="different types"):
        quality.merge_states(quality.profile_state(df).unionByName(quality.profile_state(df.selectExpr("cast(b as string) as b")))).collect()
