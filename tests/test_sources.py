import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from histload.functions.paths import with_paths
from histload.sources import control
from histload.sources.contracts import build_contracts, schema_for, with_contract
from histload.sources.delimited import read_delimited, read_numbered
from histload.sources.history import (
    append_evolving,
    read_evolving,
    read_history,
    read_open,
    write_load,
    write_parts,
)
from tests.fixtures import CONTRACT, CONTRACT_SCHEMA, FEEDS_SCHEMA


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def contracts(spark, columns, feeds):
    return build_contracts(
        spark.createDataFrame(columns, CONTRACT_SCHEMA), spark.createDataFrame(feeds, FEEDS_SCHEMA)
    )


def test_roles_and_schema_of_a_contract(spark):
    row = contracts(spark, CONTRACT[::-1], [(1, "DELIMITED", "date_loaded,other")]).first()
    assert row["key_cols"] == ["customerId"] and row["key_col"] == "customerId"
    assert row["defining_cols"] == ["createdOn"] and row["defining_col"] == "createdOn"
    assert row["data_cols"] == ["address", "city"]
    assert row["partition_cols"] == ["date_loaded", "other"]
    assert row["partition_col"] == "date_loaded"
    assert row["problem"] is None
    assert schema_for(row) == StructType(
        [
            StructField("customerId", IntegerType(), True),
            StructField("address", StringType(), True),
            StructField("city", StringType(), True),
            StructField("createdOn", TimestampType(), True),
        ]
    )


def test_contracts_that_cannot_be_loaded(spark):
    columns = [
        (2, "a", "NoSuchType", 0, 0, "Y", "N"),
        (3, "a", "StringType", 1, 0, "Y", "N"),
        (4, "a", "StringType", 0, 0, "N", "N"),
        (5, "odd `name`, x", "decimal(12,2)", 0, 0, "Y", "Y"),
        (5, "b.c", "DecimalType", 1, 0, "N", None),
        (6, "a", "StringType", 0, 0, "Y", "N"),
    ]
    feeds = [(i, "DELIMITED", "d") for i in range(2, 6)]
    feeds += [(6, "JSON", "d"), (7, "DELIMITED", "d")]
    rows = {r["fp_id"]: r for r in contracts(spark, columns, feeds).collect()}
    assert {fp_id: row["problem"] for fp_id, row in rows.items()} == {
        2: "unknown type for a",
        3: "no key column",
        4: "no defining column",
        5: None,
        6: "file format is not DELIMITED",
        7: "no columns in the contract",
    }
    assert schema_for(rows[5]).fields == [
        StructField("odd `name`, x", DecimalType(12, 2)),
        StructField("b.c", DecimalType(10, 0)),
    ]
    with pytest.raises(ValueError, match="no key"):
        schema_for(rows[3])
    files = spark.createDataFrame([(1, 5), (2, 99)], "file_process_id int, fp_id bigint")
    joined = with_contract(files, contracts(spark, columns, feeds))
    assert plain(joined.select("file_process_id", "problem")) == [(1, None), (2, "unknown feed")]


def test_delimited_rows_by_position_with_bad_text_as_null(spark, tmp_path):
    path = tmp_path / "a_1.csv"
    path.write_text("x,y,z\n1,one,2020-01-01 4:26\nbad,two,never\n,,\n")
    df = read_delimited(spark, str(path), "id int, name string, at timestamp")
    assert df.columns == ["id", "name", "at"]
    rows = [tuple(map(str, row)) for row in df.collect()]
    assert rows == [
        ("1", "one", "2020-01-01 04:26:00"),
        ("None", "two", "None"),
        ("None", "None", "None"),
    ]
    assert df.count() == 3  # rows that do not fit count as well
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_delimited(spark, str(path), "id int, name string, at timestamp", True).collect()


def test_decimal_without_precision_rounds(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("d\n1.5\n12345678901\n")
    assert plain(read_delimited(spark, str(path), "d decimal(10,0)").selectExpr("string(d)")) == [
        ("2",), (None,)
    ]


def test_rows_know_their_file(spark, tmp_path):
    folder = tmp_path / "in dir+x%y"
    folder.mkdir()
    names = ["a b+c%20d_1.csv", "plain_2.csv"]
    for place, name in enumerate(names):
        (folder / name).write_text(f"a,b\n{place},x\n{place},y\n")
    written = str(folder / "as folder_3.csv")
    spark.range(5).selectExpr("2 a", "'z' b").repartition(3).write.option("header", True).csv(
        written
    )
    files = [(f"file://{folder}/{names[0]}", 0), (f"{folder}/{names[1]}", 1), (written + "/", 2)]
    df = read_numbered(spark, files, "a int, b string", "seq")
    assert df.columns == ["a", "b", "seq"]
    assert df.where("a <> seq").count() == 0
    assert plain(df.groupBy("seq").count()) == [(0, 2), (1, 2), (2, 5)]


def test_paths(spark):
    files = spark.createDataFrame(
        [
            ("landing-eu", "in/sales_20240101.csv"),
            ("my-landing-landing", "sales_1_2_33xcsv"),
            ("other", "a/b/c.csv"),
        ],
        "bucket_name string, filename string",
    )
    assert [tuple(r)[2:] for r in with_paths(files).collect()] == [
        ("s3a://landing-eu/in/sales_20240101.csv", "s3a://raw-eu/sales.parquet"),
        ("s3a://my-landing-landing/sales_1_2_33xcsv", "s3a://my-raw-raw/sales_1_2.parquet"),
        ("s3a://other/a/b/c.csv", "s3a://other/c.csv.parquet"),
    ]


def test_append_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    append_evolving(spark.createDataFrame([(1, "007")], "a int, date_loaded string"), path)
    append_evolving(
        spark.createDataFrame([(2, "x", "2024-01-01")], "a int, b string, date_loaded string"),
        path,
    )
    df = read_evolving(spark, path)
    assert df.schema["date_loaded"].dataType == StringType()
    assert plain(df.select("a", "b", "date_loaded")) == [(1, None, "007"), (2, "x", "2024-01-01")]


def test_history_parts(spark, tmp_path):
    path = str(tmp_path / "h")
    schema = "id int, startDate int, endDate int, date_loaded string"
    first = spark.createDataFrame([(1, 1, 2, "d1"), (1, 2, None, "d1"), (2, 1, None, "d1")], schema)
    write_load(first, path, "l1")
    failed = spark.createDataFrame([(9, 9, 9, "d9")], schema)
    write_load(failed, path, "l2")
    second = spark.createDataFrame(
        [(1, 2, 3, "d1", None), (1, 3, None, "d2", "n"), (2, 1, None, "d1", None)],
        schema + ", extra string",
    )
    write_load(second, path, "l3")
    columns = ["id", "startDate", "endDate", "date_loaded", "extra"]
    assert plain(read_history(spark, path, ["l1", "l3"]).select(columns)) == [
        (1, 1, 2, "d1", None),
        (1, 2, 3, "d1", None),
        (1, 3, None, "d2", "n"),
        (2, 1, None, "d1", None),
    ]
    assert read_history(spark, path, ["l1"]).count() == 3


@pytest.mark.parametrize("in_place", [True, False])
def test_parts_of_a_load(spark, tmp_path, in_place):
    path = str(tmp_path / "h")
    schema = "id int, startDate int, endDate int, date_loaded string"
    kept = spark.createDataFrame([(i, 1, None, f"d{i % 5}") for i in range(40)], schema)
    moved = spark.createDataFrame(
        [(i, 1, 2, f"d{i % 5}", "x") for i in range(40, 50)] + [(40, 2, None, "d9", "y")],
        schema + ", extra string",
    )
    kept, moved = kept.repartition(4), moved.repartition(4)
    if in_place:
        write_parts(kept, moved, path, "l1")
    else:
        rows = kept.unionByName(moved, allowMissingColumns=True)
        write_load(rows, path, "l1", many_dates=True)
    assert read_open(spark, path, "l1").count() == 41
    assert read_history(spark, path, ["l1"]).count() == 51
    closed_files = list((tmp_path / "h" / "history_load=l1" / "history_state=closed").rglob("*.parquet"))
    assert len(closed_files) == 5  # one per date, whatever the number of tasks


STEPS = "step_id string, file_process_id bigint, step_name string, step_status string, s int, e int"


def steps(spark, rows):
    return spark.createDataFrame(rows, STEPS).selectExpr(
        "*",
        "timestamp_seconds(s) step_start_ts",
        "timestamp_seconds(e) step_end_ts",
        "timestamp_seconds(e) upsert_ts",
    )


def test_pending_files(spark):
    files = spark.createDataFrame(
        [(i, 1, f"f_{i}.csv", "landing") for i in range(1, 7)],
        "file_process_id bigint, fp_id bigint, filename string, bucket_name string",
    )
    log = [
        ("r1", 1, "File Registration", "DONE", 10, 11),
        ("r2", 2, "File Registration", "DONE", 10, 12),
        ("r3", 3, "File Registration", "ERROR", 10, 90),
        ("r4", 4, "File Registration", "DONE", 10, 50),
        ("r5", 5, "Other Step", "DONE", 10, 90),
        ("l1", 1, "History Load", "ERROR", 60, 61),
    ]
    waiting = lambda rows, mode: [
        r[0] for r in plain(control.pending_files(files, steps(spark, rows), mode))
    ]
    # No load has succeeded yet: every registered file waits, tried before or not.
    assert waiting(log, "high_watermark") == [1, 2, 4]
    assert waiting(log, "per_file") == [1, 2, 4]
    # One success: only what was registered after its start; the failed file is passed over.
    log.append(("l2", 2, "History Load", "DONE", 30, 31))
    assert waiting(log, "high_watermark") == [4]
    assert waiting(log, "per_file") == [1, 4]
    with pytest.raises(ValueError):
        control.pending_files(files, steps(spark, log), "other")


def test_step_log(spark, tmp_path):
    store = control.FolderControl(spark, str(tmp_path / "control"))
    files = spark.createDataFrame(
        [(1, "raw/a"), (2, "raw/a"), (3, "raw/b")], "file_process_id bigint, target_path string"
    )
    store.append(control.STEP_LOG, control.log_start(files, "run1"))
    current = control.current_steps(store.table(control.STEP_LOG))
    assert plain(current.select("step_id", "step_status", "step_status_detail")) == [
        (f"run1-{i}", "IN-PROGRESS", "running") for i in (1, 2, 3)
    ]
    message = "it's a \"quoted\" failure"
    results = spark.createDataFrame(
        [
            ("run1-1", 1, "raw/a", "l1", "Success", ""),
            ("run1-2", 2, "raw/a", "l1", "Failed", message),
        ],
        "step_id string, file_process_id bigint, target_path string, load_id string, "
        "status string, message string",
    ).withColumns({"start": F.current_timestamp(), "end": F.current_timestamp()})
    store.append(control.STEP_LOG, control.log_finish(results))
    current = control.current_steps(store.table(control.STEP_LOG))
    assert plain(current.select("step_id", "step_status", "step_status_detail", "load_id")) == [
        ("run1-1", "DONE", "Completed Successfully", "l1"),
        ("run1-2", "ERROR", message, None),
        ("run1-3", "IN-PROGRESS", "running", None),
    ]
    assert plain(control.done_loads(current)) == [("raw/a", "l1")]
