"""Whole runs over registered files in a temporary folder."""

import pytest
from pyspark.sql import functions as F

from histload.names import DONE, STEP_REGISTRATION
from histload.operators.audit import with_audit_columns
from histload.operators.scd2 import merge_next
from histload.plans.loads import (
    AmbiguousBatch,
    Feed,
    LoadOptions,
    load_batch,
    run_pending,
    table_history,
)
from histload.sources import control
from histload.sources.history import read_history
from tests.fixtures import (
    AFTER_FULL_LOAD,
    AFTER_INCREMENT,
    CONTRACT,
    CONTRACT_SCHEMA,
    FEEDS_SCHEMA,
    FULL_LOAD,
    INCREMENT,
)

HEADER = "customerId,address,city,createdOn"
FEED = Feed(
    "customerId int, address string, city string, createdOn timestamp",
    "customerId",
    "createdOn",
    ("address", "city"),
)
OPTIONS = LoadOptions(load_date="2021-07-20")


def timed(rows):
    """Expected rows with their dates as the timestamps they are read as."""
    def clock(text):
        if text is None:
            return None
        day, time = text.split()
        return f"{day} {time.zfill(5)}:00"

    return sorted((str(k), clock(s), str(clock(e)), h) for k, s, e, h in rows)


def summary(history):
    rows = history.selectExpr(
        "string(customerId)", "string(startDate)", "string(endDate)", "left(hashData, 8)"
    ).collect()
    return sorted((r[0], str(r[1]), str(r[2]), r[3]) for r in rows)


class Landing:
    """A landing folder and control tables, with files registered one after another."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.store = control.FolderControl(spark, f"{root}/control")
        (root / "landing" / "in").mkdir(parents=True)
        self.moment = 0
        self.store.append(
            control.FEEDS,
            spark.createDataFrame(
                [(1, "DELIMITED", "date_loaded"), (2, "JSON", "date_loaded")], FEEDS_SCHEMA
            ),
        )
        columns = spark.createDataFrame(CONTRACT, CONTRACT_SCHEMA)
        self.store.append(control.COLUMNS, columns.withColumnRenamed("fp_id", "fp_detail_id"))

    def write(self, name, rows, header=HEADER):
        lines = [header, *(",".join("" if v is None else v for v in row) for row in rows)]
        (self.root / "landing" / "in" / name).write_text("\n".join(lines) + "\n")

    def register(self, file_id, name, fp_id=1):
        self.moment += 1
        log = self.spark.createDataFrame(
            [(file_id, fp_id, f"in/{name}", f"{self.root}/landing")],
            "file_process_id bigint, fp_id bigint, filename string, bucket_name string",
        )
        self.store.append(control.FILE_LOG, log)
        at = F.timestamp_seconds(F.lit(1_600_000_000 + self.moment))
        steps = log.select(
            F.concat(F.lit("r"), "file_process_id").alias("step_id"),
            "file_process_id",
            F.lit(STEP_REGISTRATION).alias("step_name"),
            F.lit(DONE).alias("step_status"),
            F.lit("").alias("step_status_detail"),
            at.alias("step_start_ts"),
            at.alias("step_end_ts"),
            F.lit("test").alias("upsert_by"),
            at.alias("upsert_ts"),
            F.lit(None).cast("string").alias("target_path"),
            F.lit(None).cast("string").alias("load_id"),
        )
        self.store.append(control.STEP_LOG, steps)

    def add(self, file_id, name, rows, **options):
        self.write(name, rows, **options)
        self.register(file_id, name)

    def run(self, options=OPTIONS, **more):
        report = run_pending(self.spark, self.store, options, scheme="", **more).collect()
        return {row["file_process_id"]: row for row in report}

    def history(self, name="customer"):
        return table_history(self.spark, self.store, f"{self.root}/raw/{name}.parquet")


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_two_files_in_one_run(landing):
    landing.add(1, "customer_20210720.csv", FULL_LOAD)
    landing.add(2, "customer_20210721.csv", INCREMENT)
    report = landing.run()
    assert {i: (r["status"], r["message"], r["count"]) for i, r in report.items()} == {
        1: ("Success", "", 4),
        2: ("Success", "", 3),
    }
    assert summary(landing.history()) == timed(AFTER_INCREMENT)
    assert landing.run() == {}  # nothing waits any more


@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_one_file_per_run(landing, monkeypatch, broadcast_rows):
    monkeypatch.setattr("histload.operators.skew.BROADCAST_ROWS", broadcast_rows)
    landing.add(1, "customer_20210720.csv", FULL_LOAD)
    landing.run()
    assert summary(landing.history()) == timed(AFTER_FULL_LOAD)
    landing.add(2, "customer_20210721.csv", INCREMENT)
    landing.run(LoadOptions(load_date="2021-07-21"))
    history = landing.history()
    assert summary(history) == timed(AFTER_INCREMENT)
    dates = {(r["customerId"], r["hashData"][:8]): r["date_loaded"] for r in history.collect()}
    assert dates[(1, "46dbc169")] == "2021-07-20"  # closed later, but arrived then
    assert dates[(4, "8662a510")] == "2021-07-21"
    if broadcast_rows:
        landing.add(3, "customer_20210722.csv", INCREMENT)  # the same rows again: no change
        landing.run()
        assert summary(landing.history()) == timed(AFTER_INCREMENT)


@pytest.mark.parametrize("broadcast_rows", [0, 500_000])
def test_files_folded_onto_a_table(landing, monkeypatch, broadcast_rows):
    monkeypatch.setattr("histload.operators.skew.BROADCAST_ROWS", broadcast_rows)
    landing.add(1, "customer_1.csv", FULL_LOAD)
    landing.run()
    landing.add(2, "customer_2.csv", INCREMENT[:2])
    landing.add(3, "customer_3.csv", INCREMENT[2:])
    landing.run()
    assert summary(landing.history()) == timed(AFTER_INCREMENT)


def test_bad_files_fail_alone_and_wait(landing):
    twice = [("1", "x", "y", "2022-01-01"), ("1", "z", "y", "2022-01-02")]
    landing.add(1, "customer_1.csv", FULL_LOAD)
    landing.add(2, "customer_2.csv", twice)
    landing.register(3, "customer_3.csv")  # never written
    landing.register(4, "customer_4.csv", fp_id=2)
    landing.register(5, "customer_5.csv", fp_id=77)
    landing.add(6, "customer_6.csv", INCREMENT)
    report = landing.run()
    assert {i: r["status"] for i, r in report.items()} == {
        1: "Success", 2: "Failed", 3: "Failed", 4: "Failed", 5: "Failed", 6: "Success"
    }
    assert report[2]["message"] == "2 rows for the open key customerId = 1"
    assert "PATH_NOT_FOUND" in report[3]["message"]
    assert report[4]["message"] == "file format is not DELIMITED"
    assert report[5]["message"] == "unknown feed"
    assert summary(landing.history()) == timed(AFTER_INCREMENT)
    steps = control.current_steps(landing.store.table(control.STEP_LOG)).where(
        "step_name = 'History Load'"
    )
    assert {r["file_process_id"]: r["step_status"] for r in steps.collect()} == {
        1: "DONE", 2: "ERROR", 3: "ERROR", 4: "ERROR", 5: "ERROR", 6: "DONE"
    }
    landing.write("customer_3.csv", [("7", "late", "file", "2022-01-01")])
    assert set(landing.run()) == {2, 3, 4, 5}  # failed files are tried again
    assert landing.history().where("customerId = 7").count() == 1


def test_a_file_clashing_only_with_a_rejected_one_loads(landing):
    landing.add(1, "customer_1.csv", FULL_LOAD)
    landing.add(2, "customer_2.csv", [
        ("1", "x", "y", "2022-01-01"), ("1", "z", "y", "2022-01-02"), ("8", "a", "b", "2022-01-01")
    ])
    landing.add(3, "customer_3.csv", [("8", "c", "d", "2022-01-01"), ("8", "e", "f", "2022-01-02")])
    report = landing.run()
    assert {i: r["status"] for i, r in report.items()} == {1: "Success", 2: "Failed", 3: "Success"}
    assert landing.history().where("customerId = 8").count() == 2


def test_wrong_header_fails_alone(landing):
    landing.add(1, "customer_1.csv", FULL_LOAD)
    landing.add(2, "customer_2.csv", INCREMENT, header="id,address,city,createdOn")
    report = landing.run(LoadOptions(load_date="2021-07-20", check_header=True))
    assert report[1]["status"] == "Success" and report[2]["status"] == "Failed"
    assert summary(landing.history()) == timed(AFTER_FULL_LOAD)


def test_empty_files(landing):
    landing.add(1, "customer_1.csv", [])
    assert landing.run()[1]["status"] == "Success"
    landing.add(2, "customer_2.csv", FULL_LOAD)
    landing.add(3, "customer_3.csv", [])
    assert {i: r["count"] for i, r in landing.run().items()} == {2: 4, 3: 0}
    assert summary(landing.history()) == timed(AFTER_FULL_LOAD)


def test_undated_rows_are_merged_one_by_one(landing, spark):
    files = [
        [("1", "a", "b", "2020-01-01")],
        [("1", "c", "d", None)],
        [("1", "e", "f", "2022-01-01")],
    ]
    for place, rows in enumerate(files, 1):
        landing.add(place, f"customer_{place}.csv", rows)
    report = landing.run()
    assert [report[i]["undated"] for i in (1, 2, 3)] == [0, 1, 0]
    history = None
    for rows in files:
        df = spark.createDataFrame(rows, "customerId string, address string, city string, at string")
        df = df.selectExpr("int(customerId) customerId", "address", "city", "timestamp(at) createdOn")
        batch = with_audit_columns(df, "customerId", ["address", "city"], "createdOn")
        history = batch if history is None else merge_next(history, batch, "customerId")
    assert summary(landing.history()) == summary(history)
    # The table now has two open rows for the key; later files meet both.
    landing.add(4, "customer_4.csv", [("1", "g", "h", "2023-01-01")])
    landing.add(5, "customer_5.csv", [("1", "i", "j", "2024-01-01")])
    landing.run()
    opened = landing.history().where("endDate is null").select("address").collect()
    assert [row[0] for row in opened] == ["i", "i"]


def test_hot_keys_in_a_run(landing, spark, tmp_path):
    versions = [("1", f"street {i % 7}", "town", f"2020-01-01 {i:02d}:00") for i in range(24)]
    others = [(str(i), "a", "b", "2020-01-01") for i in range(2, 12)]
    landing.add(1, "customer_1.csv", versions + others)
    landing.add(2, "customer_2.csv", [("1", "new", "town", "2021-01-01"), ("2", "c", "d", "2021")])
    landing.add(3, "customer_3.csv", [("3", "c", "d", "2021-01-01")])
    landing.run(LoadOptions(load_date="2021-07-20", rows_per_slice=5))
    whole = Landing(spark, tmp_path / "whole")
    for name in ("customer_1.csv", "customer_2.csv", "customer_3.csv"):
        text = (tmp_path / "landing" / "in" / name).read_text()
        (whole.root / "landing" / "in" / name).write_text(text)
        whole.register(int(name[9]), name)
    whole.run()
    assert summary(landing.history()) == summary(whole.history())


def test_high_watermark_mode(landing):
    landing.add(1, "customer_1.csv", FULL_LOAD)
    landing.register(2, "customer_2.csv")
    landing.run(mode="high_watermark")
    landing.write("customer_2.csv", INCREMENT)
    assert landing.run(mode="high_watermark") == {}  # passed over
    assert set(landing.run(mode="per_file")) == {2}


def test_columns_named_like_internals(spark, tmp_path):
    """A key called n, and data columns called state, load_id and rows."""
    feed = Feed("n int, state string, load_id string, rows int, at date", "n", "at", ("state",))
    target = str(tmp_path / "history")
    for load, state in (("l1", "NY"), ("l2", "TX")):
        path = tmp_path / f"{load}.csv"
        path.write_text(f"n,state,load_id,rows,at\n1,{state},x,5,2024-01-01\n2,NY,y,6,2024-01-01\n")
        load_batch(spark, str(path), feed, target, load, ["l1"] if load == "l2" else [], OPTIONS)
    history = read_history(spark, target, ["l1", "l2"])
    rows = history.select("n", "state", "load_id", "rows").collect()
    assert sorted(map(tuple, rows)) == [(1, "NY", "x", 5), (1, "TX", "x", 5), (2, "NY", "y", 6)]


def test_load_batch_on_its_own(spark, tmp_path):
    path, target = tmp_path / "full.csv", str(tmp_path / "history")
    lines = [HEADER, *(",".join(row) for row in FULL_LOAD)]
    path.write_text("\n".join(lines))
    assert load_batch(spark, str(path), FEED, target, "l1", options=OPTIONS) == 4
    with pytest.raises(AmbiguousBatch, match="2 rows for the open key customerId = 1"):
        load_batch(spark, str(path), FEED, target, "l2", ["l1"], OPTIONS)
    assert summary(read_history(spark, target, ["l1"])) == timed(AFTER_FULL_LOAD)
