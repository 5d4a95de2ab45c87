"""One query per operator, over the test tables; ``oracle`` has the same queries in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from histload.functions.hashing import row_hash
from histload.functions.paths import with_paths
from histload.names import DONE, ERROR, FAILED, STEP_LOAD, STEP_REGISTRATION, SUCCESS
from histload.operators import scd2
from histload.operators.audit import with_audit_columns, with_hashes
from histload.operators.fold import (
    ambiguous_batches,
    batch_census,
    fold_batches,
    fold_next,
    fold_odd_batches,
)
from histload.operators.skew import ROWS, UNIQUE_KEYS, HotKeys, find_hot_keys, group_sizes
from histload.plans.loads import (
    Feed,
    LoadOptions,
    first_load,
    load_batch,
    load_files,
    merge_load,
    quarantined_lines,
    run_pending,
    table_history,
)
from histload.session import scratch_path
from histload.sources import control
from histload.sources.contracts import build_contracts, with_contract
from histload.sources.delimited import read_delimited
from histload.sources.differences import read_open_rows, read_table, rebase
from histload.sources.history import append_evolving, read_evolving, read_history, read_open

# Fixed values, the same in the SQL: load date and cut-over day of the test loads.
LOAD_DATE = "2024-02-01"
CUT_OVER = "2024-01-16"

ORDERS_DDL = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
NTZ_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a written table, for inputs that a merge reads several times."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("timestampNTZFormat", NTZ_TEXT).csv(path)
    return path


# --- batches the queries share ---------------------------------------------------------------


def audited_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one batch of customer versions."""
    orders = table(spark, sf_dir, "orders")
    return with_audit_columns(
        orders,
        key="o_custkey",
        data_cols=["o_orderstatus", "o_orderpriority"],
        defining="o_orderdate",
        load_date=LOAD_DATE,
        tiebreak=["o_orderkey"],
    )


def _audited_events(
    events: DataFrame, load_date: str = LOAD_DATE, hot: HotKeys | None = None
) -> DataFrame:
    return with_audit_columns(
        events,
        key="user_id",
        data_cols=["event_type"],
        defining="ts",
        load_date=load_date,
        tiebreak=["event_id"],
        hot=hot,
    )


def _last_per(events: DataFrame, *keys: str | Column) -> DataFrame:
    latest = Window.partitionBy(*keys).orderBy(F.desc("ts"), F.desc("event_id"))
    ranked = events.withColumn("__rank", F.row_number().over(latest))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def events_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load: every event before the cut-over, as versions of its user."""
    events = table(spark, sf_dir, "events").where(F.col("ts") < ntz(CUT_OVER))
    return _audited_events(events)


def history_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(events_before(spark, sf_dir))


def events_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Increment: each user's last event from the cut-over on."""
    events = table(spark, sf_dir, "events").where(F.col("ts") >= ntz(CUT_OVER))
    return _audited_events(_last_per(events, "user_id"), "2024-02-02", hot=UNIQUE_KEYS)


def batch_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(events_after(spark, sf_dir))


def _daily(events: DataFrame) -> DataFrame:
    """Each user's last event of the day; the day numbers the batches."""
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    last = _last_per(events.withColumn("day_no", day), "user_id", "day_no")
    return with_hashes(last, "user_id", ["event_type"], "ts", load_date=LOAD_DATE)


# --- hashes and audit columns ----------------------------------------------------------------


def hash_columns(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        row_hash(["o_custkey"]).alias("hashKey"),
        row_hash(["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]).alias(
            "hashData"
        ),
    )


def documents_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", row_hash(["text", "lang", "source"]).alias("hashData")
    )


def audit_columns(spark, sf_dir):
    return audited_orders(spark, sf_dir)


def hash_key_columns(spark, sf_dir):
    """Key hashes of two columns, on rows these do not tell apart."""
    rows = with_hashes(
        table(spark, sf_dir, "lineitem"),
        key="l_orderkey",
        data_cols=["l_returnflag", "l_linestatus"],
        defining="l_shipdate",
        load_date=LOAD_DATE,
        hash_key_cols=["l_orderkey", "l_linenumber"],
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "hashKey", "hashData", "startDate", "date_loaded"
    )


def audit_columns_hot_key(spark, sf_dir):
    """Five keys hold all rows, so each is cut into slices."""
    return with_audit_columns(
        table(spark, sf_dir, "orders"),
        key="o_orderpriority",
        data_cols=["o_orderstatus"],
        defining="o_orderdate",
        load_date=LOAD_DATE,
        tiebreak=["o_orderkey"],
        rows_per_slice=400,
    )


def current_rows(spark, sf_dir):
    return scd2.current_rows(audited_orders(spark, sf_dir))


# --- merges ----------------------------------------------------------------------------------


def changed_rows(spark, sf_dir):
    return scd2.changed_rows(
        batch_after(spark, sf_dir), history_before(spark, sf_dir), "user_id", UNIQUE_KEYS
    )


def staged_updates(spark, sf_dir):
    return scd2.stage_updates(
        batch_after(spark, sf_dir), history_before(spark, sf_dir), "user_id", UNIQUE_KEYS
    )


def scd2_merge(spark, sf_dir):
    history, batch = history_before(spark, sf_dir), batch_after(spark, sf_dir)
    return scd2.merge_next(history, batch, "user_id", UNIQUE_KEYS)


def scd2_merge_broadcast(spark, sf_dir):
    """The same merge, with its keys counted: a small batch is broadcast to the open rows."""
    history, batch = history_before(spark, sf_dir), batch_after(spark, sf_dir)
    counted = find_hot_keys(group_sizes(batch, ["user_id"]))
    return scd2.merge_next(history, batch, "user_id", counted)


def scd2_merge_new_keys(spark, sf_dir):
    """The table knows every segment but one; the batch brings all customers, and the balances
    of another segment have changed."""
    customers = table(spark, sf_dir, "customer").withColumn("asOf", ntz("2024-01-01"))
    changed = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100.5)
    later = customers.withColumns(
        {"c_acctbal": F.coalesce(changed, "c_acctbal"), "asOf": ntz("2024-02-01")}
    )

    def audited(df):
        return with_audit_columns(
            df,
            "c_custkey",
            ["c_acctbal", "c_mktsegment"],
            "asOf",
            load_date=LOAD_DATE,
            hot=UNIQUE_KEYS,
        )

    known = customers.where(F.col("c_mktsegment") != "MACHINERY")
    return scd2.merge_next(stored(audited(known)), stored(audited(later)), "c_custkey", UNIQUE_KEYS)


def scd2_merge_evolving(spark, sf_dir):
    """The batch has a column the table lacks so far."""
    batch = batch_after(spark, sf_dir).withColumn("value_band", F.floor(F.col("value") / 10))
    return scd2.merge_next(history_before(spark, sf_dir), batch, "user_id", UNIQUE_KEYS)


def scd2_merge_key_bits(spark, sf_dir):
    """A batch of some nations' customers that is not broadcast: the bits of its keys tell which of the
    open rows have to meet it in the shuffle."""
    customers = table(spark, sf_dir, "customer").withColumn("asOf", ntz("2024-01-01"))
    some = customers.where(F.col("c_nationkey") < 3)
    later = some.withColumns({"c_acctbal": F.col("c_acctbal") + 100.5, "asOf": ntz("2024-02-01")})
    known, batch = (
        stored(
            with_audit_columns(
                df, "c_custkey", ["c_acctbal", "c_mktsegment"], "asOf", load_date=LOAD_DATE, hot=UNIQUE_KEYS
            )
        )
        for df in (customers, later)
    )
    sizes = group_sizes(batch, ["c_custkey"])
    return scd2.merge_next(known, batch, "c_custkey", find_hot_keys(sizes, broadcast_rows=0))


def _urgent_orders(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(history of the orders by priority without the urgent ones, batch with all urgent ones and another last
    order of each other priority). One key of the batch has nearly all its rows."""
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    latest = Window.partitionBy("o_orderpriority").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    last = orders.where(~urgent).withColumn("rank", F.row_number().over(latest)).where("rank = 1").drop("rank")
    last = last.withColumns({"o_orderstatus": F.lit("X"), "o_orderdate": ntz("1999-01-01")})

    def audited(df):
        return with_audit_columns(
            df, "o_orderpriority", ["o_orderstatus"], "o_orderdate", load_date=LOAD_DATE, tiebreak=["o_orderkey"]
        )

    return stored(audited(orders.where(~urgent))), stored(audited(orders.where(urgent).unionByName(last)))


def scd2_merge_hot_key(spark, sf_dir):
    history, batch = _urgent_orders(spark, sf_dir)
    hot = find_hot_keys(group_sizes(batch, ["o_orderpriority"]), rows_per_slice=400)
    return scd2.merge_next(history, batch, "o_orderpriority", hot)


def ambiguous_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events").where(F.col("ts") >= ntz(CUT_OVER))
    batch = with_hashes(events, "user_id", ["event_type"], "ts", load_date=LOAD_DATE)
    clashes = scd2.ambiguous_keys(batch, history_before(spark, sf_dir), "user_id")
    return clashes.withColumnRenamed(ROWS, "n")


def ambiguous_batches_daily(spark, sf_dir):
    """All events of a day as one batch: days that bring a known user several times."""
    events = table(spark, sf_dir, "events")
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    rows = with_hashes(
        events.withColumn("day_no", day), "user_id", ["event_type"], "ts", load_date=LOAD_DATE
    )
    clashes = ambiguous_batches(batch_census(rows, "day_no", "user_id"), "day_no", "user_id")
    return clashes.withColumnRenamed(ROWS, "n")


# --- folds -----------------------------------------------------------------------------------


def scd2_fold_daily(spark, sf_dir):
    return fold_batches(_daily(table(spark, sf_dir, "events")), "day_no", "user_id")


def scd2_fold_onto_history(spark, sf_dir):
    daily = stored(_daily(table(spark, sf_dir, "events").where(F.col("ts") >= ntz(CUT_OVER))))
    return fold_next(history_before(spark, sf_dir), daily, "day_no", "user_id").drop("day_no")


def scd2_fold_hot_keys(spark, sf_dir):
    """Kinds of events as keys: all events before the cut-over are the first batch, then each day's last
    event of a kind is one. Five keys hold all rows and are cut into slices."""
    events = table(spark, sf_dir, "events")
    before = events.where(F.col("ts") < ntz(CUT_OVER)).withColumn("day_no", F.lit(0))
    after = events.where(F.col("ts") >= ntz(CUT_OVER))
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    after = _last_per(after.withColumn("day_no", day), "event_type", "day_no")
    rows = with_hashes(before.unionByName(after), "event_type", ["user_id"], "ts", load_date=LOAD_DATE)
    return fold_batches(rows, "day_no", "event_type", ["event_id"], rows_per_slice=400)


def fold_undated_rows(spark, sf_dir):
    """Each day's last event of a user as a batch; some have no date, and stay open beside what they met."""
    events = table(spark, sf_dir, "events")
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    last = _last_per(events.withColumn("day_no", day), "user_id", "day_no")
    last = last.withColumn("seen_at", F.when(F.col("event_id") % 11 != 0, F.col("ts")))
    rows = stored(with_hashes(last, "user_id", ["event_type"], "seen_at", load_date=LOAD_DATE))
    odd = rows.where(F.col("seen_at").isNull()).select("user_id")
    return fold_odd_batches(None, rows, "day_no", "user_id", odd_keys=odd)


# --- sources and tables ----------------------------------------------------------------------


def csv_scan(spark, sf_dir):
    path = write_csv(table(spark, sf_dir, "orders"), scratch_path(spark, "orders_csv"))
    return read_delimited(spark, path, ORDERS_DDL, check_header=True)


def batch_count(spark, sf_dir):
    path = write_csv(table(spark, sf_dir, "lineitem"), scratch_path(spark, "lineitem_csv"))
    schema = table(spark, sf_dir, "lineitem").schema
    return read_delimited(spark, path, schema).agg(F.count(F.lit(1)).alias("row_count"))


def append_evolved(spark, sf_dir):
    """Orders appended in two parts; the second has one more column."""
    path = scratch_path(spark, "orders_evolving")
    orders = table(spark, sf_dir, "orders")
    year_1998 = ntz("1998-01-01")
    older = orders.where(F.col("o_orderdate") < year_1998).drop("o_orderpriority")
    newer = orders.where(F.col("o_orderdate") >= year_1998)
    append_evolving(older.withColumn("date_loaded", F.lit("2024-02-01")), path)
    append_evolving(newer.withColumn("date_loaded", F.lit("2024-02-02")), path)
    return read_evolving(spark, path)


def first_load_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "orders_history")
    first_load(audited_orders(spark, sf_dir), path, "load-1")
    return read_history(spark, path, ["load-1"])


def merge_load_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "events_history")
    first_load(events_before(spark, sf_dir), path, "load-1")
    merge_load(events_after(spark, sf_dir), path, "user_id", "load-2", ["load-1"], hot=UNIQUE_KEYS)
    return read_history(spark, path, ["load-1", "load-2"])


def open_rows_after_merge(spark, sf_dir):
    """The open part of the table alone, as the next load reads it."""
    path = scratch_path(spark, "events_history")
    first_load(events_before(spark, sf_dir), path, "load-1")
    merge_load(events_after(spark, sf_dir), path, "user_id", "load-2", ["load-1"], hot=UNIQUE_KEYS)
    return read_open(spark, path, "load-2")


def _difference_loads(spark, sf_dir) -> tuple[str, list[str]]:
    """Events before the cut-over, then three loads of six days each that write what they change."""
    path, loads = scratch_path(spark, "events_differences"), ["load-0"]
    first_load(events_before(spark, sf_dir), path, "load-0")
    events = table(spark, sf_dir, "events").where(F.col("ts") >= ntz(CUT_OVER))
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-16").cast("date"))
    for n in range(3):
        days = events.where((day >= 6 * n) & (day < 6 * n + 6))
        batch = _audited_events(_last_per(days, "user_id"), hot=UNIQUE_KEYS)
        load_id = f"load-{n + 1}-difference"
        merge_load(batch, path, "user_id", load_id, loads)
        loads.append(load_id)
    return path, loads


def difference_loads(spark, sf_dir):
    path, loads = _difference_loads(spark, sf_dir)
    return read_table(spark, path, loads, "user_id")


def difference_loads_open(spark, sf_dir):
    path, loads = _difference_loads(spark, sf_dir)
    return read_open_rows(spark, path, loads, "user_id")


def difference_loads_rebased(spark, sf_dir):
    """The same table after a full load without new rows."""
    path, loads = _difference_loads(spark, sf_dir)
    rebase(spark, path, loads, "load-4", "user_id")
    return read_history(spark, path, [*loads, "load-4"])


def csv_load_batch(spark, sf_dir):
    """Events from delimited files: a first load and a merge."""
    events = table(spark, sf_dir, "events")
    before = write_csv(events.where(F.col("ts") < ntz(CUT_OVER)), scratch_path(spark, "events_csv"))
    after = write_csv(
        _last_per(events.where(F.col("ts") >= ntz(CUT_OVER)), "user_id"),
        scratch_path(spark, "events_csv"),
    )
    feed = Feed(EVENTS_DDL, "user_id", "ts", ("event_type",))
    target = scratch_path(spark, "events_history")
    options = LoadOptions(load_date=LOAD_DATE, tiebreak=("event_id",))
    later = LoadOptions(load_date="2024-02-02", tiebreak=("event_id",))
    load_batch(spark, before, feed, target, "load-1", (), options)
    load_batch(spark, after, feed, target, "load-2", ["load-1"], later)
    return read_history(spark, target, ["load-1", "load-2"])


def quarantine_lines(spark, sf_dir):
    """Orders from a file in which some prices are no numbers: the rows loaded, and the lines put aside."""
    orders, root = table(spark, sf_dir, "orders"), scratch_path(spark, "quarantine")
    text = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice").cast("string")).otherwise("n/a")
    path = write_csv(orders.withColumn("o_totalprice", text), f"{root}/in")
    feed = dict(
        schema_ddl=ORDERS_DDL, key_col="o_custkey", defining_col="o_orderdate", partition_col="date_loaded",
        data_cols=["o_orderstatus", "o_orderpriority"],
    )
    file = Row(file_process_id=7, source_path=path, problem=None, **feed)
    options = LoadOptions(LOAD_DATE, tiebreak=("o_orderkey",), quarantine=f"{root}/aside")
    outcome = load_files(spark, [file], f"{root}/table", "load-1", (), options)[7]
    rows = read_history(spark, f"{root}/table", [outcome.load_id]).select(
        F.lit("loaded").alias("state"), "o_orderkey", F.col("o_totalprice").isNull().alias("no_price")
    )
    line = F.split("line", ",")
    aside = quarantined_lines(spark, options.quarantine).select(
        F.lit("aside").alias("state"), line[0].cast("long").alias("o_orderkey"), (line[3] == "n/a").alias("no_price")
    )
    both = rows.union(aside)
    return both.withColumns({"n_loaded": F.lit(outcome.count), "n_aside": F.lit(outcome.unparsable)}).select(
        "state", "o_orderkey", "no_price",
        F.col("n_loaded").cast("long").alias("n_loaded"), F.col("n_aside").cast("long").alias("n_aside"),
    )


# --- contracts -------------------------------------------------------------------------------


def _contract_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Control tables made of the orders: an order is a feed, its line items are its columns."""
    lines = table(spark, sf_dir, "lineitem")
    datatype = (
        F.when(F.col("l_returnflag") == "A", "IntegerType")
        .when(F.col("l_returnflag") == "N", "StringType")
        .when(F.col("l_quantity") > 45, "BooleanType")
        .otherwise("TimestampType")
    )
    columns = lines.select(
        F.col("l_orderkey").alias("fp_id"),
        F.concat_ws("_", F.lit("c"), "l_linenumber", "l_partkey").alias("col_name"),
        datatype.alias("col_datatype"),
        (F.col("l_linenumber") - 1).alias("col_ordinal"),
        F.when(F.col("l_linestatus") == "O", 0).otherwise(1).alias("primary_key_pos"),
        F.when(F.col("l_discount") > 0.05, "Y").otherwise("N").alias("is_defining_col"),
        F.when(F.col("l_tax") > 0.04, "Y").otherwise("N").alias("is_audit_col"),
    )
    feeds = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("fp_id"),
        F.when(F.col("o_orderstatus") == "P", "JSON").otherwise("DELIMITED").alias("file_format"),
        F.concat(F.lit("date_loaded,"), "o_orderpriority").alias("target_table_partition"),
    )
    return columns, feeds


def _flat_contract(df: DataFrame) -> DataFrame:
    lists = ["key_cols", "defining_cols", "data_cols", "partition_cols"]
    return df.withColumns({name: F.array_join(name, ",") for name in lists})


def contracts(spark, sf_dir):
    return _flat_contract(build_contracts(*_contract_tables(spark, sf_dir)))


def files_with_contract(spark, sf_dir):
    """Events as files of the feeds; some feeds are unknown."""
    files = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("file_process_id"), (F.col("user_id") * 100).alias("fp_id")
    )
    joined = with_contract(files, build_contracts(*_contract_tables(spark, sf_dir)))
    return joined.select(
        "file_process_id", "fp_id", "key_col", "defining_col", "partition_col", "problem"
    )


# --- control tables --------------------------------------------------------------------------


def _control_tables(spark, sf_dir, done_above: float) -> tuple[DataFrame, DataFrame]:
    """Control tables made of the events: users are files, their events are steps."""
    events = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "signup", STEP_REGISTRATION).when(
        (F.col("event_type") == "purchase") & (F.col("ts") < ntz("2024-01-15")), STEP_LOAD
    )
    steps = events.select(
        F.col("event_id").cast("string").alias("step_id"),
        F.col("user_id").alias("file_process_id"),
        name.alias("step_name"),
        F.when(F.col("value") > done_above, DONE).otherwise(ERROR).alias("step_status"),
        F.col("ts").alias("step_start_ts"),
        F.col("ts").alias("step_end_ts"),
        F.col("ts").alias("upsert_ts"),
    )
    files = events.groupBy(F.col("user_id").alias("file_process_id")).agg(
        F.max("event_id").alias("fp_id")
    )
    return files, steps


def pending_files(spark, sf_dir):
    return control.pending_files(*_control_tables(spark, sf_dir, 60))


def pending_files_per_file(spark, sf_dir):
    return control.pending_files(*_control_tables(spark, sf_dir, 120), mode="per_file")


def high_watermark(spark, sf_dir):
    return control.high_watermark(_control_tables(spark, sf_dir, 60)[1])


def registered_at(spark, sf_dir):
    return control.registered_at(_control_tables(spark, sf_dir, 60)[1])


def derive_paths(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("landing-"), "lang").alias("bucket_name"),
        F.concat(F.lit("in/"), "source", F.lit("_"), "doc_id", F.lit(".csv")).alias("filename"),
    )
    return with_paths(files)


def step_log_current(spark, sf_dir):
    """Events as log rows: the newest row of every user and kind of event."""
    steps = table(spark, sf_dir, "events").select(
        F.concat_ws("-", "user_id", "event_type").alias("step_id"),
        F.when(F.col("value") > 60, DONE).otherwise("IN-PROGRESS").alias("step_status"),
        F.col("ts").alias("upsert_ts"),
    )
    return control.current_steps(steps)


def step_log_cycle(spark, sf_dir):
    """One step per order: opened for all, closed for those no longer open."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("file_process_id"),
        F.concat(F.lit("raw/"), "o_orderpriority").alias("target_path"),
        "o_orderstatus",
    )
    opened = control.log_start(orders, "run")
    failed = F.col("o_orderstatus") == "P"
    results = orders.where(F.col("o_orderstatus") != "O").select(
        F.concat_ws("-", F.lit("run"), "file_process_id").alias("step_id"),
        "file_process_id",
        "target_path",
        F.lit("load-1").alias("load_id"),
        F.when(failed, FAILED).otherwise(SUCCESS).alias("status"),
        F.when(failed, "partly shipped").otherwise("").alias("message"),
        F.current_timestamp().alias("start"),
        F.current_timestamp().alias("end"),
    )
    steps = control.current_steps(opened.unionByName(control.log_finish(results)))
    return steps.select(
        "step_id", "step_name", "step_status", "step_status_detail", "target_path", "load_id"
    )


def done_loads(spark, sf_dir):
    """Orders as load steps: the successful loads of every customer's table."""
    steps = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("raw/"), "o_custkey").alias("target_path"),
        F.lit(STEP_LOAD).alias("step_name"),
        F.when(F.col("o_orderstatus") == "F", DONE).otherwise(ERROR).alias("step_status"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("load_id"),
    )
    return control.done_loads(steps)


# --- whole runs ------------------------------------------------------------------------------


def _run(
    spark, sf_dir, with_misfit: bool = False
) -> tuple[control.FolderControl, str, DataFrame]:
    """Three registered files, two of them of one table, and a run over them. ``with_misfit``: one
    more file of that table, from a feed that has another type for a column."""
    root = scratch_path(spark, "run")
    bucket = f"{root}/landing"
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    write_csv(events.where(F.col("ts") < ntz(CUT_OVER)), f"{bucket}/in/events_20240115.csv")
    write_csv(
        _last_per(events.where(F.col("ts") >= ntz(CUT_OVER)), "user_id"),
        f"{bucket}/in/events_20240131.csv",
    )
    write_csv(orders, f"{bucket}/in/orders_20240131.csv")

    store = control.FolderControl(spark, f"{root}/control")
    files = [
        (1, 1, "in/events_20240115.csv"),
        (2, 1, "in/events_20240131.csv"),
        (3, 2, "in/orders_20240131.csv"),
        (4, 2, "in/orders_20240201.csv"),  # registered, but never arrived
    ]
    if with_misfit:
        write_csv(events, f"{bucket}/in/events_20240201.csv")
        files.append((5, 3, "in/events_20240201.csv"))
    store.append(
        control.FILE_LOG,
        spark.createDataFrame(
            [(*file, bucket) for file in files],
            "file_process_id bigint, fp_id bigint, filename string, bucket_name string",
        ),
    )
    registered = spark.createDataFrame([(file[0],) for file in files], "file_process_id bigint")
    moment = F.lit("2024-02-01 00:00:00").cast("timestamp")
    store.append(
        control.STEP_LOG,
        registered.select(
            F.concat(F.lit("registration-"), "file_process_id").alias("step_id"),
            "file_process_id",
            F.lit(STEP_REGISTRATION).alias("step_name"),
            F.lit(DONE).alias("step_status"),
            F.lit("").alias("step_status_detail"),
            moment.alias("step_start_ts"),
            moment.alias("step_end_ts"),
            F.lit("registrar").alias("upsert_by"),
            moment.alias("upsert_ts"),
            F.lit(None).cast("string").alias("target_path"),
            F.lit(None).cast("string").alias("load_id"),
        ),
    )
    store.append(
        control.FEEDS,
        spark.createDataFrame(
            [
                (1, "DELIMITED", "date_loaded"),
                (2, "DELIMITED", "date_loaded,region"),
                (3, "DELIMITED", "date_loaded"),
            ],
            "fp_id bigint, file_format string, target_table_partition string",
        ),
    )
    ntz_type, key_pos = "TimestampNTZType", {1: 2, 2: 1, 3: 2}
    columns = {
        1: [
            ("event_id", "LongType", "Y"),
            ("ts", ntz_type, "Y"),
            ("user_id", "LongType", "Y"),
            ("event_type", "StringType", "N"),
            ("value", "DoubleType", "Y"),
            ("props", "StringType", "Y"),
        ],
        2: [
            ("o_orderkey", "LongType", "Y"),
            ("o_custkey", "LongType", "Y"),
            ("o_orderstatus", "StringType", "N"),
            ("o_totalprice", "DoubleType", "Y"),
            ("o_orderdate", ntz_type, "Y"),
            ("o_orderpriority", "StringType", "N"),
        ],
    }
    columns[3] = [
        (name, "StringType" if name == "value" else datatype, audit)
        for name, datatype, audit in columns[1]
    ]
    store.append(
        control.COLUMNS,
        spark.createDataFrame(
            [
                (fp_id, name, datatype, place, key_pos[fp_id], "NY"[datatype == ntz_type], audit)
                for fp_id, names in columns.items()
                for place, (name, datatype, audit) in enumerate(names)
            ],
            "fp_detail_id bigint, col_name string, col_datatype string, col_ordinal int, "
            "primary_key_pos int, is_defining_col string, is_audit_col string",
        ),
    )
    options = LoadOptions(load_date=LOAD_DATE, tiebreak=("event_id", "o_orderkey"))
    report = run_pending(spark, store, options, scheme="")
    return store, f"{root}/raw", report


def run_pending_files(spark, sf_dir):
    store, raw, _ = _run(spark, sf_dir)
    keys = {"events": "user_id", "orders": "o_custkey"}
    parts = [
        table_history(spark, store, f"{raw}/{name}.parquet").select(
            F.lit(name).alias("table_name"),
            F.col(key).alias("key"),
            "hashKey",
            "hashData",
            "startDate",
            "endDate",
            "date_loaded",
        )
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def run_incompatible_file(spark, sf_dir):
    """Outcomes of a run with a file that does not fit its table, and the table's rows after it."""
    store, raw, report = _run(spark, sf_dir, with_misfit=True)
    rows = table_history(spark, store, f"{raw}/events.parquet").count()
    no_path = F.col("message").startswith("[PATH_NOT_FOUND]")
    return report.select(
        "file_process_id",
        "status",
        F.when(no_path, "path").otherwise(F.col("message")).alias("message"),
        "count",
        F.lit(rows).cast("long").alias("table_rows"),
    )


def run_report(spark, sf_dir):
    """What became of each file of the run, from the report and from the step log."""
    store, _, report = _run(spark, sf_dir)
    steps = control.current_steps(store.table(control.STEP_LOG)).where(
        F.col("step_name") == STEP_LOAD
    )
    return report.join(steps, "file_process_id").select(
        "file_process_id",
        "status",
        F.regexp_extract("message", r"^\[([A-Z_]+)\]", 1).alias("error_class"),
        "count",
        "step_status",
        F.col("load_id").isNotNull().alias("visible"),
    )


QUERIES = {
    "hash_columns": hash_columns,
    "documents_hash": documents_hash,
    "audit_columns": audit_columns,
    "hash_key_columns": hash_key_columns,
    "audit_columns_hot_key": audit_columns_hot_key,
    "current_rows": current_rows,
    "changed_rows": changed_rows,
    "staged_updates": staged_updates,
    "scd2_merge": scd2_merge,
    "scd2_merge_broadcast": scd2_merge_broadcast,
    "scd2_merge_new_keys": scd2_merge_new_keys,
    "scd2_merge_evolving": scd2_merge_evolving,
    "scd2_merge_key_bits": scd2_merge_key_bits,
    "scd2_merge_hot_key": scd2_merge_hot_key,
    "ambiguous_keys": ambiguous_keys,
    "ambiguous_batches_daily": ambiguous_batches_daily,
    "scd2_fold_daily": scd2_fold_daily,
    "scd2_fold_onto_history": scd2_fold_onto_history,
    "scd2_fold_hot_keys": scd2_fold_hot_keys,
    "fold_undated_rows": fold_undated_rows,
    "csv_scan": csv_scan,
    "batch_count": batch_count,
    "append_evolving": append_evolved,
    "first_load_roundtrip": first_load_roundtrip,
    "merge_load_roundtrip": merge_load_roundtrip,
    "open_rows_after_merge": open_rows_after_merge,
    "difference_loads": difference_loads,
    "difference_loads_open": difference_loads_open,
    "difference_loads_rebased": difference_loads_rebased,
    "csv_load_batch": csv_load_batch,
    "quarantine_lines": quarantine_lines,
    "contracts": contracts,
    "files_with_contract": files_with_contract,
    "pending_files": pending_files,
    "pending_files_per_file": pending_files_per_file,
    "high_watermark": high_watermark,
    "registered_at": registered_at,
    "derive_paths": derive_paths,
    "step_log_current": step_log_current,
    "step_log_cycle": step_log_cycle,
    "done_loads": done_loads,
    "run_pending": run_pending_files,
    "run_incompatible_file": run_incompatible_file,
    "run_report": run_report,
}
