"""Batches that do not fit their table, files that fail together, and bounds that are parameters."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from histload.operators.audit import with_hashes
from histload.operators.fold import UNDATED
from histload.operators.skew import ROWS, HotKeys, find_hot_keys
from histload.plans import loads
from histload.plans.loads import SEQ, Feed, MisfitBatch, load_batch, load_files
from histload.sources import delimited
from histload.sources.history import read_history

FEED = Feed("k int, v date, at timestamp", "k", "at", ("v",))


@pytest.fixture
def files(tmp_path):
    def write(name, *lines):
        (tmp_path / name).write_text("\n".join(["k,v,at", *lines]) + "\n")
        return str(tmp_path / name)

    return write


def contract(file_id, path, types, **other):
    return Row(
        file_process_id=file_id,
        source_path=path,
        problem=None,
        **{
            "schema_ddl": types,
            "key_col": "k",
            "defining_col": "at",
            "data_cols": ["v"],
            "partition_col": "date_loaded",
            **other,
        },
    )


@pytest.mark.parametrize(
    "changed",
    [
        Feed("k int, v timestamp, at timestamp", "k", "at", ("v",)),
        Feed("k int, v date, at date", "k", "at", ("v",)),
        Feed("k int, v date, at timestamp", "k", "at", ("v",), "arrived"),
        Feed("id int, v date, at timestamp", "id", "at", ("v",)),
    ],
)
def test_a_batch_that_does_not_fit_is_refused(spark, tmp_path, files, changed):
    target = str(tmp_path / "table")
    first = files("a.csv", "1,2024-01-01,2024-01-01 00:00:00")
    load_batch(spark, first, FEED, target, "load-1")
    with pytest.raises(MisfitBatch):
        load_batch(spark, first, changed, target, "load-2", ["load-1"])
    assert read_history(spark, target, ["load-1"]).count() == 1


def test_a_column_may_widen(spark, tmp_path, files):
    target = str(tmp_path / "table")
    narrow = Feed("k int, v int, at timestamp", "k", "at", ("v",))
    wide = Feed("k int, v bigint, at timestamp", "k", "at", ("v",))
    steps = [(narrow, "1,5,2024-01-01 00:00:00"), (wide, f"1,{10**12},2024-01-02 00:00:00"), (narrow, "1,7,2024-01-03 00:00:00")]
    done = []
    for n, (feed, line) in enumerate(steps):
        load_batch(spark, files(f"{n}.csv", line), feed, target, f"load-{n}", done)
        done.append(f"load-{n}")
    rows = read_history(spark, target, done).orderBy("at").collect()
    assert [row["v"] for row in rows] == [5, 10**12, 7]
    assert [row["endDate"] is None for row in rows] == [False, False, True]


def test_a_string_among_integers_fails_alone(spark, tmp_path, files):
    target, ints = str(tmp_path / "table"), "k int, v int, at timestamp"
    group = [
        contract(1, files("a.csv", "1,5,2024-01-01 00:00:00"), ints),
        contract(2, files("b.csv", "1,abc,2024-01-02 00:00:00"), ints.replace("v int", "v string")),
        contract(3, files("c.csv", "1,7,2024-01-03 00:00:00"), ints),
        contract(4, files("d.csv", "1,8,2024-01-03 00:00:00"), ints, partition_col="other"),
    ]
    outcomes = load_files(spark, group, target, "load-1")
    assert {n: o.status for n, o in outcomes.items()} == {1: "Success", 2: "Failed", 3: "Success", 4: "Failed"}
    assert "column v is string" in outcomes[2].message and "other" in outcomes[4].message
    done = [outcomes[1].load_id]
    assert [row["v"] for row in read_history(spark, target, done).orderBy("at").collect()] == [5, 7]
    again = load_files(spark, group[1:2], target, "load-2", done)
    assert again[2].status == "Failed" and "string" in again[2].message


def test_files_that_fail_together_are_tried_apart(spark, tmp_path, files, monkeypatch):
    target, ints = str(tmp_path / "table"), "k int, v int, at timestamp"
    group = [contract(n, files(f"{n}.csv", f"{n},5,2024-01-01 00:00:00"), ints) for n in (1, 2, 3)]
    whole = loads._load_group

    def failing(spark, files, *rest):
        if len(files) > 1 or files[0]["file_process_id"] == 2:
            raise RuntimeError("no luck")
        whole(spark, files, *rest)

    monkeypatch.setattr(loads, "_load_group", failing)
    outcomes = load_files(spark, group, target, "load-1")
    assert {n: o.status for n, o in outcomes.items()} == {1: "Success", 2: "Failed", 3: "Success"}
    done = [outcomes[1].load_id, outcomes[3].load_id]
    assert sorted(row["k"] for row in read_history(spark, target, done).collect()) == [1, 3]


def test_file_numbers_come_without_a_shuffle(spark, files, monkeypatch):
    paths = [(files(f"{n}.csv", f"{n},2024-01-01,2024-01-01 00:00:00"), n) for n in range(5)]
    rows = delimited.read_numbered(spark, paths, FEED.schema_ddl, "no")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    monkeypatch.setattr(delimited, "LOOKUP_BYTES", 300)
    split = delimited.read_numbered(spark, paths, FEED.schema_ddl, "no")
    assert split.exceptAll(rows).isEmpty() and split.count() == 5
    assert split.where(F.col("k") != F.col("no")).isEmpty()


def test_clashing_files_are_rejected_in_few_rounds(spark, monkeypatch):
    rows = [(0, 1, 1, 0), *[(n, 1, 2, 0) for n in range(1, 11)], (11, 2, 2, 0), (12, 2, 2, 0), (13, 3, 1, 0)]
    census = spark.createDataFrame(rows, f"{SEQ} int, k int, {ROWS} bigint, {UNDATED} bigint")
    calls, real = [], loads.ambiguous_batches
    monkeypatch.setattr(loads, "ambiguous_batches", lambda *a: calls.append(1) or real(*a))
    rejected = loads._ambiguous_files(census, "k", None)
    assert sorted(rejected) == [*range(1, 11), 12]
    assert len(calls) <= 5


def rejected_by_rounds(rows, open_keys):
    """Files one after another: rejected if a key they have several rows of is open by then."""
    is_open, out = set(open_keys), {}
    for seq in sorted({row[0] for row in rows}):
        own = {k: n for s, k, n, _ in rows if s == seq}
        table = sorted(k for k, n in own.items() if n > 1 and k in open_keys)
        clash = sorted(k for k, n in own.items() if n > 1 and k in is_open)
        if clash:
            k = (table or clash)[0]
            out[seq] = f"{own[k]} rows for the open key k = {k}"
        else:
            is_open |= set(own)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_clashes_told_at_once_are_those_of_single_loads(spark, seed):
    import random

    rng = random.Random(seed)
    rows = [(s, k, rng.choice([1, 1, 2, 3]), 0) for s in range(12) for k in rng.sample(range(15), rng.randint(1, 4))]
    open_keys = rng.sample(range(15), 2) if seed > 2 else []
    census = spark.createDataFrame(rows, f"{SEQ} int, k int, {ROWS} bigint, {UNDATED} bigint")
    table = spark.createDataFrame([(k, 1) for k in open_keys], f"k int, {ROWS} bigint") if open_keys else None
    assert loads._ambiguous_files(census, "k", table) == rejected_by_rounds(rows, open_keys)


def test_slices_above_the_bound_are_told(spark):
    sizes = spark.createDataFrame([(1, 90), (2, 10)], f"k int, {ROWS} bigint")
    assert len(find_hot_keys(sizes, rows_per_slice=5).rows) == 2
    with pytest.warns(UserWarning, match="max_slices"):
        hot = find_hot_keys(sizes, rows_per_slice=5, max_slices=4)
    assert (hot.limit, len(hot.rows)) == (25, 1)
    assert HotKeys([], 5, 10, 4).small and not HotKeys([], 5, 10, 4, broadcast_rows=9).small
    assert not HotKeys([], 5, 10, 4, broadcast_bytes=100).small


def test_key_hash_of_several_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    one = with_hashes(df, "a", ["c"], "c", load_date="2024-01-01", hash_key_cols=["a", "b"])
    wanted = df.select(F.sha2(F.lit("1|2"), 256)).first()[0]
    assert one.first()["hashKey"] == wanted


def test_lines_that_do_not_fit_are_put_aside(spark, tmp_path, files):
    types, options = "k int, v date, at timestamp", loads.LoadOptions("2024-01-01", quarantine=str(tmp_path / "aside"))
    group = [
        contract(1, files("a.csv", "1,2024-01-01,2024-01-01 00:00:00", "2,no date,2024-01-01 00:00:00"), types),
        contract(2, files("b.csv", "3,2024-01-01,2024-01-02 00:00:00", "4,2024-01-01", "x,2024-01-01,2024-01-02 00:00:00"), types),
        contract(3, files("c.csv", "5,2024-01-01,2024-01-03 00:00:00"), types),
    ]
    target = str(tmp_path / "table")
    outcomes = load_files(spark, group, target, "load-1", (), options)
    assert [(n, o.status, o.count, o.unparsable) for n, o in outcomes.items()] == [
        (1, "Success", 1, 1), (2, "Success", 1, 2), (3, "Success", 1, 0),
    ]
    assert sorted(row["k"] for row in read_history(spark, target, [outcomes[1].load_id]).collect()) == [1, 3, 5]
    lines = loads.quarantined_lines(spark, options.quarantine).orderBy("line").collect()
    assert [(row["file_process_id"], row["line"]) for row in lines] == [
        (1, "2,no date,2024-01-01 00:00:00"), (2, "4,2024-01-01"), (2, "x,2024-01-01,2024-01-02 00:00:00"),
    ]
    alone = load_files(spark, group[1:2], str(tmp_path / "other"), "load-2", (), options)
    assert (alone[2].count, alone[2].unparsable) == (1, 2)
    plain = load_files(spark, group[:1], str(tmp_path / "third"), "load-1")
    assert (plain[1].count, plain[1].unparsable) == (2, 0)
