"""Difference loads against full ones, their cost, key bits, and files that leave no trace when they fail."""

import os
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from histload.names import END
from histload.operators import bitmap, scd2
from histload.operators.audit import with_audit_columns
from histload.operators.fold import fold_changes, touched_rows
from histload.operators.scd2 import PRIOR_ROW
from histload.operators.skew import UNIQUE_KEYS, HotKeys, find_hot_keys, group_sizes
from histload.plans.loads import AmbiguousBatch, Feed, LoadOptions, first_load, load_batch, load_files, merge_load
from histload.sources.differences import read_open_rows, read_table, rebase, since_base
from histload.sources.history import read_history, read_open

FEED = Feed("k int, v int, at timestamp", "k", "at", ("v",))


def audited(spark, rows, load_date="2024-01-01"):
    df = spark.createDataFrame([(k, v, at and f"2024-01-{at:02d} 00:00:00") for k, v, at in rows], "k int, v string, at string")
    df = df.withColumn("at", F.col("at").cast("timestamp_ntz"))
    return with_audit_columns(df, "k", ["v"], "at", load_date=load_date, hot=UNIQUE_KEYS)


def plain(df):
    return sorted(tuple(str(row[c]) for c in sorted(df.columns)) for row in df.collect())


def batches(seed, loads=5):
    """A first load with several versions of a key, then batches of one row a key: changed, unchanged,
    changed back, new, without date and without key."""
    rng = random.Random(seed)
    first = [(rng.randint(0, 12), rng.choice("ab"), rng.randint(1, 9)) for _ in range(25)]
    out = [first + [(None, "n", 1)]]
    for n in range(loads):
        keys = rng.sample(range(16), rng.randint(0, 9))
        rows = [(k, rng.choice("abc"), None if rng.random() < 0.15 else 10 + n) for k in keys]
        out.append(rows + [(None, "n", 10 + n)] * rng.randint(0, 2))
    return out


@pytest.mark.parametrize("seed,small", [(1, True), (2, False), (3, True)])
def test_differences_are_what_full_loads_write(spark, tmp_path, seed, small):
    full, narrow = str(tmp_path / "full"), str(tmp_path / "narrow")
    hot = HotKeys([], 10**6, None if not small else 30)
    loads, ids = [], []
    for n, rows in enumerate(batches(seed)):
        batch = audited(spark, rows, load_date=f"2024-02-{n + 1:02d}")
        if n == 0:
            first_load(batch, full, "load-0")
            first_load(batch, narrow, "load-0")
            loads, ids = ["load-0"], ["load-0"]
            continue
        if n == 4:  # a full load after differences
            merge_load(batch, narrow, "k", f"load-{n}", ids, hot=hot)
            ids.append(f"load-{n}")
        else:
            merge_load(batch, narrow, "k", f"load-{n}-difference", ids, hot=hot)
            ids.append(f"load-{n}-difference")
        merge_load(batch, full, "k", f"load-{n}", loads, hot=hot)
        loads.append(f"load-{n}")
        assert plain(read_open_rows(spark, narrow, ids, "k")) == plain(read_open(spark, full, loads[-1]))
        assert plain(read_table(spark, narrow, ids, "k")) == plain(read_history(spark, full, loads))
    assert since_base(ids) == ["load-4", "load-5-difference"]
    rebase(spark, narrow, ids, "load-6", "k")
    assert plain(read_history(spark, narrow, [*ids, "load-6"])) == plain(read_history(spark, full, loads))
    rebase(spark, narrow, [*ids, "load-6"], "load-7", "k")
    assert plain(read_history(spark, narrow, [*ids, "load-6", "load-7"])) == plain(read_history(spark, full, loads))


def folder_bytes(path):
    return sum(
        os.path.getsize(os.path.join(folder, name)) for folder, _, names in os.walk(path) for name in names
        if name.endswith(".parquet")
    )


def test_a_small_batch_writes_little(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(200_000).selectExpr(
        "id AS k", "concat('value ', id, ' ', sha2(cast(id AS string), 256)) AS v", "timestamp_ntz'2024-01-01 00:00:00' AS at"
    )
    later = rows.where("k % 100 = 0").selectExpr("k", "concat('x', v) AS v", "timestamp_ntz'2024-01-02 00:00:00' AS at")
    audit = lambda df: with_audit_columns(df, "k", ["v"], "at", load_date="2024-01-01", hot=UNIQUE_KEYS)
    first_load(audit(rows), path, "load-0")
    merge_load(audit(later), path, "k", "load-1-difference", ["load-0"])
    base = folder_bytes(f"{path}/history_load=load-0")
    assert folder_bytes(f"{path}/history_load=load-1-difference") <= 0.05 * base
    found = read_open_rows(spark, path, ["load-0", "load-1-difference"], "k")
    assert found.count() == 200_000 and found.where("v LIKE 'x%'").count() == 2000


def test_columns_and_types_grow_over_differences(spark, tmp_path):
    path, done = str(tmp_path / "table"), []
    steps = [
        ("k int, v int, at timestamp", "1,5,2024-01-01 00:00:00", "load-0"),
        ("k int, v bigint, at timestamp", f"1,{10**12},2024-01-02 00:00:00", "load-1-difference"),
        ("k int, v int, w string, at timestamp", "2,7,new,2024-01-03 00:00:00", "load-2-difference"),
        ("k int, v int, at timestamp", "2,8,2024-01-04 00:00:00", "load-3-difference"),
    ]
    for n, (types, line, load_id) in enumerate(steps):
        source = tmp_path / f"{n}.csv"
        names = ",".join(part.split()[0] for part in types.split(", "))
        source.write_text(f"{names}\n{line}\n")
        feed = Feed(types, "k", "at", ("v", "w") if " w " in types else ("v",))
        load_batch(spark, str(source), feed, path, load_id, done)
        done.append(load_id)
    rows = read_table(spark, path, done, "k").orderBy("at").collect()
    assert [(row["k"], row["v"], row["w"]) for row in rows] == [(1, 5, None), (1, 10**12, None), (2, 7, "new"), (2, 8, None)]
    assert [row[END] is None for row in rows] == [False, True, False, True]
    with pytest.raises(ValueError, match="column v is date"):
        load_batch(spark, str(tmp_path / "0.csv"), Feed("k int, v date, at timestamp", "k", "at", ("v",)), path, "x", done)


def test_a_difference_that_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    first_load(audited(spark, [(1, "a", 1), (2, "b", 1)]), path, "load-0")
    merge_load(audited(spark, [(1, "a", 2)]), path, "k", "load-1-difference", ["load-0"])
    loads = ["load-0", "load-1-difference"]
    assert plain(read_table(spark, path, loads, "k")) == plain(read_history(spark, path, ["load-0"]))
    merge_load(audited(spark, [(3, "c", 3)]), path, "k", "load-2-difference", loads)
    assert read_table(spark, path, [*loads, "load-2-difference"], "k").count() == 3


def test_an_ambiguous_batch_is_refused(spark, tmp_path):
    path = str(tmp_path / "table")
    first_load(audited(spark, [(1, "a", 1)]), path, "load-0")
    batch = audited(spark, [(1, "b", 2), (1, "c", 3)])
    with pytest.raises(AmbiguousBatch):
        merge_load(batch, path, "k", "load-1-difference", ["load-0"])
    with pytest.raises(Exception, match="several batch rows"):
        merge_load(batch, path, "k", "load-2-difference", ["load-0"], checked=True)


def contract(file_id, path, types="k int, v int, at timestamp"):
    return Row(
        file_process_id=file_id, source_path=str(path), problem=None, schema_ddl=types, key_col="k",
        defining_col="at", data_cols=["v"], partition_col="date_loaded",
    )


def test_runs_of_files_write_differences(spark, tmp_path):
    """Groups of files: folded, single, and one by one for a NULL date; a full load after two differences."""
    rng, groups, number = random.Random(5), [], 0
    for n in range(6):
        group = []
        for _ in range(1 if n % 2 else 3):
            number += 1
            lines = [
                f"{k},{rng.randint(0, 2)},{'' if n == 3 and k == 4 else f'2024-01-{number:02d} 00:00:00'}"
                for k in rng.sample(range(9), 5)
            ]
            source = tmp_path / f"{number}.csv"
            source.write_text("\n".join(["k,v,at", *lines]) + "\n")
            group.append(contract(number, source))
        groups.append(group)
    tables = {}
    for differences in (0, 2):
        target, loads = str(tmp_path / f"table-{differences}"), []
        for n, group in enumerate(groups):
            outcomes = load_files(spark, group, target, f"run-{n}", loads, LoadOptions("2024-01-01", differences=differences))
            assert all(outcome.status == "Success" for outcome in outcomes.values())
            new = sorted({outcome.load_id for outcome in outcomes.values()} - {None})
            loads += new
            assert len(since_base(loads)) <= differences + 1
        assert any(name.endswith("-difference") for name in loads) == (differences > 0)
        tables[differences] = plain(read_table(spark, target, loads, "k"))
    assert tables[0] == tables[2] and len(tables[0]) > 20


def test_fold_changes_leave_untouched_rows_unread(spark):
    history = audited(spark, [(1, "a", 1), (2, "a", 1), (3, "a", 1)])
    batch = audited(spark, [(1, "b", 2), (2, "a", 2)]).drop(END).withColumn("no", F.lit(1))
    touched = touched_rows(scd2.current_rows(history), batch.select("k"), "k")
    rows = fold_changes(touched, batch, "no", "k").collect()
    assert sorted((r["k"], r["v"], r[PRIOR_ROW], r[END] is not None) for r in rows) == [
        (1, "a", True, True), (1, "b", False, False), (2, "a", True, False),
    ]


@pytest.mark.parametrize("kinds", [("int", "bigint"), ("string", "string"), ("bigint", "int"), ("double", "int")])
def test_key_bits_have_every_key(spark, kinds):
    left = spark.range(3000).selectExpr(f"cast(id AS {kinds[0]}) AS k").union(spark.createDataFrame([(None,)], f"k {kinds[0]}"))
    right = spark.range(0, 6000, 20).selectExpr(f"cast(id AS {kinds[1]}) AS k")
    kind = bitmap.common_type(left, right, "k")
    size = bitmap.bits_for(300)
    assert size == 8192
    bits = bitmap.key_bits(right, "k", kind, size)
    marked = bitmap.with_may_match(left, bits, "k", kind, size, "may")
    assert marked.columns == ["k", "may"] and marked.where("k IS NULL AND may").isEmpty()
    assert marked.join(right, "k").where("NOT may").isEmpty()
    assert 150 <= marked.where("may").count() <= 400
    assert bitmap.bits_for(10**12) == bitmap.MOST_BITS
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_only_rows_that_may_match_are_shuffled(spark):
    rows = spark.range(40_000).selectExpr("cast(id AS int) AS k", "'a' AS v", "timestamp_ntz'2024-01-01 00:00:00' AS at")
    later = rows.where("k % 50 = 0").selectExpr("k", "'b' AS v", "timestamp_ntz'2024-01-02 00:00:00' AS at")
    history, batch = (
        with_audit_columns(df, "k", ["v"], "at", load_date="2024-01-01", hot=UNIQUE_KEYS) for df in (rows, later)
    )
    marked = scd2._with_may_match(history, batch, "k", 800)
    assert 800 <= marked.where(scd2.MAY_MATCH).count() <= 2 * 800 * 2
    assert scd2._with_may_match(batch, history, "k", 40_000) is None
    hot = find_hot_keys(group_sizes(batch, ["k"]), broadcast_rows=0)
    found = scd2.merge_next(history, batch, "k", hot)
    assert found.count() == 40_800 and found.where(F.col(END).isNotNull()).count() == 800


# --- files that fail


@pytest.fixture
def files(tmp_path):
    def write(name, header, *lines):
        (tmp_path / name).write_text("\n".join([header, *lines]) + "\n")
        return str(tmp_path / name)

    return write


def test_types_of_an_unreadable_file_bind_no_other(spark, tmp_path, files):
    ints, texts = "k int, v int, at timestamp", "k int, v string, at timestamp"
    group = [
        contract(1, files("a.csv", "k,other,at", "1,5,2024-01-01 00:00:00"), ints),
        contract(2, files("b.csv", "k,v,at", "1,abc,2024-01-02 00:00:00"), texts),
        contract(3, files("c.csv", "k,v,at", "1,7,2024-01-03 00:00:00"), ints),
    ]
    target, options = str(tmp_path / "table"), LoadOptions("2024-01-01", check_header=True)
    outcomes = load_files(spark, group, target, "load-1", (), options)
    assert {n: o.status for n, o in outcomes.items()} == {1: "Failed", 2: "Success", 3: "Failed"}
    assert "column v is int in the batch, string in the table" in outcomes[3].message
    assert read_history(spark, target, [outcomes[2].load_id]).collect()[0]["v"] == "abc"


def test_types_of_an_ambiguous_file_bind_no_other(spark, tmp_path, files):
    ints = "k int, v int, at timestamp"
    line = "1,{},2024-01-0{} 00:00:00"
    group = [
        contract(1, files("a.csv", "k,v,at", line.format(5, 1)), ints),
        contract(2, files("b.csv", "k,v,w,at", "1,5,8,2024-01-02 00:00:00", "1,6,8,2024-01-03 00:00:00"), ints.replace("v int", "v int, w int")),
        contract(3, files("c.csv", "k,v,w,at", "2,5,text,2024-01-04 00:00:00"), ints.replace("v int", "v int, w string")),
    ]
    target = str(tmp_path / "table")
    outcomes = load_files(spark, group, target, "load-1", (), LoadOptions("2024-01-01"))
    assert {n: o.status for n, o in outcomes.items()} == {1: "Success", 2: "Failed", 3: "Success"}
    assert "2 rows for the open key" in outcomes[2].message
    loads = sorted({o.load_id for o in outcomes.values() if o.load_id})
    assert {row["w"] for row in read_table(spark, target, loads, "k").collect()} == {None, "text"}


def test_files_left_after_unreadable_ones_may_still_fail_together(spark, tmp_path, files, monkeypatch):
    from histload.plans import loads as module

    whole = module._load_group

    def failing(spark, files, *rest):
        if len(files) > 1:
            raise RuntimeError("no luck")
        return whole(spark, files, *rest)

    monkeypatch.setattr(module, "_load_group", failing)
    good = "1,5,2024-01-0{} 00:00:00"
    group = [
        contract(1, files("a.csv", "k,v,at", good.format(1))),
        contract(2, files("b.csv", "k,wrong,at", good.format(2))),
        contract(3, files("c.csv", "k,v,at", good.format(3))),
    ]
    options = LoadOptions("2024-01-01", check_header=True)
    outcomes = load_files(spark, group, str(tmp_path / "table"), "load-1", (), options)
    assert {n: o.status for n, o in outcomes.items()} == {1: "Success", 2: "Failed", 3: "Success"}
