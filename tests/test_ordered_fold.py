"""Hot-key slices against plain windows, and folds against one-by-one merges."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from histload.operators.audit import with_audit_columns, with_hashes
from histload.operators.fold import ambiguous_batches, batch_census, fold_batches, fold_next
from histload.operators.ordered import ordered_rows
from histload.operators.scd2 import changed_rows, merge_next, rows_to_insert
from histload.operators.skew import find_hot_keys, group_sizes

SCHEMA = "id int, v string, d int"


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with half of the rows, a NULL key with a third, many equal rows, NULL dates."""
    rng = random.Random(3)
    rows = []
    for _ in range(1200):
        key = rng.choice([7, 7, 7, None, None, rng.randrange(40)])
        rows.append((key, rng.choice("ab"), rng.choice([None, *range(30)])))
    rows += [(7, "a", 5)] * 400  # copies of one row
    rows += [(7, "z", None)] * 100
    return spark.createDataFrame(rows, SCHEMA).repartition(5).persist()


def test_many_slices_in_few_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, None]), rng.choice("abc"), rng.choice([None, *range(900)])) for _ in range(2400)]
    df = spark.createDataFrame([*rows, *rows[:300]], SCHEMA).repartition(3)
    hot = find_hot_keys(group_sizes(df, ["id"]), rows_per_slice=2)
    assert hot.slices > 1300
    cut = ordered_rows(df, ["id"], ["d", "v"], hot)
    assert cut.df.rdd.getNumPartitions() < 600  # each range is a task and a sample on the driver
    sizes = cut.df.groupBy("id", "__slice").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 2 and sizes[1] > 1300
    got = cut.with_next("n", "d").with_previous("p", "v").with_first("low", "d").result()
    w = Window.partitionBy("id").orderBy("d", "v")
    wanted = df.withColumns(
        {"n": F.lead("d").over(w), "p": F.lag("v").over(w), "low": F.first("d").over(w)}
    )
    assert plain(got) == plain(wanted)


def test_slices_agree_with_plain_windows(skewed):
    hot = find_hot_keys(group_sizes(skewed, ["id"]), rows_per_slice=50)
    assert sorted(str(r["id"]) for r in hot.rows) == ["7", "None"]
    assert hot.total == skewed.count() and hot.slices > 10

    rows = ordered_rows(skewed, ["id"], ["d", "v"], hot)
    sizes = rows.df.where("__slice >= 0").groupBy("__slice").count().agg(F.max("count")).first()[0]
    assert sizes < 250  # the copies are spread as well
    got = rows.with_next("n", "d").with_previous("p", "v").with_first("low", "d").result()
    w = Window.partitionBy("id").orderBy("d", "v")
    wanted = skewed.withColumns(
        {
            "n": F.lead("d").over(w),
            "p": F.lag("v").over(w),
            "low": F.first("d").over(w),
        }
    )
    assert plain(got) == plain(wanted)


def test_no_hot_keys_no_slices(skewed):
    hot = find_hot_keys(group_sizes(skewed, ["id"]))
    assert hot.rows == []
    rows = ordered_rows(skewed, ["id"], ["d"], hot)
    assert not rows.sliced
    plan = rows.with_next("n", "d").result()._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan


def test_audit_columns_with_hot_keys(skewed):
    def audit(limit):
        return with_audit_columns(
            skewed, "id", ["v"], "d", load_date="2024-01-01", tiebreak=["v"], rows_per_slice=limit
        )

    assert plain(audit(60)) == plain(audit(10**6))


def random_batches(seed, n_batches=4):
    """Batches that can be merged: a key that is open has at most one row per batch."""
    rng = random.Random(seed)
    known, rows = set(), []
    for seq in range(n_batches):
        for key in rng.sample(range(8), rng.randrange(1, 7)):
            versions = 1 if key in known else rng.randrange(1, 4)
            for _ in range(versions):
                rows.append((seq, key, rng.choice("abc"), rng.randrange(100)))
            known.add(key)
        rows += [(seq, None, rng.choice("ab"), rng.randrange(100)) for _ in range(rng.randrange(3))]
    return rows


def one_by_one(spark, history, rows):
    for seq in sorted({row[0] for row in rows}):
        df = spark.createDataFrame([row[1:] for row in rows if row[0] == seq], SCHEMA)
        batch = with_audit_columns(df, "id", ["v"], "d", load_date="2024-01-01")
        history = batch if history is None else merge_next(history, batch, "id")
        history = spark.createDataFrame(history.collect(), history.schema)
    return history


def hashed(spark, rows):
    df = spark.createDataFrame(rows, "seq int, " + SCHEMA)
    return with_hashes(df, "id", ["v"], "d", load_date="2024-01-01")


@pytest.mark.parametrize("seed", range(2))
def test_fold_equals_merging_one_by_one(spark, seed):
    rows = random_batches(seed)
    wanted = one_by_one(spark, None, rows)
    got = fold_batches(hashed(spark, rows), "seq", "id")
    assert plain(got.select(wanted.columns)) == plain(wanted)
    sliced = fold_batches(hashed(spark, rows), "seq", "id", rows_per_slice=3)
    assert plain(sliced.select(wanted.columns)) == plain(wanted)


@pytest.mark.parametrize("seed", range(2))
def test_fold_onto_a_table_equals_merging_one_by_one(spark, seed):
    rows = random_batches(100 + seed)
    before, after = [r for r in rows if r[0] < 2], [r for r in rows if r[0] >= 2]
    history = one_by_one(spark, None, before)
    wanted = one_by_one(spark, history, after)
    got = fold_next(history, hashed(spark, after), "seq", "id")
    assert plain(got.select(wanted.columns)) == plain(wanted)
    sliced = fold_next(history, hashed(spark, after), "seq", "id", rows_per_slice=2)
    assert plain(sliced.select(wanted.columns)) == plain(wanted)


def test_ambiguous_batches(spark):
    rows = [
        (0, 1, "a", 1), (0, 1, "b", 2),  # a new key: fine
        (1, 1, "c", 3), (1, 1, "d", 4),  # brought by batch 0: not fine
        (1, None, "c", 3), (1, None, "d", 4),
        (2, 9, "c", 3), (2, 9, "d", 4),  # open in the table: not fine
    ]
    census = batch_census(hashed(spark, rows), "seq", "id")
    assert plain(ambiguous_batches(census, "seq", "id")) == [(1, 1, 2)]
    open_keys = spark.createDataFrame([(9,)], "id int")
    assert plain(ambiguous_batches(census, "seq", "id", open_keys)) == [(2, 9, 2)]


def test_merge_joins_with_hot_keys(spark, skewed):
    """A hot key the table knows and one it does not, against the joins without a split."""
    batch = with_audit_columns(skewed, "id", ["v"], "d", load_date="2024-01-01", tiebreak=["v"])
    known = spark.createDataFrame([(7, "a", 1), (3, "b", 1), (99, "a", 1)], SCHEMA)
    history = with_audit_columns(known, "id", ["v"], "d", load_date="2024-01-01")
    hot = find_hot_keys(group_sizes(batch, ["id"]), rows_per_slice=50)
    assert hot.rows
    for operator in (changed_rows, rows_to_insert):
        assert plain(operator(batch, history, "id", hot)) == plain(operator(batch, history, "id"))
    unknown = history.where("id <> 7")
    assert plain(rows_to_insert(batch, unknown, "id", hot)) == plain(
        rows_to_insert(batch, unknown, "id")
    )
