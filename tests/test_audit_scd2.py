import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from histload.functions.hashing import row_hash
from histload.names import END
from histload.operators import scd2
from histload.operators.audit import with_audit_columns, with_hashes
from histload.operators.scd2 import (
    ambiguous_keys,
    changed_rows,
    current_rows,
    merge_next,
    stage_updates,
)
from histload.operators.skew import UNIQUE_KEYS
from tests.fixtures import (
    AFTER_FULL_LOAD,
    AFTER_INCREMENT,
    BATCH_SCHEMA,
    FULL_LOAD,
    INCREMENT,
    KEY_HASHES,
    expected,
    summary,
)


def audited(spark, rows, schema=BATCH_SCHEMA, **options):
    df = spark.createDataFrame(rows, schema)
    return with_audit_columns(
        df, "customerId", ["address", "city"], "createdOn", load_date="2021-07-20", **options
    )


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_load_history(spark):
    history = audited(spark, FULL_LOAD)
    assert history.columns[-5:] == ["hashKey", "hashData", "startDate", "endDate", "date_loaded"]
    assert summary(history) == expected(AFTER_FULL_LOAD)
    hashes = {r[0]: r[1][:8] for r in history.select("customerId", "hashKey").collect()}
    assert hashes == {key: KEY_HASHES[key] for key in "123"}
    assert {r[0] for r in history.select("date_loaded").collect()} == {"2021-07-20"}


def test_merge_history_and_replay(spark):
    history = audited(spark, FULL_LOAD)
    batch = audited(spark, INCREMENT)
    merged = merge_next(history, batch, "customerId")
    assert summary(merged) == expected(AFTER_INCREMENT)
    assert plain(merge_next(merged, batch, "customerId")) == plain(merged)
    assert summary(current_rows(merged)) == [
        row for row in expected(AFTER_INCREMENT) if row[2] is None
    ]


def test_changed_and_staged_rows(spark):
    history, batch = audited(spark, FULL_LOAD), audited(spark, INCREMENT)
    assert [r[0] for r in plain(changed_rows(batch, history, "customerId"))] == ["1", "3"]
    staged = stage_updates(batch, history, "customerId").select("mergeKey", "customerId")
    assert plain(staged) == [
        ("1", "1"), ("3", "3"), ("4", "4"), (None, "1"), (None, "3")
    ]


def test_column_order_and_names_do_not_matter(spark):
    # A key that is not the first column, and names that are parts of "mergeKey".
    schema = "merge string, e string, Key int, m string"
    def load(rows):
        df = spark.createDataFrame(rows, schema)
        return with_audit_columns(df, "Key", ["merge", "e"], "m", load_date="2021-07-20")

    history = load([("a", "x", 1, "2020")])
    merged = merge_next(history, load([("b", "y", 1, "2021"), ("c", "z", 2, "2021")]), "Key")
    rows = merged.select("merge", "e", "Key", "m", "endDate")
    assert plain(rows) == [
        ("a", "x", 1, "2020", "2021"),
        ("b", "y", 1, "2021", None),
        ("c", "z", 2, "2021", None),
    ]
    staged = stage_updates(load([("b", "y", 1, "2021")]), history, "Key")
    assert plain(staged.select("mergeKey", "merge", "Key")) == [(1, "b", 1), (None, "b", 1)]


def test_several_rows_for_an_open_key_fail(spark):
    history = audited(spark, FULL_LOAD)
    batch = audited(spark, [("2", "x", "y", "2021-01-01"), ("2", "z", "y", "2021-01-02")])
    assert plain(ambiguous_keys(batch, history, "customerId")) == [("2", 2)]
    with pytest.raises(PySparkException, match="several batch rows for one open key"):
        merge_next(history, batch, "customerId").collect()
    new_key = audited(spark, [("9", "x", "y", "2021-01-01"), ("9", "z", "y", "2021-01-02")])
    assert plain(ambiguous_keys(new_key, history, "customerId")) == []
    assert merge_next(history, new_key, "customerId").count() == 6


def test_equal_versions_kept_on_first_load_not_on_merge(spark):
    first = audited(spark, [("1", "a", "b", "2020"), ("1", "a", "b", "2021")])
    assert first.count() == 2
    assert merge_next(first, audited(spark, [("1", "a", "b", "2022")]), "customerId").count() == 2


def test_null_keys_chain_in_a_batch_and_never_match(spark):
    rows = [(None, "a", "b", "2020"), (None, "c", "d", "2021")]
    first = audited(spark, rows)
    assert [(r["startDate"], r["endDate"]) for r in first.orderBy("startDate").collect()] == [
        ("2020", "2021"),
        ("2021", None),
    ]
    assert merge_next(first, audited(spark, rows), "customerId").count() == 4


def test_null_defining_values(spark):
    history = audited(spark, [("1", "a", "b", "2020")])
    merged = merge_next(history, audited(spark, [("1", "c", "d", None)]), "customerId")
    assert current_rows(merged).count() == 2  # "closed" with NULL, so still open
    # Both open rows meet the next batch on their own, and each brings the new version.
    again = merge_next(merged, audited(spark, [("1", "e", "f", "2022")]), "customerId")
    assert plain(again.select("address", "endDate")) == [
        ("a", "2022"), ("c", "2022"), ("e", None), ("e", None)
    ]


def test_row_hash_skips_nulls_unless_given_a_token(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None)], "x string, y string")
    hashes = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert hashes[0] == hashes[1] and hashes[2].startswith("e3b0c442")
    marked = [r[0] for r in df.select(row_hash(["x", "y"], null_token="~")).collect()]
    assert len(set(marked)) == 3


def test_names_of_audit_columns_are_reserved(spark):
    df = spark.createDataFrame([(1, "a", "2020")], "id int, Date_Loaded string, d string")
    with pytest.raises(ValueError, match="date_loaded"):
        with_audit_columns(df, "id", ["Date_Loaded"], "d")


def test_new_columns_are_null_in_older_rows(spark):
    history = audited(spark, FULL_LOAD)
    df = spark.createDataFrame(
        [("2", "a", "b", "2021", "new")], BATCH_SCHEMA + ", phone string"
    )
    batch = with_audit_columns(
        df, "customerId", ["address", "city", "phone"], "createdOn", load_date="2021-07-21"
    )
    merged = merge_next(history, batch, "customerId")
    assert merged.where(F.col("phone").isNotNull()).count() == 1
    assert merged.count() == 5


def test_load_date_defaults_to_today(spark):
    df = spark.createDataFrame(FULL_LOAD, BATCH_SCHEMA)
    out = with_audit_columns(df, "customerId", ["address", "city"], "createdOn")
    today = F.date_format(F.current_date(), "yyyy-MM-dd")
    assert out.where(F.col("date_loaded") != today).count() == 0


def test_large_merges_shuffle_once(spark):
    """The plan of a merge without a broadcast has one exchange over both inputs, and its rows are
    those of the joins."""
    batch_rows = [(1, "x", "2024-02-01"), (2, "b", "2024-02-01"), (5, "new", "2024-02-01"), (None, "n", "2024-02-01")]
    open_rows = [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-01"), (None, "o", "2024-01-01"), (1, "z", "2024-01-02")]

    def audited(rows, date):
        df = spark.createDataFrame(rows, "k int, v string, at string")
        return with_hashes(df, "k", ["v"], "at", load_date=date).withColumn(END, F.lit(None).cast("string"))

    history, batch = audited(open_rows, "2024-01-03"), audited(batch_rows, "2024-02-02")
    one = scd2.merge_open(history, batch, "k", UNIQUE_KEYS)
    updated, inserted = scd2._merge(history, batch, "k", UNIQUE_KEYS)
    two = updated.unionByName(inserted)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
