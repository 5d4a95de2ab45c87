"""Folds of keys with several open rows and of rows without a date, against merges one by one."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from histload.names import END
from histload.operators import scd2
from histload.operators.audit import with_audit_columns, with_hashes
from histload.operators.fold import fold_odd_batches, fold_parts
from histload.operators.skew import UNIQUE_KEYS, HotKeys
from histload.plans import loads as module
from histload.plans.loads import LoadOptions, load_files
from histload.sources.differences import read_table

TYPES = "k int, v string, at timestamp_ntz"


def frame(spark, rows):
    df = spark.createDataFrame([(k, v, at and f"2024-01-{at:02d} 00:00:00") for k, v, at in rows], "k int, v string, at string")
    return df.withColumn("at", F.col("at").cast("timestamp_ntz"))


def audited(spark, rows):
    return with_audit_columns(frame(spark, rows), "k", ["v"], "at", load_date="2024-01-01", hot=UNIQUE_KEYS)


def plain(df):
    names = ["k", "v", "at", "hashData", "startDate", "endDate"]
    return sorted(tuple(map(str, row)) for row in df.select(*names).collect())


def random_batches(seed):
    """A first batch with several rows of a key, undated ones among them; then one row a key and batch."""
    rng = random.Random(seed)
    undated = lambda share: None if rng.random() < share else rng.randint(1, 28)
    out = [[(k, rng.choice("ab"), undated(0.3)) for k in range(8) for _ in range(rng.randint(0, 3))] + [(None, "n", None)]]
    known = {k for k, _, _ in out[0]}
    for n in range(5):
        rows = [(k, rng.choice("ab"), undated(0.25)) for k in rng.sample(range(12), 6)]
        new = [k for k in range(12, 16) if k not in known and rng.random() < 0.4]
        rows += [(k, rng.choice("ab"), undated(0.4)) for k in new for _ in range(rng.randint(1, 3))]
        rows += [(None, "n", undated(0.5))]
        known |= {k for k, _, _ in rows}
        out.append(rows)
    return out


def merged_one_by_one(spark, batches):
    history = audited(spark, batches[0]).checkpoint()
    for rows in batches[1:]:
        history = scd2.merge_next(history, audited(spark, rows), "k", UNIQUE_KEYS).checkpoint()
    return history


def numbered(spark, batches, first=0):
    parts = [frame(spark, rows).withColumn("no", F.lit(n)) for n, rows in enumerate(batches, first)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return with_hashes(rows, "k", ["v"], "at", load_date="2024-01-01")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chains_are_what_single_merges_make(spark, seed):
    batches = random_batches(seed)
    wanted = plain(merged_one_by_one(spark, batches))
    every = spark.range(20).selectExpr("cast(id AS int) AS k")
    rows = numbered(spark, batches).checkpoint()
    odd = rows.where("at IS NULL").select("k")
    for keys in (every, odd):
        assert plain(fold_odd_batches(None, rows, "no", "k", hot=HotKeys([], 10**6, 100), odd_keys=keys)) == wanted
    # And onto a table that the first three batches made.
    history = merged_one_by_one(spark, batches[:3])
    open_rows = scd2.current_rows(history)
    more = numbered(spark, batches[3:], 3).checkpoint()
    several = open_rows.groupBy("k").count().where("count > 1").select("k")
    odd = several.union(more.where("at IS NULL").select("k"))
    untouched, folded = fold_parts(open_rows, more, "no", "k", odd_keys=odd)
    whole = scd2.closed_rows(history).unionByName(untouched).unionByName(folded, allowMissingColumns=True)
    assert plain(whole) == wanted


@pytest.mark.parametrize("differences", [0, 3])
def test_files_with_undated_rows_are_folded(spark, tmp_path, monkeypatch, differences):
    files = []
    batches = random_batches(7)
    for n, rows in enumerate(batches):
        lines = [f"{'' if k is None else k},{v},{f'2024-01-{at:02d} 00:00:00' if at else ''}" for k, v, at in rows]
        (tmp_path / f"{n}.csv").write_text("\n".join(["k,v,at", *lines]) + "\n")
        files.append(
            Row(
                file_process_id=n, source_path=str(tmp_path / f"{n}.csv"), problem=None, schema_ddl=TYPES, key_col="k",
                defining_col="at", data_cols=["v"], partition_col="date_loaded",
            )
        )
    single, calls = module._load_singly, []
    monkeypatch.setattr(module, "_load_singly", lambda *args: calls.append(1) or single(*args))
    target, done = str(tmp_path / "table"), []
    for n, group in enumerate((files[:2], files[2:])):
        outcomes = load_files(spark, group, target, f"run-{n}", done, LoadOptions("2024-01-01", differences=differences))
        assert all(outcome.status == "Success" for outcome in outcomes.values())
        done += sorted({outcome.load_id for outcome in outcomes.values()})
    assert not calls and len(done) == 2
    history = read_table(spark, target, done, "k")
    assert plain(history) == plain(merged_one_by_one(spark, batches))
    assert history.where(F.col(END).isNull()).count() > 10


def test_chains_are_made_of_narrow_rows(spark, monkeypatch):
    held, kind = [], type(spark.range(0))
    checkpoint = kind.checkpoint

    def noted(df, *args):
        held.append(df.columns)
        return checkpoint(df, *args)

    rows = numbered(spark, [[(1, "a", 1)], [(1, "b", None)], [(1, "c", None)], [(1, "d", 2)], [(1, "e", None)]])
    monkeypatch.setattr(kind, "checkpoint", noted)
    odd = rows.where("at IS NULL").select("k")
    found = fold_odd_batches(None, rows, "no", "k", hot=UNIQUE_KEYS, odd_keys=odd)
    ended = sorted((row["v"], str(row["endDate"])[:10]) for row in found.collect())
    assert ended == [("a", "2024-01-02"), *[("b", "2024-01-02")], *[("c", "2024-01-02")] * 2, *[("d", "None")] * 4,
                     *[("e", "None")] * 4]
    assert sum("v" in columns for columns in held) == 1 and len(held) > 4
