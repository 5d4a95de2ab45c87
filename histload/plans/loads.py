"""Loads from start to end: one batch, the files of one table, and all files that wait."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from histload.functions.paths import SCHEME, with_paths
from histload.names import DEFAULT_PARTITION, FAILED, LOAD_FOLDER, STEP_LOAD, SUCCESS, quoted
from histload.operators.audit import with_audit_columns, with_hashes
from histload.operators.fold import (
    CHAIN,
    EARLIER,
    UNDATED,
    ambiguous_batches,
    batch_census,
    clashing_batches,
    fold_changes,
    fold_odd_batches,
    fold_parts,
    touched_rows,
    with_chain,
)
from histload.operators.scd2 import ambiguous_keys, is_small, merge_changes, merge_open, merge_parts
from histload.operators.skew import (
    MAX_SLICES,
    ROWS,
    ROWS_PER_SLICE,
    HotKeys,
    find_hot_keys,
    group_sizes,
)
from histload.session import shared_folder
from histload.sources.contracts import build_contracts, with_contract
from histload.sources.control import (
    FEEDS,
    FILE_LOG,
    STEP_LOG,
    ControlStore,
    column_contracts,
    current_steps,
    done_loads,
    log_finish,
    log_start,
    pending_files,
    registered_at,
)
from histload.sources.delimited import read_delimited, read_numbered
from histload.sources.differences import (
    read_open_rows,
    read_table,
    rebase_rows,
    since_base,
    write_difference,
)
from histload.sources.history import (
    DIFFERENCE,
    TableShape,
    is_difference,
    table_shape,
    write_load,
    write_parts,
)

SEQ = "__seq"

UNPARSABLE = "__unparsable"  # the line of a row with text that fits no type

REPORT_SCHEMA = (
    "file_process_id bigint, status string, message string, count bigint, undated bigint, "
    "unparsable bigint, start timestamp, end timestamp"
)
RESULT_SCHEMA = REPORT_SCHEMA + ", step_id string, target_path string, load_id string"


@dataclass(frozen=True)
class Feed:
    """What a load needs to know about its files' columns."""

    schema_ddl: str
    key_col: str
    defining_col: str
    data_cols: tuple[str, ...]
    partition_col: str = DEFAULT_PARTITION
    hash_key_cols: tuple[str, ...] = ()  # of the key hash; the key if there are none

    @staticmethod
    def of(contract: Row) -> Feed:
        return Feed(
            contract["schema_ddl"],
            contract["key_col"],
            contract["defining_col"],
            tuple(contract["data_cols"]),
            contract["partition_col"],
        )


@dataclass(frozen=True)
class LoadOptions:
    """``tiebreak`` may name columns of several feeds; each feed uses those it has.

    ``rows_per_slice`` and ``max_slices``: how keys with very many rows are cut. A batch of up to
    ``broadcast_rows`` rows whose narrow rows, one a key, are within ``broadcast_bytes`` is broadcast to
    the open rows; a larger one is joined by shuffle. ``load_step`` is the name of the load's steps
    in the step log. ``differences``: so many loads in a row write new rows and closings only
    (``sources.differences``); the next one writes the whole open part again. 0: every load does.
    ``quarantine``: a folder for lines with text that fits no type, or with too few or too many fields. They
    are left out of the load and counted in the report (``quarantined_lines`` reads them). Without it such text is NULL.
    """

    load_date: str | dt.date | None = None
    tiebreak: tuple[str, ...] = ()
    null_token: str | None = None
    check_header: bool = False
    rows_per_slice: int = ROWS_PER_SLICE
    max_slices: int = MAX_SLICES
    broadcast_rows: int | None = None  # None: the defaults of ``operators.skew``
    broadcast_bytes: int | None = None
    load_step: str = STEP_LOAD
    differences: int = 0
    quarantine: str | None = None

    def writes_difference(self, prior_loads: Sequence[str]) -> bool:
        return bool(prior_loads) and len(since_base(prior_loads)) <= self.differences

    def hot_keys(self, sizes: DataFrame) -> HotKeys:
        return find_hot_keys(
            sizes, self.rows_per_slice, self.max_slices, self.broadcast_rows, self.broadcast_bytes
        )

    def tiebreak_of(self, df: DataFrame) -> list[str]:
        return [name for name in self.tiebreak if name in df.columns]


class MisfitBatch(ValueError):
    """A batch's columns cannot be merged into the table."""


class AmbiguousBatch(ValueError):
    """A batch has several rows for a key that already has an open row."""


def first_load(
    df: DataFrame, path: str, load_id: str, partition_col: str = DEFAULT_PARTITION
) -> None:
    """Start a history table with an audited batch; all versions in it are kept."""
    write_load(df, path, load_id, partition_col)


def merge_load(
    df: DataFrame,
    path: str,
    key: str,
    load_id: str,
    prior_loads: Sequence[str],
    partition_col: str = DEFAULT_PARTITION,
    hot: HotKeys | None = None,
    checked: bool = False,
) -> None:
    """Merge an audited batch into a history table. ``checked``: it is known not to be ambiguous.

    A ``load_id`` that ends in ``-difference`` writes what changes, any other one the whole open part.
    """
    spark = df.sparkSession
    open_rows = read_open_rows(spark, path, prior_loads, key, partition_col)
    batch = df.persist()  # read by each side of the merge
    try:
        clash = None if checked else ambiguous_keys(batch, open_rows, key).first()
        if clash is not None:
            raise AmbiguousBatch(_ambiguous(key, clash[key], clash[ROWS]))
        if hot is None:
            hot = find_hot_keys(group_sizes(batch, [key]))
        if is_difference(load_id):
            changes = merge_changes(open_rows, batch, key, hot)
            write_difference(changes, path, load_id, key, open_rows.schema, partition_col)
            return
        ended = rebase_rows(spark, path, prior_loads, key, partition_col)
        if is_small(batch, hot):
            kept, moved = merge_parts(open_rows, batch, key, hot)
            write_parts(kept, _with_rows(moved, ended), path, load_id, partition_col)
        else:
            rows = merge_open(open_rows, batch, key, hot)
            write_load(_with_rows(rows, ended), path, load_id, partition_col, many_dates=True)
    finally:
        batch.unpersist()


def _with_rows(rows: DataFrame, more: DataFrame | None) -> DataFrame:
    return rows if more is None else rows.unionByName(more, allowMissingColumns=True)


def _ambiguous(key: str, value, rows: int) -> str:
    return f"{rows} rows for the open key {key} = {value}"


def load_batch(
    spark: SparkSession,
    paths: str | Sequence[str],
    feed: Feed,
    target: str,
    load_id: str,
    prior_loads: Sequence[str] = (),
    options: LoadOptions = LoadOptions(),
) -> int:
    """Read delimited files as one batch and load it; returns the number of rows read.

    ``prior_loads`` are the table's loads so far, oldest first; none means a first load. A batch
    that does not fit the table is refused before anything is read. A ``load_id`` that ends in
    ``-difference`` writes what changes.
    """
    if prior_loads:
        misfit = table_shape(spark, target, prior_loads[-1]).misfit(feed)
        if misfit:
            raise MisfitBatch(misfit)
    rows = read_delimited(spark, paths, feed.schema_ddl, options.check_header)
    hot = options.hot_keys(group_sizes(rows, [feed.key_col]))
    _load_rows(rows, feed, target, load_id, prior_loads, options, hot)
    return hot.total


def _load_rows(rows, feed, target, load_id, prior_loads, options, hot, checked=False) -> None:
    batch = with_audit_columns(
        rows,
        feed.key_col,
        feed.data_cols,
        feed.defining_col,
        feed.partition_col,
        options.load_date,
        options.tiebreak_of(rows),
        options.null_token,
        hot=hot,
        hash_key_cols=feed.hash_key_cols,
    )
    if prior_loads:
        merge_load(
            batch, target, feed.key_col, load_id, prior_loads, feed.partition_col, hot, checked
        )
    else:
        first_load(batch, target, load_id, feed.partition_col)


@dataclass
class Outcome:
    """What became of one file."""

    status: str = FAILED
    message: str = ""
    count: int = 0
    undated: int = 0  # rows whose defining value is NULL
    unparsable: int = 0  # lines put into quarantine
    load_id: str | None = None


def load_files(
    spark: SparkSession,
    files: Sequence[Row],
    target: str,
    load_id: str,
    prior_loads: Sequence[str] = (),
    options: LoadOptions = LoadOptions(),
) -> dict[int, Outcome]:
    """Load the files of one table, in the given order; returns each file's outcome by id.

    ``files`` have ``file_process_id``, ``source_path`` and their contract. The outcome is that
    of loading them one after another: a file that cannot be loaded fails alone. Files are
    folded into one load, except where a NULL defining value or a key with two open rows makes
    the order of single merges matter.
    """
    outcomes = {file["file_process_id"]: Outcome(message=file["problem"] or "") for file in files}
    waiting = _readable(spark, [file for file in files if file["problem"] is None], outcomes)
    loads = list(prior_loads)
    shape = table_shape(spark, target, loads[-1]) if loads else TableShape()
    for attempt in range(2 * len(files)):
        # Files of the first types met; which ones count is known once they are loaded.
        trial, group, misfits = shape.copy(), [], []
        for file in waiting:
            outcome = outcomes[file["file_process_id"]]
            outcome.message = trial.misfit(Feed.of(file)) or ""
            (misfits if outcome.message else group).append(file)
        if not group:
            break
        # Names sort in the order of the loads: those of later attempts after all of earlier ones.
        this_load = load_id if attempt == 0 else f"{load_id}-z{attempt:03d}"
        args = (spark, group, target, this_load, loads, options, outcomes)
        try:
            rejected = _load_group(*args, bool(misfits))
        except Exception:
            unsound = [file for file in group if not _reads(spark, file, options, outcomes)]
            if unsound:
                waiting = [file for file in waiting if file not in unsound]
                continue
            _load_apart(*args)
            rejected = []
        if rejected:
            waiting = [file for file in waiting if file not in rejected]
            continue
        for file in group:
            outcome = outcomes[file["file_process_id"]]
            if outcome.status == SUCCESS:
                shape.misfit(Feed.of(file))
                if outcome.load_id and outcome.load_id not in loads:
                    loads.append(outcome.load_id)
        waiting = misfits
    return outcomes


def _load_apart(spark, files, target, load_id, prior_loads, options, outcomes) -> None:
    """Load files that failed together, though each can be read, one after another."""
    loads = list(prior_loads)
    for place, file in enumerate(files):
        outcome = outcomes[file["file_process_id"]] = Outcome()
        try:
            _load_group(
                spark, [file], target, f"{load_id}-apart-{place:06d}", loads, options, outcomes
            )
        except Exception as error:
            outcome.status, outcome.message, outcome.count = FAILED, str(error), 0
        if outcome.load_id:
            loads.append(outcome.load_id)


def _reads(spark, file, options, outcomes) -> bool:
    """Whether a file can be read to its end; asked for each file after a group has failed."""
    rows = read_delimited(spark, file["source_path"], file["schema_ddl"], options.check_header)
    try:
        rows.write.format("noop").mode("overwrite").save()
        return True
    except Exception as error:
        outcomes[file["file_process_id"]] = Outcome(message=str(error))
        return False


def _load_group(
    spark, files, target, load_id, prior_loads, options, outcomes, only_if_whole=False
) -> list[Row]:
    """Load files known to exist, with one key and one partition column. Ambiguous files are left out; with
    ``only_if_whole`` nothing is loaded if there are any, and they are returned."""
    key = files[0]["key_col"]
    partition_col = files[0]["partition_col"]
    numbered = list(enumerate(files))
    if options.quarantine:
        _put_aside(spark, numbered, options, load_id, outcomes)
    rows = _numbered_rows(spark, numbered, options)
    census = batch_census(rows, SEQ, key).persist()
    open_rows = touched = open_census = None
    if prior_loads:
        open_rows = read_open_rows(spark, target, prior_loads, key, partition_col)
        small = options.hot_keys(census.groupBy(quoted(key)).agg(F.sum(ROWS).alias(ROWS))).small
        touched = touched_rows(open_rows, census.select(quoted(key)), key, small).persist()
        open_census = group_sizes(touched, [key]).persist()
    difference = options.writes_difference(prior_loads)
    try:
        repeated = F.max(F.when(F.col(quoted(key)).isNotNull(), F.col(ROWS))) > 1
        totals = (
            census.groupBy(SEQ)
            .agg(
                F.sum(ROWS).alias(ROWS),
                F.sum(UNDATED).alias(UNDATED),
                repeated.alias("repeated"),
            )
            .collect()
        )
        for row in totals:
            outcome = outcomes[files[row[SEQ]]["file_process_id"]]
            outcome.count, outcome.undated = row[ROWS], row[UNDATED]
        rejected = {}
        seen_before = open_census is not None or len(files) > 1
        if seen_before and any(row["repeated"] for row in totals):
            rejected = _ambiguous_files(census, key, open_census)
        for seq, message in rejected.items():
            outcome = outcomes[files[seq]["file_process_id"]]
            outcome.message, outcome.count = message, 0
        if rejected and only_if_whole:
            return [files[seq] for seq in rejected]
        with_rows = {row[SEQ] for row in totals}
        for seq, file in numbered:
            if seq not in with_rows:  # nothing to load, and so no load folder
                outcomes[file["file_process_id"]].status = SUCCESS
        kept = [(s, file) for s, file in numbered if s in with_rows and s not in rejected]
        if not kept:
            return []

        if len(kept) == 1:
            _load_singly(spark, kept, census, target, load_id, prior_loads, options, outcomes)
            return []

        undated = any(row[UNDATED] for row in totals if row[SEQ] not in rejected)
        odd_keys = _odd_keys(census, open_census, key, undated)
        rows = _numbered_rows(spark, kept, options)
        sizes = with_chain(census, SEQ, key).groupBy(quoted(key), CHAIN).agg(F.sum(ROWS).alias(ROWS))
        hot = options.hot_keys(sizes)
        tiebreak = options.tiebreak_of(rows)
        if open_rows is None:
            folded = fold_odd_batches(
                None, rows, SEQ, key, tiebreak, hot=hot, partition_col=partition_col, odd_keys=odd_keys
            )
            write_load(folded.drop(SEQ), target, load_id, partition_col)
        elif difference:
            load_id += DIFFERENCE
            changes = fold_changes(
                touched, rows, SEQ, key, tiebreak, hot=hot, partition_col=partition_col, odd_keys=odd_keys
            )
            write_difference(changes, target, load_id, key, open_rows.schema, partition_col)
        else:
            ended = rebase_rows(spark, target, prior_loads, key, partition_col)
            untouched, folded = fold_parts(
                open_rows,
                rows,
                SEQ,
                key,
                tiebreak,
                hot=hot,
                batch_keys=census.select(quoted(key)),
                partition_col=partition_col,
                touched=touched,
                odd_keys=odd_keys,
            )
            folded = _with_rows(folded, ended)
            if hot.small:
                write_parts(untouched, folded, target, load_id, partition_col)
            else:
                merged = untouched.unionByName(folded, allowMissingColumns=True)
                write_load(merged, target, load_id, partition_col, many_dates=True)
        for _, file in kept:
            outcome = outcomes[file["file_process_id"]]
            outcome.status, outcome.load_id = SUCCESS, load_id
        return []
    finally:
        for held in (census, touched, open_census):
            if held is not None:
                held.unpersist()


def _odd_keys(census, open_census, key: str, undated: bool) -> DataFrame | None:
    """Keys that are folded as chains (``operators.chains``); None if there are none."""
    parts = []
    if undated:
        parts.append(census.where(F.col(UNDATED) > 0))
    if open_census is not None:
        several = open_census.where(F.col(ROWS) > 1)
        if not several.isEmpty():
            parts.append(several)
    keys = [part.select(quoted(key)).where(F.col(quoted(key)).isNotNull()) for part in parts]
    return reduce(DataFrame.union, keys) if keys else None


def _readable(spark, files, outcomes) -> list[Row]:
    """Drop the files whose path does not exist. All are tried at once; one by one on failure."""
    by_schema = defaultdict(list)
    for file in files:
        by_schema[file["schema_ddl"]].append(file)
    good = set()
    for ddl, group in by_schema.items():
        try:
            read_delimited(spark, [file["source_path"] for file in group], ddl)
            good.update(file["file_process_id"] for file in group)
        except AnalysisException:
            for file in group:
                try:
                    read_delimited(spark, file["source_path"], ddl)
                    good.add(file["file_process_id"])
                except AnalysisException as error:
                    outcomes[file["file_process_id"]].message = str(error)
    return [file for file in files if file["file_process_id"] in good]


def _sound(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(UNPARSABLE).isNull()).drop(UNPARSABLE) if UNPARSABLE in rows.columns else rows


def _by_feed(spark, numbered, options) -> list[tuple[Feed, DataFrame]]:
    """The rows of all files, one scan per contract, with the file's number and, if there is a quarantine,
    the lines that belong there."""
    by_feed = defaultdict(list)
    for seq, file in numbered:
        by_feed[Feed.of(file)].append((file["source_path"], seq))
    name = UNPARSABLE if options.quarantine else None
    return [
        (feed, read_numbered(spark, paths, feed.schema_ddl, SEQ, options.check_header, name))
        for feed, paths in by_feed.items()
    ]


def _put_aside(spark, numbered, options, load_id, outcomes) -> None:
    """Write the lines that fit no type, with their file's id, to a folder of the load; count them."""
    ids = spark.createDataFrame(
        [(seq, file["file_process_id"]) for seq, file in numbered], f"{SEQ} int, file_process_id bigint"
    )
    lines = reduce(
        DataFrame.union,
        (
            rows.where(F.col(UNPARSABLE).isNotNull()).select(
                SEQ, F.col(quoted(feed.key_col)).cast("string").alias("key"), F.col(UNPARSABLE).alias("line")
            )
            for feed, rows in _by_feed(spark, numbered, options)
        ),
    )
    folder = f"{options.quarantine.rstrip('/')}/{LOAD_FOLDER}={load_id}"
    lines = lines.join(F.broadcast(ids), SEQ).select("file_process_id", "key", "line")
    lines.write.mode("overwrite").parquet(folder)
    for row in spark.read.schema(lines.schema).parquet(folder).groupBy("file_process_id").count().collect():
        outcomes[row["file_process_id"]].unparsable = row["count"]


def quarantined_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file_process_id, key, line, history_load): what loads have put aside, each with the load's name; the
    key is NULL where it fits no type itself."""
    ddl = f"file_process_id bigint, key string, line string, {LOAD_FOLDER} string"
    return spark.read.schema(ddl).parquet(folder)


def _numbered_rows(spark, numbered, options) -> DataFrame:
    """Hashed rows of all files, one scan per contract, each row with its file's number."""
    parts = []
    for feed, rows in _by_feed(spark, numbered, options):
        rows = _sound(rows)
        parts.append(
            with_hashes(
                rows,
                feed.key_col,
                feed.data_cols,
                feed.defining_col,
                feed.partition_col,
                options.load_date,
                options.null_token,
                feed.hash_key_cols,
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _ambiguous_files(census, key, open_census) -> dict[int, str]:
    """Files that cannot be merged, by number: those with several rows of a key that is open by then, in the
    table or by an earlier file that is not rejected itself.

    Who clashes with whom is asked once, as pairs of files with an example; which of them stay is then told
    in the order of the files.
    """
    example = F.min_by(F.struct(F.col(quoted(key)).alias("key"), ROWS), quoted(key))
    rejected: dict[int, str] = {}

    def reject(seq: int, clash: Row) -> None:
        rejected[seq] = _ambiguous(key, clash["key"], clash[ROWS])

    if open_census is not None:
        clashes = ambiguous_batches(census, SEQ, key, open_census.select(quoted(key)))
        for row in clashes.groupBy(SEQ).agg(example.alias("example")).collect():
            reject(row[SEQ], row["example"])
    edges = clashing_batches(census, SEQ, key).groupBy(SEQ, EARLIER).agg(example.alias("example"))
    by_file = defaultdict(list)
    for row in edges.collect():  # at most one for two files
        by_file[row[SEQ]].append(row)
    for seq in sorted(by_file):
        staying = [row["example"] for row in by_file[seq] if row[EARLIER] not in rejected]
        if staying and seq not in rejected:
            reject(seq, min(staying, key=lambda clash: clash["key"]))
    return rejected


def _load_singly(spark, kept, census, target, load_id, prior_loads, options, outcomes) -> None:
    loads = list(prior_loads)
    for seq, file in kept:
        outcome = outcomes[file["file_process_id"]]
        this_load = f"{load_id}-{seq:06d}"
        if options.writes_difference(loads):
            this_load += DIFFERENCE
        feed = Feed.of(file)
        try:
            name = UNPARSABLE if options.quarantine else None
            rows = _sound(
                read_delimited(spark, file["source_path"], feed.schema_ddl, options.check_header, name)
            )
            sizes = census.where(F.col(SEQ) == seq).select(quoted(feed.key_col), ROWS)
            hot = options.hot_keys(sizes)
            _load_rows(rows, feed, target, this_load, loads, options, hot, checked=True)
        except Exception as error:
            outcome.message, outcome.count = str(error), 0
        else:
            outcome.status, outcome.load_id = SUCCESS, this_load
            loads.append(this_load)


def run_pending(
    spark: SparkSession,
    store: ControlStore,
    options: LoadOptions = LoadOptions(),
    scheme: str = SCHEME,
    mode: str = "per_file",
    parallel: int = 2,
) -> DataFrame:
    """Load every pending file; returns the run report, one row per file: ``status`` and
    ``message``, rows read (``count``), rows without a defining value (``undated``), times.

    Files are grouped by table and loaded in the order of their registration, ``parallel`` tables
    at a time. Only file lists and contracts pass through the driver. Nothing is raised for a
    file that fails: its report row and its step-log row carry the message.
    """
    shared_folder(spark)
    steps = current_steps(store.table(STEP_LOG)).checkpoint()  # asked five times below
    contracts = build_contracts(column_contracts(store), store.table(FEEDS))
    pending = pending_files(store.table(FILE_LOG), steps, mode, options.load_step)
    files = (
        with_contract(with_paths(pending, scheme), contracts)
        .join(registered_at(steps), "file_process_id", "left")
        .orderBy("target_path", "registered_ts", "file_process_id")
        .collect()
    )
    if not files:
        return spark.createDataFrame([], REPORT_SCHEMA)
    targets = with_paths(pending, scheme).select("target_path")
    prior = done_loads(steps, options.load_step).join(targets, "target_path", "left_semi")
    loads = defaultdict(list, {row["target_path"]: row["loads"] for row in _chains(prior).collect()})
    run_id = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")

    by_target = defaultdict(list)
    for file in files:
        by_target[file["target_path"]].append(file)

    def load_target(item: tuple[str, list[Row]]) -> list[tuple]:
        target, group = item
        start = dt.datetime.now()
        try:
            outcomes = load_files(spark, group, target, run_id, loads[target], options)
        except Exception as error:
            failed = Outcome(message=str(error))
            outcomes = {file["file_process_id"]: failed for file in group}
        end = dt.datetime.now()
        results = [
            (
                file_id,
                outcome.status,
                outcome.message,
                outcome.count,
                outcome.undated,
                outcome.unparsable,
                start,
                end,
                f"{run_id}-{file_id}",
                target,
                outcome.load_id,
            )
            for file_id, outcome in outcomes.items()
        ]
        store.append(STEP_LOG, log_finish(spark.createDataFrame(results, RESULT_SCHEMA), options.load_step))
        return results

    opened = spark.createDataFrame(
        [(file["file_process_id"], file["target_path"]) for file in files],
        "file_process_id bigint, target_path string",
    )
    store.append(STEP_LOG, log_start(opened, run_id, options.load_step))
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        results = [row for rows in pool.map(load_target, by_target.items()) for row in rows]
    report = spark.createDataFrame(results, RESULT_SCHEMA)
    return report.drop("step_id", "target_path", "load_id")


def _chains(done: DataFrame) -> DataFrame:
    """(target_path, loads): each table's last full load and the difference loads since."""
    full = ~F.col("load_id").endswith(DIFFERENCE)
    bases = done.where(full).groupBy("target_path").agg(F.max("load_id").alias("base"))
    chain = done.join(bases, "target_path").where(F.col("load_id") >= F.col("base"))
    return chain.groupBy("target_path").agg(F.array_sort(F.collect_set("load_id")).alias("loads"))


def table_history(
    spark: SparkSession,
    store: ControlStore,
    target: str,
    partition_col: str = DEFAULT_PARTITION,
    load_step: str = STEP_LOAD,
    key: str | None = None,
) -> DataFrame:
    """A history table as the step log's successful loads left it. ``key``: the merge key, needed where the
    last loads are differences."""
    steps = current_steps(store.table(STEP_LOG))
    rows = done_loads(steps, load_step).where(F.col("target_path") == target).orderBy("load_id").collect()
    if not rows:
        raise ValueError(f"no successful load of {target}")
    loads = [row["load_id"] for row in rows]
    if len(since_base(loads)) > 1 and key is None:
        raise ValueError("the last loads are differences; name the table's key")
    return read_table(spark, target, loads, key, partition_col)
