"""The queries of ``queries`` in SQL, for a comparison on the same tables."""

from __future__ import annotations

LOAD_DATE = "2024-02-01"
NEXT_DATE = "2024-02-02"
CUT_OVER = "timestamp '2024-01-16'"


def _audited(source: str, key: str, defining: str, data: str, tie: str, date: str) -> str:
    return f"""
        select *, sha256(cast({key} as varchar)) as "hashKey",
               sha256(concat_ws('|', {data})) as "hashData",
               {defining} as "startDate",
               lead({defining}) over (
                   partition by {key} order by {defining} nulls first{tie}) as "endDate",
               '{date}' as date_loaded
        from ({source}) as source_rows"""


ORDERS = _audited(
    "select * from orders",
    "o_custkey",
    "o_orderdate",
    "o_orderstatus, o_orderpriority",
    ", o_orderkey",
    LOAD_DATE,
)
EVENTS_BEFORE = _audited(
    f"select * from events where ts < {CUT_OVER}",
    "user_id",
    "ts",
    "event_type",
    ", event_id",
    LOAD_DATE,
)
LAST_AFTER = f"""select * from events where ts >= {CUT_OVER}
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
EVENTS_AFTER = _audited(LAST_AFTER, "user_id", "ts", "event_type", ", event_id", NEXT_DATE)


def _merged(target: str, batch: str, key: str, columns: str, extra: str = "") -> str:
    """``columns``: all but endDate; ``extra``: columns only the batch has, with a leading comma."""
    missing = ", ".join(f"null as {name}" for name in extra.split(",") if name.strip())
    missing = f", {missing}" if missing else ""
    own = ", ".join(f"o.{name.strip()}" for name in columns.split(","))
    return f"""
    with target as ({target}), batch as ({batch}),
    open_rows as (select * from target where "endDate" is null)
    select {columns}, "endDate"{missing} from target where "endDate" is not null
    union all
    select {own},
           case when b."hashData" <> o."hashData" then b."startDate" else o."endDate" end{missing}
    from open_rows o left join batch b on o.{key} = b.{key}
    union all
    select {columns}, "endDate"{extra} from batch b
    where not exists (select 1 from open_rows o
                      where o.{key} = b.{key} and o."hashData" = b."hashData")"""


AUDIT = '"hashKey", "hashData", "startDate", date_loaded'
EVENT_COLUMNS = f"event_id, ts, user_id, event_type, value, props, {AUDIT}"
MERGED_EVENTS = _merged(EVENTS_BEFORE, EVENTS_AFTER, "user_id", EVENT_COLUMNS)

DAILY = f"""
    select *, sha256(cast(user_id as varchar)) as "hashKey", sha256(event_type) as "hashData",
           ts as "startDate", '{LOAD_DATE}' as date_loaded
    from (select *, cast(date_diff('day', date '2024-01-01', cast(ts as date)) as integer)
                        as day_no from events)
    qualify row_number() over (partition by user_id, day_no order by ts desc, event_id desc) = 1"""

CUSTOMERS = "select *, timestamp '2024-01-01' as \"asOf\" from customer"
CUSTOMERS_LATER = """
    select * replace (case when c_mktsegment = 'BUILDING' then c_acctbal + 100.5
                           else c_acctbal end as c_acctbal),
           timestamp '2024-02-01' as "asOf" from customer"""


def _audited_customers(source: str) -> str:
    return _audited(source, "c_custkey", '"asOf"', "c_acctbal, c_mktsegment", "", LOAD_DATE)


STEPS = """
    select cast(event_id as varchar) as step_id, user_id as file_process_id,
           case when event_type = 'signup' then 'File Registration'
                when event_type = 'purchase' and ts < timestamp '2024-01-15'
                then 'History Load' end as step_name,
           case when value > {above} then 'DONE' else 'ERROR' end as step_status, ts
    from events"""
FILES = "select user_id as file_process_id, max(event_id) as fp_id from events group by user_id"

CONTRACTS = """
    with columns_in as (
        select l_orderkey as fp_id,
               concat_ws('_', 'c', l_linenumber, l_partkey) as col_name,
               case when l_returnflag = 'A' then 'IntegerType'
                    when l_returnflag = 'N' then 'StringType'
                    when l_quantity > 45 then 'BooleanType' else 'TimestampType' end as datatype,
               l_linenumber - 1 as ordinal,
               case when l_linestatus = 'O' then 0 else 1 end as pos,
               l_discount > 0.05 as is_defining, l_tax <= 0.04 as is_plain
        from lineitem),
    typed as (
        select *, case datatype when 'IntegerType' then 'int' when 'StringType' then 'string'
                                when 'TimestampType' then 'timestamp' end as ddl,
               ordinal = pos as is_key
        from columns_in),
    roles as (
        select fp_id,
               count(*) filter (where ddl is null) as unknown_count,
               string_agg(col_name, ', ' order by ordinal, col_name)
                   filter (where ddl is null) as unknown_types,
               case when unknown_count = 0 then
                   string_agg('`' || col_name || '` ' || ddl, ', '
                              order by ordinal, col_name, datatype) end as schema_ddl,
               coalesce(string_agg(col_name, ',' order by ordinal, col_name)
                        filter (where is_key), '') as key_cols,
               coalesce(string_agg(col_name, ',' order by ordinal, col_name)
                        filter (where is_defining), '') as defining_cols,
               coalesce(string_agg(col_name, ',' order by ordinal, col_name)
                        filter (where is_plain and not is_key), '') as data_cols
        from typed group by fp_id),
    feeds as (
        select o_orderkey as fp_id,
               case when o_orderstatus = 'P' then 'JSON' else 'DELIMITED' end as file_format,
               'date_loaded,' || o_orderpriority as partition_cols
        from orders),
    contracts as (
        select fp_id, file_format, schema_ddl, key_cols, defining_cols, data_cols, partition_cols,
               case when key_cols <> '' then split_part(key_cols, ',', 1) end as key_col,
               case when defining_cols <> '' then split_part(defining_cols, ',', 1) end
                   as defining_col,
               'date_loaded' as partition_col,
               case when file_format <> 'DELIMITED' then 'file format is not DELIMITED'
                    when unknown_count is null then 'no columns in the contract'
                    when unknown_count > 0 then 'unknown type for ' || unknown_types
                    when key_cols = '' then 'no key column'
                    when defining_cols = '' then 'no defining column' end as problem
        from feeds left join roles using (fp_id))"""

RUN_EVENTS = _merged(
    EVENTS_BEFORE,
    _audited(LAST_AFTER, "user_id", "ts", "event_type", ", event_id", LOAD_DATE),
    "user_id",
    EVENT_COLUMNS,
)

ORDERS_BY_PRIORITY = ("o_orderpriority", "o_orderdate", "o_orderstatus", ", o_orderkey", LOAD_DATE)
URGENT_BATCH = """
    select * from orders where o_orderpriority = '1-URGENT'
    union all
    select * replace ('X' as o_orderstatus, timestamp '1999-01-01' as o_orderdate) from (
        select * from orders where o_orderpriority <> '1-URGENT'
        qualify row_number() over (
            partition by o_orderpriority order by o_orderdate desc, o_orderkey desc) = 1)"""

# The loads of six days each, merged one after another: a chain of each user's rows, as in a fold.
DIFFERENCES = f"""
    with target as ({EVENTS_BEFORE}),
    loads as (
        select *, date_diff('day', date '2024-01-16', cast(ts as date)) // 6 as load_no
        from events where ts >= {CUT_OVER}),
    batches as (
        select *, sha256(cast(user_id as varchar)) as "hashKey", sha256(event_type) as "hashData",
               ts as "startDate", '{LOAD_DATE}' as date_loaded
        from loads where load_no < 3
        qualify row_number() over (
            partition by user_id, load_no order by ts desc, event_id desc) = 1),
    chain as (
        select -1 as load_no, * exclude ("endDate") from target where "endDate" is null
        union all by name select * from batches),
    kept as (
        select * from chain
        qualify "hashData" is distinct from
                lag("hashData") over (partition by user_id order by load_no)),
    history as (
        select * from target where "endDate" is not null
        union all by name
        select * exclude (load_no),
               lead("startDate") over (partition by user_id order by load_no) as "endDate"
        from kept)"""

ORACLE_SQL = {
    "hash_columns": """
        select o_orderkey, sha256(cast(o_custkey as varchar)) as "hashKey",
               sha256(concat_ws('|', o_orderstatus, o_totalprice, o_orderdate, o_orderpriority))
                   as "hashData"
        from orders""",
    "documents_hash": """
        select doc_id, sha256(concat_ws('|', text, lang, source)) as "hashData" from documents""",
    "audit_columns": ORDERS,
    "hash_key_columns": f"""
        select l_orderkey, l_linenumber, l_suppkey,
               sha256(l_orderkey || '|' || l_linenumber) as "hashKey",
               sha256(l_returnflag || '|' || l_linestatus) as "hashData",
               l_shipdate as "startDate", '{LOAD_DATE}' as date_loaded
        from lineitem""",
    "audit_columns_hot_key": _audited(
        "select * from orders", "o_orderpriority", "o_orderdate", "o_orderstatus", ", o_orderkey",
        LOAD_DATE,
    ),
    "scd2_merge_broadcast": MERGED_EVENTS,
    "current_rows": f'select * from ({ORDERS}) where "endDate" is null',
    "changed_rows": f"""
        with target as ({EVENTS_BEFORE}), batch as ({EVENTS_AFTER})
        select batch.* from batch join target on batch.user_id = target.user_id
        where target."endDate" is null and batch."hashData" <> target."hashData\"""",
    "staged_updates": f"""
        with target as ({EVENTS_BEFORE}), batch as ({EVENTS_AFTER})
        select cast(null as bigint) as "mergeKey", batch.*
        from batch join target on batch.user_id = target.user_id
        where target."endDate" is null and batch."hashData" <> target."hashData"
        union all
        select user_id as "mergeKey", * from batch""",
    "scd2_merge": MERGED_EVENTS,
    "scd2_merge_new_keys": _merged(
        _audited_customers(f"{CUSTOMERS} where c_mktsegment <> 'MACHINERY'"),
        _audited_customers(CUSTOMERS_LATER),
        "c_custkey",
        f'c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "asOf", {AUDIT}',
    ),
    "scd2_merge_evolving": _merged(
        EVENTS_BEFORE,
        f"select *, cast(floor(value / 10) as bigint) as value_band from ({EVENTS_AFTER})",
        "user_id",
        EVENT_COLUMNS,
        ", value_band",
    ),
    "scd2_merge_key_bits": _merged(
        _audited_customers(CUSTOMERS),
        _audited_customers("""
            select * replace (c_acctbal + 100.5 as c_acctbal), timestamp '2024-02-01' as "asOf"
            from customer where c_nationkey < 3"""),
        "c_custkey",
        f'c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "asOf", {AUDIT}',
    ),
    "scd2_merge_hot_key": _merged(
        _audited("select * from orders where o_orderpriority <> '1-URGENT'", *ORDERS_BY_PRIORITY),
        _audited(URGENT_BATCH, *ORDERS_BY_PRIORITY),
        "o_orderpriority",
        f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, {AUDIT}",
    ),
    "scd2_fold_hot_keys": f"""
        with rows_in as (
            select *, cast(0 as integer) as day_no from events where ts < {CUT_OVER}
            union all
            select * from (
                select *, cast(date_diff('day', date '2024-01-01', cast(ts as date)) as integer)
                              as day_no
                from events where ts >= {CUT_OVER})
            qualify row_number() over (
                partition by event_type, day_no order by ts desc, event_id desc) = 1),
        hashed as (
            select *, sha256(event_type) as "hashKey", sha256(cast(user_id as varchar)) as "hashData",
                   ts as "startDate", '{LOAD_DATE}' as date_loaded
            from rows_in),
        compared as (
            select *, min(day_no) over (partition by event_type) as first_day,
                   lag("hashData") over (
                       partition by event_type order by day_no, ts, event_id) as before
            from hashed),
        kept as (
            select * exclude (first_day, before) from compared
            where day_no = first_day or "hashData" <> before)
        select *, lead("startDate") over (
                      partition by event_type order by day_no, ts, event_id) as "endDate"
        from kept""",
    "fold_undated_rows": f"""
        with recursive daily as (
            select * replace (case when event_id % 11 <> 0 then "startDate" end as "startDate"),
                   case when event_id % 11 <> 0 then ts end as seen_at,
                   lag(day_no) over (partition by user_id order by day_no) as day_before,
                   max(day_no) over (partition by user_id) as last_day
            from ({DAILY})),
        -- Each open row from day to day of its user: it is closed, stays, and meets the day's row.
        chains as (
            select user_id, event_id, "hashData", day_no, true as is_open,
                   cast(null as timestamp) as ended
            from daily where day_before is null
            union all
            select user_id,
                   case when nth = 1 then old_id else new_id end,
                   case when nth = 1 then old_hash else new_hash end,
                   day_no,
                   not (nth = 1 and differs and since is not null),
                   case when nth = 1 and differs then since end
            from (
                select c.user_id, c.event_id as old_id, c."hashData" as old_hash,
                       d.event_id as new_id, d."hashData" as new_hash, d.day_no,
                       d."startDate" as since, c."hashData" <> d."hashData" as differs
                from chains c join daily d on d.user_id = c.user_id and d.day_before = c.day_no
                where c.is_open) as met
            cross join (values (1), (2)) as nths(nth)
            where nth = 1 or differs)
        select d.* exclude (day_before, last_day), c.ended as "endDate"
        from chains c join daily d on d.event_id = c.event_id and d.user_id = c.user_id
        where not c.is_open or c.day_no = d.last_day""",
    "difference_loads": f"{DIFFERENCES} select * from history",
    "difference_loads_open": f'{DIFFERENCES} select * from history where "endDate" is null',
    "difference_loads_rebased": f"{DIFFERENCES} select * from history",
    "ambiguous_keys": f"""
        select user_id, count(*) as n from events
        where ts >= {CUT_OVER} and user_id in (select user_id from events where ts < {CUT_OVER})
        group by user_id having count(*) > 1""",
    "ambiguous_batches_daily": """
        with per_day as (
            select cast(date_diff('day', date '2024-01-01', cast(ts as date)) as integer) as day_no,
                   user_id, count(*) as n
            from events group by all)
        select day_no, user_id, n from per_day
        where n > 1 and day_no > (select min(f.day_no) from per_day f
                                  where f.user_id = per_day.user_id)""",
    "scd2_fold_daily": f"""
        with daily as ({DAILY}),
        compared as (
            select *, min(day_no) over (partition by user_id) as first_day,
                   lag("hashData") over (partition by user_id order by day_no, ts) as before
            from daily),
        kept as (
            select * exclude (first_day, before) from compared
            where day_no = first_day or "hashData" <> before)
        select *, lead("startDate") over (partition by user_id order by day_no, ts) as "endDate"
        from kept""",
    "scd2_fold_onto_history": f"""
        with target as ({EVENTS_BEFORE}),
        chain as (
            select -1 as day_no, * exclude ("endDate") from target where "endDate" is null
            union all by name
            select * from ({DAILY}) where ts >= {CUT_OVER}),
        compared as (
            select *, min(day_no) over (partition by user_id) as first_day,
                   lag("hashData") over (partition by user_id order by day_no, ts) as before
            from chain),
        kept as (
            select * exclude (first_day, before) from compared
            where day_no = first_day or "hashData" <> before)
        select * from target where "endDate" is not null
        union all by name
        select * exclude (day_no),
               lead("startDate") over (partition by user_id order by day_no, ts) as "endDate"
        from kept""",
    "csv_scan": "select * from orders",
    "batch_count": "select count(*) as row_count from lineitem",
    "append_evolving": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               case when o_orderdate >= timestamp '1998-01-01' then o_orderpriority end
                   as o_orderpriority,
               case when o_orderdate >= timestamp '1998-01-01' then '2024-02-02'
                    else '2024-02-01' end as date_loaded
        from orders""",
    "first_load_roundtrip": ORDERS,
    "merge_load_roundtrip": MERGED_EVENTS,
    "open_rows_after_merge": f'select * from ({MERGED_EVENTS}) where "endDate" is null',
    "csv_load_batch": MERGED_EVENTS,
    "quarantine_lines": """
        select case when o_orderkey % 50 = 0 then 'aside' else 'loaded' end as state, o_orderkey,
               o_orderkey % 50 = 0 as no_price,
               (select count(*) from orders where o_orderkey % 50 <> 0) as n_loaded,
               (select count(*) from orders where o_orderkey % 50 = 0) as n_aside
        from orders""",
    "contracts": f"{CONTRACTS} select * from contracts",
    "files_with_contract": f"""{CONTRACTS}
        select event_id as file_process_id, user_id * 100 as fp_id, key_col, defining_col,
               partition_col,
               case when contracts.fp_id is null then 'unknown feed' else problem end as problem
        from events left join contracts on contracts.fp_id = user_id * 100""",
    "pending_files": f"""
        with steps as ({STEPS.format(above=60)}), files as ({FILES})
        , watermark as (
            select max(ts) as since from steps
            where step_status = 'DONE' and step_name = 'History Load'
        ), ready as (
            select file_process_id from steps cross join watermark
            where step_status = 'DONE' and step_name = 'File Registration'
            group by file_process_id, since
            having since is null or max(ts) > since
        )
        select files.* from files join ready using (file_process_id)""",
    "pending_files_per_file": f"""
        with steps as ({STEPS.format(above=120)}), files as ({FILES})
        select * from files
        where exists (select 1 from steps where steps.file_process_id = files.file_process_id
                      and step_name = 'File Registration' and step_status = 'DONE')
          and not exists (select 1 from steps where steps.file_process_id = files.file_process_id
                          and step_name = 'History Load' and step_status = 'DONE')""",
    "high_watermark": f"""
        with steps as ({STEPS.format(above=60)})
        select coalesce(max(ts), timestamp '1970-01-01') as since from steps
        where step_name = 'History Load' and step_status = 'DONE'""",
    "registered_at": f"""
        with steps as ({STEPS.format(above=60)})
        select file_process_id, max(ts) as registered_ts from steps
        where step_name = 'File Registration' and step_status = 'DONE'
        group by file_process_id""",
    "derive_paths": r"""
        select *, 's3a://' || bucket_name || '/' || filename as source_path,
               's3a://' || replace(bucket_name, 'landing', 'raw') || '/'
               || regexp_replace(split_part(filename, '/', -1), '_\d+.csv', '', 'g')
               || '.parquet' as target_path
        from (select doc_id, 'landing-' || lang as bucket_name,
                     'in/' || source || '_' || doc_id || '.csv' as filename
              from documents)""",
    "step_log_current": """
        select * from (
            select user_id || '-' || event_type as step_id,
                   case when value > 60 then 'DONE' else 'IN-PROGRESS' end as step_status,
                   ts as upsert_ts
            from events)
        qualify row_number() over (partition by step_id order by upsert_ts desc) = 1""",
    "step_log_cycle": """
        select 'run-' || o_orderkey as step_id, 'History Load' as step_name,
               case o_orderstatus when 'O' then 'IN-PROGRESS' when 'P' then 'ERROR'
                                  else 'DONE' end as step_status,
               case o_orderstatus when 'O' then 'running' when 'P' then 'partly shipped'
                                  else 'Completed Successfully' end as step_status_detail,
               'raw/' || o_orderpriority as target_path,
               case when o_orderstatus = 'F' then 'load-1' end as load_id
        from orders""",
    "done_loads": """
        select distinct 'raw/' || o_custkey as target_path,
               lpad(cast(o_orderkey as varchar), 12, '0') as load_id
        from orders where o_orderstatus = 'F'""",
    "run_pending": f"""
        select 'events' as table_name, user_id as key, "hashKey", "hashData", "startDate",
               "endDate", date_loaded
        from ({RUN_EVENTS})
        union all
        select 'orders', o_custkey, "hashKey", "hashData", "startDate", "endDate", date_loaded
        from ({ORDERS})""",
    "run_incompatible_file": f"""
        with history as ({RUN_EVENTS})
        select 1 as file_process_id, 'Success' as status, '' as message,
               (select count(*) from events where ts < {CUT_OVER}) as count,
               (select count(*) from history) as table_rows
        union all
        select 2, 'Success', '',
               (select count(distinct user_id) from events where ts >= {CUT_OVER}),
               (select count(*) from history)
        union all
        select 3, 'Success', '', (select count(*) from orders), (select count(*) from history)
        union all
        select 4, 'Failed', 'path', 0, (select count(*) from history)
        union all
        select 5, 'Failed', 'column value is string in the batch, double in the table', 0,
               (select count(*) from history)""",
    "run_report": f"""
        select 1 as file_process_id, 'Success' as status, '' as error_class,
               (select count(*) from events where ts < {CUT_OVER}) as count,
               'DONE' as step_status, true as visible
        union all
        select 2, 'Success', '',
               (select count(distinct user_id) from events where ts >= {CUT_OVER}), 'DONE', true
        union all
        select 3, 'Success', '', (select count(*) from orders), 'DONE', true
        union all
        select 4, 'Failed', 'PATH_NOT_FOUND', 0, 'ERROR', false""",
}
