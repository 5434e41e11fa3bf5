"""The same results in SQL, over the same Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from catalogue.standins import EVENT_IDENTITY, LINEITEM, ORDERS

_TIMES = {"l_shipdate", "o_orderdate", "ts"}


def _identity(columns: Sequence[str]) -> str:
    values = [f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ')" if c in _TIMES else c for c in columns]
    pairs = ", ".join(f"'{c}', {v}" for c, v in zip(columns, values))
    return f"json_object({pairs})::varchar"


def _hash(columns: Sequence[str]) -> str:
    return f"sha256({_identity(columns)})"


_LINEITEM_HASH = _hash(LINEITEM.identity)
# h: lineitem with its hash; main: the part that is loaded already.
_H = f"with h as (select *, {_LINEITEM_HASH} as trip_hash from lineitem), main as (select * from h where l_linestatus = 'F')"
_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, {tax}, "
    "l_returnflag, l_linestatus, l_shipdate"
)
_NO_TAX = _COLUMNS.format(tax="null::double as l_tax")
_WITH_TAX = _COLUMNS.format(tax="l_tax")
_UNSEEN = "not exists (select 1 from main t where t.trip_hash = h.trip_hash)"
_MERGED = f"""{_H}
    select {_WITH_TAX}, trip_hash from main
    union all select {_NO_TAX}, trip_hash from h where {_UNSEEN}"""
_BY_MONTH = "select *, strftime(l_shipdate, '%Y%m') as load_month from lineitem"

# Files close five days early; returned rows are reported again a month later.
_LANDED = """landed as (
    select *, l_shipdate + interval 5 days as closing from lineitem
    union all
    select *, l_shipdate + interval 5 days + interval 1 month from lineitem where l_returnflag = 'R')"""

_KEYS_EQUAL = " and ".join(f"t.{k} = b.{k}" for k in LINEITEM.merge_keys)

_ASSET_SPANS = """spans as (
    select 'lineitem' as kind, min(l_shipdate) as lo, max(l_shipdate) as hi from lineitem
    union all select 'orders', min(o_orderdate), max(o_orderdate) from orders),
months as (
    select kind, unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), interval 1 month)) as m
    from spans),
named as (select *, kind || '_tripdata_' || strftime(m, '%Y-%m') || '.parquet' as file_name from months)"""


def _half(text: str, start: int) -> str:
    return f"('0x' || substr(md5({text}), {start}, 16))::ubigint"


_ORDER_JSON = _identity(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
_DOCUMENT_JSON = "json_object('doc_id', doc_id, 'md5', md5(text), 'lang', lang, 'n_chars', n_chars)::varchar"

ORACLES: dict[str, str] = {
    "fingerprint_lineitem": f"""
        select l_orderkey, l_linenumber, {_identity(LINEITEM.identity)} as identity, {_LINEITEM_HASH} as trip_hash
        from lineitem""",
    "fingerprint_orders": f"""
        select o_orderkey, {_identity(ORDERS.identity)} as identity, {_hash(ORDERS.identity)} as trip_hash
        from orders""",
    "fingerprint_events": f"""
        select event_id, {_identity(EVENT_IDENTITY)} as identity, {_hash(EVENT_IDENTITY)} as trip_hash
        from events""",
    "partition_filter": "select * from lineitem where year(l_shipdate) = 1998 and month(l_shipdate) = 3",
    "month_in_time_zone": """
        select o_orderkey, strftime(o_orderdate + interval 17 hours + interval 8 hours, '%Y%m') as month_there
        from orders""",
    "normalize_names": r"""
        with cleaned as (
            select p_partkey, regexp_replace(trim(p_name), '\W+', '_', 'g') as n,
                   regexp_replace(trim(p_type), '\W+', '_', 'g') as t
            from part)
        select p_partkey,
               left(case when n = '' then 'field' when n ~ '^[0-9].*' then 'f_' || n else n end, 300) as name,
               left(case when t = '' then 'field' when t ~ '^[0-9].*' then 'f_' || t else t end, 300) as type
        from cleaned""",
    "snake_case_columns": """
        select l_orderkey as vendor_id, l_partkey as pulocation_id, l_suppkey as ratecode_id,
               l_tax as airport_fee, l_linenumber as line_number
        from lineitem""",
    "asset_plan": f"""
        with {_ASSET_SPANS}
        select kind, year(m)::integer as year, month(m)::integer as month, strftime(m, '%Y%m') as load_month, file_name,
               'source/' || file_name as source_path, 'landing/' || file_name as landing_path,
               kind || '_taxi_staging' as staging_table, kind || '_taxi' as main_table
        from named""",
    "catchup_pending": """
        with months as (
            select unnest(generate_series(date_trunc('month', min(l_shipdate)), date_trunc('month', max(l_shipdate)),
                                          interval 1 month)) as m
            from lineitem)
        select 'orders_tripdata_' || strftime(m, '%Y-%m') || '.parquet' as file_name, strftime(m, '%Y%m') as load_month
        from months where strftime(m, '%Y%m') not in (select strftime(o_orderdate, '%Y%m') from orders)""",
    "ready_gate": """
        select d.doc_id::varchar as file_name, octet_length(encode(html))::bigint as size,
               case when html is null then 'missing' when octet_length(encode(html)) < 5000 then 'too small' end as reason,
               case when octet_length(encode(html)) >= 5000 then 'ready' else 'skipped' end as status
        from documents d left join pages p on p.page_id = d.doc_id""",
    "text_md5": """
        select doc_id, octet_length(encode(text))::bigint as size, md5(text) as md5 from documents""",
    "file_checksum": f"""
        with hashed as (
            select strftime(o_orderdate, '%Y%m') as load_month, {_half(_ORDER_JSON, 1)} as a, {_half(_ORDER_JSON, 17)} as b from orders),
        reduced as (select load_month, count(*)::varchar || '-' || sum(a)::varchar || '-' || sum(b)::varchar as t from hashed group by 1)
        select 'orders' as kind, load_month, md5(t) as checksum, md5(t) as checksum_noted from reduced""",
    "scan_mixed_parts": """
        select * exclude (l_tax) replace (l_linenumber::bigint as l_linenumber), case when l_linestatus <> 'F' then l_tax end as l_tax,
               '199801' as load_month
        from lineitem""",
    "content_digest": f"""
        with hashed as (select source, {_half(_DOCUMENT_JSON, 1)} as a, {_half(_DOCUMENT_JSON, 17)} as b from documents),
        reduced as (select source, count(*) as n_rows, sum(a) as a, sum(b) as b from hashed group by source)
        select source, n_rows, md5(n_rows::varchar || '-' || a::varchar || '-' || b::varchar) as digest from reduced""",
    "landing_skip": """
        select doc_id::varchar as file_name, octet_length(encode(text))::bigint as size from documents
        where not (octet_length(encode(text)) > 1000 and doc_id in (select doc_id from labels))""",
    "landing_changed": """
        select doc_id::varchar as file_name, md5(text) as checksum from documents
        where doc_id not in (select doc_id from labels where quality = 1)""",
    "conform_schema": """
        select l_orderkey, l_shipdate, l_linenumber::bigint as l_linenumber, l_quantity::bigint as l_quantity,
               l_extendedprice, l_partkey::double as l_partkey, l_returnflag, null::double as surcharge
        from lineitem""",
    "conform_relaxed": """
        select * exclude (l_shipdate) replace (l_linenumber::bigint as l_linenumber),
               case when l_returnflag <> 'R' then l_shipdate end as l_shipdate,
               case when l_returnflag <> 'R' then strftime(l_shipdate, '%Y%m') else '000000' end as pickup_month
        from lineitem""",
    "partition_replace": f"""
        with b as ({_BY_MONTH})
        select * from b where year(l_shipdate) <> 1998 or l_returnflag = 'A'
            or load_month not in (select load_month from b where year(l_shipdate) = 1998 and l_returnflag = 'A')""",
    "write_if_empty": f"""
        with b as ({_BY_MONTH}), early as (select * from b where l_returnflag = 'A' and year(l_shipdate) < 1996)
        select * from early
        union all select * from b where load_month not in (select load_month from early)""",
    "publish_swap": f"""
        with b as ({_BY_MONTH}), n as (select load_month, count(*) as n_rows from b group by 1),
        p as (select sum(n_rows)::bigint as pending from n where load_month >= '199601')
        select 'written' as moment, load_month, n_rows, pending from n, p where load_month < '199601'
        union all select 'published', load_month, n_rows, pending from n, p""",
    "append_partition": f"{_BY_MONTH} union all {_BY_MONTH}",
    "add_column": "select *, null::varchar as trip_hash from orders",
    "merge_check_bloom": f"{_H} select exists (select 1 from h where {_UNSEEN}) as has_new",
    "new_keys_bloom": f"{_H} select distinct trip_hash from h where {_UNSEEN}",
    "merge_hot_key": """
        with b as (
            select *, case when l_orderkey % 3 = 0 then 'hot-' || l_returnflag else l_orderkey || '-' || l_linenumber end as k from lineitem)
        select * from b where not exists (select 1 from b t where t.l_linestatus = 'F' and t.k = b.k)""",
    "merge_check": f"{_H} select exists (select 1 from h where {_UNSEEN}) as has_new",
    "merge_insert": _MERGED,
    "merge_rerun_noop": _MERGED,
    "merge_keeps_batch_dups": f"""{_H}, twice as (select * from h union all select * from h)
        select * from twice h where {_UNSEEN}""",
    "merge_null_target_hash": f"""{_H}
        select * from h where not exists (
            select 1 from main t
            where case when t.l_returnflag <> 'R' then t.trip_hash end = h.trip_hash)""",
    "merge_on_keys": f"""
        select * from lineitem b where not exists (
            select 1 from lineitem t where t.l_linestatus = 'F' and {_KEYS_EQUAL})""",
    "merge_months_in_order": f"""
        with b as ({_BY_MONTH}),
        firsts as (select l_orderkey, l_linenumber, min(load_month) as m from b group by all)
        select b.* from b join firsts f
            on f.l_orderkey = b.l_orderkey and f.l_linenumber = b.l_linenumber and f.m = b.load_month
        where not exists (
            select 1 from lineitem t
            where t.l_linestatus = 'F' and t.l_orderkey = b.l_orderkey and t.l_linenumber = b.l_linenumber)""",
    "monthly_run": f"""
        select {_NO_TAX.replace("l_linenumber", "l_linenumber::bigint as l_linenumber")},
               {_LINEITEM_HASH} as trip_hash, strftime(l_shipdate + interval 5 days, '%Y%m') as load_id,
               strftime(l_shipdate, '%Y%m') as pickup_month
        from lineitem""",
    "load_report": f"""
        with {_LANDED},
        counted as (
            select strftime(closing, '%Y%m') as load_month, count(*) as rows_read,
                   count(*) filter (closing = l_shipdate + interval 5 days) as rows_new
            from landed group by 1)
        select 'lineitem' as kind, load_month, case when rows_new > 0 then 'loaded' else 'skipped' end as status,
               rows_read, rows_new, 1::integer as fingerprint_version
        from counted
        union all
        select 'orders', strftime(o_orderdate, '%Y%m'), 'loaded', count(*), count(*), 1 from orders group by 2""",
    "stream_catch_up": f"""
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, null::varchar as o_orderpriority,
               {_hash(ORDERS.identity)} as trip_hash, strftime(o_orderdate, '%Y%m') as load_id,
               strftime(o_orderdate, '%Y%m') as pickup_month
        from orders""",
}

ORACLES["run_recovered"] = f"""
    with r as ({ORACLES["stream_catch_up"]})
    select r.*, m.write_mode from r cross join (values ('truncate'), ('if_empty'), ('append')) m (write_mode)"""
ORACLES["load_report_append"] = f"""
    with {_LANDED}
    select strftime(closing, '%Y%m') as load_month, 'skipped' as status, 'nothing new' as reason, count(*) as rows_read, 0::bigint as rows_new
    from landed group by 1"""
ORACLES["stream_quarantine"] = ORACLES["stream_catch_up"] + " where strftime(o_orderdate, '%Y%m') <> '199603'"

# Ways and modes that must give what the plain run gives.
for _same, _as in {
    "monthly_run_shuffled": "monthly_run",
    "monthly_run_filtered": "monthly_run",
    "run_if_empty": "monthly_run",
    "run_append": "monthly_run",
    "load_report_shuffled": "load_report",
}.items():
    ORACLES[_same] = ORACLES[_as]
