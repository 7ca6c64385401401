"""The registered queries as DuckDB SQL over the driver's tables."""

from __future__ import annotations

from basketflow.catalogue.inputs import BROKEN_FILES, BROKEN_KINDS, CSV_ROWS, FLAWS, RECORD_ITEMS, SENT_BROKEN
from basketflow.catalogue.queries import HEADERS_UNTIL, ORIGIN_SPLIT, PREVIEW, REPORT_SINCE, REPORT_UNTIL, TOP_K

SUPERMARKETS = """
    select format('STORE{:04d}', n_nationkey + 1) as supermarket_id, n_name as supermarket_name from nation
"""
SKUS = """
    select format('SKU{:05d}', p_partkey + 1) as sku, p_name as article_name,
           cast(p_retailprice as decimal(12,2)) as price
    from part
"""
HEADERS = """
    select format('TX{:07d}', o_orderkey + 1) as transaction_id,
           format('STORE{:04d}', c_nationkey + 1) as supermarket_id,
           cast(o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as timestamp) as transaction_date
    from orders join customer on c_custkey = o_custkey
"""
DETAILS = """
    select format('TX{:07d}', l_orderkey + 1) as transaction_id,
           format('SKU{:05d}', l_partkey + 1) as sku,
           cast(l_quantity as integer) as quantity
    from lineitem
"""
OPEN = "(isodow(transaction_date) <> 7 and hour(transaction_date) >= 9 and hour(transaction_date) < 21)"


def _with_tables(select: str) -> str:
    return (
        f"with supermarkets as ({SUPERMARKETS}), skus as ({SKUS}), headers as ({HEADERS}), "
        f"details as ({DETAILS}) {select}"
    )


def _sales(where: str = "") -> str:
    return _with_tables(
        f"""
        select h.supermarket_id, s.supermarket_name,
               count(distinct h.transaction_id) as transactions,
               cast(sum(d.quantity) as bigint) as units,
               cast(sum(d.quantity * k.price) as double) as sales
        from details d
        join headers h on h.transaction_id = d.transaction_id
        join skus k on k.sku = d.sku
        join supermarkets s on s.supermarket_id = h.supermarket_id
        {where}
        group by h.supermarket_id, s.supermarket_name
        """
    )


# Reason of each kind of broken line, in the order of the kinds.
_BROKEN_REASONS = (
    ["bad_line"] * 3 + ["no_log"] * 3 + ["not_json"] * 2 + ["not_object"] * 2 + ["no_id"] + ["null_id"]
)
assert len(_BROKEN_REASONS) == BROKEN_KINDS
_REASON_OF_ORDER = " ".join(
    f"when {kind} then '{reason}'" for kind, reason in enumerate(_BROKEN_REASONS)
)

# Flags of each flawed line, in the order of the flaws.
_FLAW_FLAGS = [
    [], ["bad_date"], ["bad_items"], [], ["null_item"], ["bad_date", "bad_quantity"],
    ["null_item", "bad_quantity"], ["bad_date"],
]
assert len(_FLAW_FLAGS) == len(FLAWS)
_FLAGS_OF_ORDER = " ".join(f"when {kind} then {flags}::varchar[]" for kind, flags in enumerate(_FLAW_FLAGS))

# Quantities of the items that are read from each flawed line (0 for one that cannot be), in the order of the flaws.
_FLAW_ITEMS = [[1], [1], [], [], [], [0], [0], []]
assert len(_FLAW_ITEMS) == len(FLAWS)
_ITEMS_OF_ORDER = " ".join(f"when {kind} then {items}::integer[]" for kind, items in enumerate(_FLAW_ITEMS))

# A header for each record that an order comes as.
_SENT = f"""
    select * exclude (part) from (
        select h.*, unnest(range(cast(greatest(1, ceil(coalesce(c.n, 0) / {RECORD_ITEMS}.0)) as bigint))) as part
        from headers h left join (select transaction_id, count(*) as n from details group by transaction_id) c
        on c.transaction_id = h.transaction_id
    )
"""
_HEADERS = _with_tables(_SENT)
_DETAILS = _with_tables("select * from details")

# Outcomes of each CSV row, in the order of the rows.
_CSV_OUTCOMES = [["kept"], ["bad_items"], ["bad_row"], ["bad_row"], ["bad_date"], ["bad_items", "bad_row"]]
assert len(_CSV_OUTCOMES) == len(CSV_ROWS)
_OUTCOMES_OF_ORDER = " ".join(f"when {kind} then {outcomes}::varchar[]" for kind, outcomes in enumerate(_CSV_OUTCOMES))


def _contents(rejects: str) -> str:
    """Headers and details as text, and the number of refused lines."""
    return _with_tables(
        f"""
        select 'headers' as stored_in, transaction_id,
               supermarket_id || ' ' || strftime(transaction_date, '%Y-%m-%d %H:%M:%S') as content from ({_SENT})
        union all select 'details', transaction_id, sku || ' ' || quantity from details
        union all select 'rejects', 'none', cast({rejects} as varchar)
        """
    )


# Every text of a conversation is sent bare and in an envelope.
_JUNK = "(select 2 * count(*) from conversations)"

ORACLE: dict[str, str] = {
    "shred_headers": _HEADERS,
    "shred_details": _DETAILS,
    "filter_valid_tx": _with_tables(f"select transaction_id from ({_SENT})"),
    "quarantine_reasons": f"""
        select reason, count(*) as lines from (
            select case o_orderkey % {BROKEN_KINDS} {_REASON_OF_ORDER} end as reason from orders
            union all select 'not_json' from conversations
            union all select 'bad_line' from conversations
        ) group by reason
    """,
    "bad_dates": """
        select format('TX{:07d}', o_orderkey + 1) as transaction_id,
               case when o_orderkey % 2 = 0 then 'bad' else strftime(o_orderdate, '%Y-%m-%d') end as date_text
        from orders where o_orderpriority = '5-LOW'
    """,
    "flag_counts": f"""
        select flag, count(*) as records from (
            select unnest(case o_orderkey % {len(FLAWS)} {_FLAGS_OF_ORDER} end) as flag from orders
        ) group by flag
    """,
    "csv_items_roundtrip": _DETAILS,
    "csv_headers": _HEADERS,
    "dim_skus": _with_tables("select sku, article_name, cast(price as double) as price from skus"),
    "dim_stores": _with_tables("select * from supermarkets"),
    "scan_headers": _with_tables(
        "select count(*) as headers, min(transaction_date) as first_sale, max(transaction_date) as last_sale "
        f"from ({_SENT})"
    ),
    "scan_details": _with_tables(
        "select count(*) as details, cast(sum(quantity) as bigint) as units, "
        "min(sku) as first_sku, max(sku) as last_sku from details"
    ),
    "write_overwrite_readback": _DETAILS,
    "write_append_readback": _HEADERS,
    "stream_shred_headers": _HEADERS,
    "stream_shred_details": _DETAILS,
    # Refused lines are never dropped as copies.
    "stream_dedupe": _contents(f"3 * {_JUNK}"),
    "dedupe_transactions": _contents(f"2 * {_JUNK}"),
    "late_copies_dropped": _contents(f"3 * {_JUNK}"),
    "stream_late_files": _contents(_JUNK),
    "stream_archive": f"""
        select *, 'archive' as place from ({_contents(_JUNK)}) union all select 'rejects', 'none', '0', 'incoming'
    """,
    "compacted_readback": f"""
        select stored_in, transaction_id, content,
               case when stored_in = 'rejects' then 'all'
                    when cast(substr(transaction_id, 3) as bigint) % 4 < 3 then 'unit' else 'load' end as place
        from ({_contents(_JUNK)}) union all select 'folders', 'none', '[3]', 'load'
    """,
    "csv_multi_line": _DETAILS,
    "stream_broken_files": f"""
        select stored_in, transaction_id, content from ({_contents("0")})
        where stored_in <> 'rejects' and cast(substr(transaction_id, 3) as bigint) % 3 <> {SENT_BROKEN}
        union all select 'rejects', 'bad_file', '{BROKEN_FILES}'
        union all select 'rejects', unnest(['bad_line', 'not_json']), cast(count(*) as varchar) from conversations
    """,
    "load_checks": _with_tables(
        f"""
        , flawed as (select unnest(case o_orderkey % {len(FLAWS)} {_FLAGS_OF_ORDER} end) as flag from orders),
        parsed as (select unnest(case o_orderkey % {len(FLAWS)} {_ITEMS_OF_ORDER} end) as quantity from orders)
        select 'headers' as rule, (select count(*) from ({_SENT})) + (select count(*) from orders) as rows
        union all select 'details', (select count(*) from details) + (select count(*) from parsed)
        union all select 'rejects', 2 * count(*) from conversations
        union all select unnest(['bad_line', 'not_json']), count(*) from conversations
        union all select unnest(['no_log', 'not_object', 'no_id', 'null_id', 'bad_row', 'bad_file']), 0
        union all select f.flag, (select count(*) from flawed w where w.flag = f.flag)
            from (select unnest(['bad_date', 'bad_items', 'null_item', 'bad_quantity']) as flag) f
        union all select 'quantity_range', (select count(*) from details where quantity < 1 or quantity > 5)
            + (select count(*) from parsed where quantity = 0)
        union all select 'sku_format', count(*) from details where not regexp_full_match(sku, 'SKU[0-9]{{5,}}')
        union all select 'detail_transaction_format', count(*) from details where not regexp_full_match(transaction_id, 'TX[0-9]{{7,}}')
        union all select 'store_format', (select count(*) from headers where not regexp_full_match(supermarket_id, 'STORE[0-9]{{4,}}'))
            + (select count(*) from orders)
        union all select 'header_transaction_format', count(*) from headers where not regexp_full_match(transaction_id, 'TX[0-9]{{7,}}')
        """
    ),
    "orphans_by_load": _with_tables(
        f"""
        select d.* from details d where not exists (
            select 1 from headers h
            where h.transaction_id = d.transaction_id and h.transaction_date < timestamp '{HEADERS_UNTIL}'
        )
        """
    ),
    "sales_on_quarter_ends": _with_tables(
        """
        select day, count(*) as transactions, cast(coalesce(sum(units), 0) as bigint) as units from (
            select cast(date_trunc('month', h.transaction_date) as timestamp) as day, h.transaction_id, sum(d.quantity) as units
            from headers h left join details d on d.transaction_id = h.transaction_id
            where month(h.transaction_date) % 3 = 0 group by all
        ) group by day
        """
    ),
    "csv_broken_rows": f"""
        select outcome, count(*) as lines from (
            select unnest(case o_orderkey % {len(CSV_ROWS)} {_OUTCOMES_OF_ORDER} end) as outcome from orders
        ) group by outcome
    """,
    "sales_after_redelivery": _sales(),
    "stream_top_skus": _with_tables(
        f"""
        select d.sku, k.article_name, cast(sum(d.quantity) as bigint) as units
        from details d join skus k on k.sku = d.sku
        group by d.sku, k.article_name order by units desc, d.sku limit {TOP_K}
        """
    ),
    "preview": _with_tables(f"select * from headers order by transaction_date, transaction_id limit {PREVIEW}"),
    "sql_reused_ids": """
        select format('TX{:07d}', o_orderkey % (select count(*) // 2 from orders) + 1) as transaction_id,
               format('STORE{:04d}', c_nationkey + 1) as supermarket_id,
               cast(o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as timestamp) as transaction_date,
               cast(sum(cast(l_quantity as integer)) as bigint) as units
        from orders join customer on c_custkey = o_custkey join lineitem on l_orderkey = o_orderkey
        group by all
    """,
    "stream_sales_by_store": _with_tables(
        """
        select h.supermarket_id, cast(sum(d.quantity) as bigint) as units,
               cast(sum(d.quantity * k.price) as double) as sales
        from details d
        join headers h on h.transaction_id = d.transaction_id
        join skus k on k.sku = d.sku
        group by h.supermarket_id
        """
    ),
    "join_header_detail": _with_tables(
        """
        select h.transaction_id, h.supermarket_id, h.transaction_date, d.sku, d.quantity
        from headers h join details d on d.transaction_id = h.transaction_id
        """
    ),
    "line_revenue": _with_tables(
        """
        select d.transaction_id, d.sku, d.quantity, cast(k.price as double) as price,
               cast(d.quantity * k.price as double) as revenue
        from details d join skus k on k.sku = d.sku
        """
    ),
    "sales_by_store": _sales(),
    "sales_by_store_dated": _sales(
        f"where h.transaction_date >= timestamp '{REPORT_SINCE}' and h.transaction_date < timestamp '{REPORT_UNTIL}'"
    ),
    "end_to_end_sales": _sales(),
    "top_skus_by_units": _with_tables(
        f"""
        select d.sku, k.article_name, cast(sum(d.quantity) as bigint) as units
        from details d join skus k on k.sku = d.sku
        group by d.sku, k.article_name order by units desc, d.sku limit {TOP_K}
        """
    ),
    "top_skus_by_sales": _with_tables(
        f"""
        select sku, article_name, cast(total as double) as sales from (
            select d.sku, k.article_name, sum(d.quantity * k.price) as total
            from details d join skus k on k.sku = d.sku
            group by d.sku, k.article_name order by total desc, d.sku limit {TOP_K}
        )
        """
    ),
    "orphan_details": _with_tables(
        f"""
        select d.* from details d where not exists (
            select 1 from headers h
            where h.transaction_id = d.transaction_id and h.transaction_date < timestamp '{HEADERS_UNTIL}'
        )
        """
    ),
    "headers_without_items": _with_tables(
        """
        select h.* from headers h
        where not exists (select 1 from details d where d.transaction_id = h.transaction_id)
        """
    ),
    "quantity_profile": _with_tables(
        """
        select quantity, count(*) as lines,
               cast(count(*) as double) / cast((select count(*) from details) as double) as share
        from details group by quantity
        """
    ),
    "basket_size_profile": _with_tables(
        """
        select items, count(*) as transactions from (
            select h.transaction_id, count(d.transaction_id) as items
            from headers h left join details d on d.transaction_id = h.transaction_id
            group by h.transaction_id
        ) group by items
        """
    ),
    "domain_violations": _with_tables(
        """
        select 'quantity_range' as rule, count(*) as violations from details
            where quantity is null or quantity < 1 or quantity > 5
        union all select 'sku_format', count(*) from details
            where sku is null or not regexp_full_match(sku, 'SKU[0-9]{5,}')
        union all select 'detail_transaction_format', count(*) from details
            where transaction_id is null or not regexp_full_match(transaction_id, 'TX[0-9]{7,}')
        union all select 'store_format', count(*) from headers
            where supermarket_id is null or not regexp_full_match(supermarket_id, 'STORE[0-9]{4,}')
        union all select 'header_transaction_format', count(*) from headers
            where transaction_id is null or not regexp_full_match(transaction_id, 'TX[0-9]{7,}')
        union all select 'basket_size', count(*) from (
            select count(d.transaction_id) as items
            from headers h left join details d on d.transaction_id = h.transaction_id
            group by h.transaction_id
        ) where items < 1 or items > 20
        """
    ),
    "open_hours_filter": _with_tables(f"select * from headers where {OPEN}"),
    "out_of_hours_audit": _with_tables(
        f"select supermarket_id, count(*) as transactions from headers where not {OPEN} group by supermarket_id"
    ),
    "assign_ids": """
        select o_orderdate, o_orderkey,
               format('TX{:07d}', row_number() over (order by o_orderdate, o_orderkey)) as transaction_id
        from orders
    """,
    "format_keys": """
        select o_orderkey, format('TX{:07d}', o_orderkey) as transaction_id,
               format('STORE{:04d}', o_orderkey) as supermarket_id,
               format('SKU{:05d}', o_orderkey) as sku,
               format('TX{:07d}', o_orderkey * 1000) as wide_transaction_id
        from orders
    """,
    "local_time": """
        select event_id, (ts at time zone 'UTC') at time zone 'Europe/Madrid' as store_time from events
    """,
    "union_origins": _with_tables(
        f"""
        select *, case when transaction_date < timestamp '{ORIGIN_SPLIT}' then 'historical' else 'realtime' end as origin
        from ({_SENT})
        """
    ),
    "sql_three_way": _with_tables(
        """
        select s.supermarket_name, k.article_name, cast(sum(d.quantity) as bigint) as units,
               cast(sum(d.quantity * k.price) as double) as sales
        from details d
        join headers h on h.transaction_id = d.transaction_id
        join skus k on k.sku = d.sku
        join supermarkets s on s.supermarket_id = h.supermarket_id
        group by s.supermarket_name, k.article_name
        """
    ),
    "readme_views": _with_tables(
        """
        select h.transaction_id, h.supermarket_id as store_id, s.supermarket_name as store_name,
               h.transaction_date as transaction_datetime, d.sku as sku_id, k.article_name as product_name,
               cast(k.price as double) as price, d.quantity
        from headers h
        join details d on d.transaction_id = h.transaction_id
        join skus k on k.sku = d.sku
        join supermarkets s on s.supermarket_id = h.supermarket_id
        """
    ),
}
