"""SQL with the same answer as each query, in a second engine's dialect."""

from __future__ import annotations

from forecourt import adapter, spec

_STATES = ", ".join(f"'{code}'" for code in spec.STATES)
_PICK_FROM = ", ".join(f"'{code}'" for code in [*spec.STATES, *adapter.OUTSIDE_STATES])
_PICKS = len(spec.STATES) + len(adapter.OUTSIDE_STATES)

# Listing-shaped view, then each stage of the chain as one more common table.
_LISTINGS = f"""
raw as (
  select l_orderkey || '-' || l_linenumber as id,
    case when l_suppkey % 37 = 0 then null
         when l_suppkey % 41 = 0 then 'unknown'
         else ' ' || upper(p_brand) || ' ' end as manufacturer,
    p_name || ' ' as model,
    cast(year(l_shipdate) as integer) as year,
    o_totalprice as price,
    l_quantity * 15000 as odometer,
    lower(list_extract([{_PICK_FROM}], o_custkey % {_PICKS} + 1)) || ' ' as state,
    l_returnflag as condition,
    l_shipdate as ingested_at,
    l_partkey, l_suppkey, l_extendedprice
  from lineitem
  join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey),
typed as (
  select id, manufacturer, lower(trim(manufacturer)) as make, lower(trim(model)) as model, year,
    price, cast(trunc(odometer) as integer) as odometer, upper(trim(state)) as state, condition,
    ingested_at, l_partkey, l_suppkey, l_extendedprice
  from raw)"""



def _half_up(number: str, digits: int) -> str:
    """Round as Spark does: half up on the decimal digits the double is written with."""
    return f"cast(round(cast(cast({number} as varchar) as decimal(38, 18)), {digits}) as double)"


_IN_BOUNDS = "price between 500 and 200000 and year between 1990 and 2024"


def _chain(source: str = "typed", order: str | None = None) -> str:
    order = order or "ingested_at desc, l_partkey, l_suppkey, l_extendedprice"
    return f"""{_LISTINGS},
one as (
  select * from {source} qualify row_number() over (partition by id order by {order}) = 1),
silver as (
  select * from one
  where {_IN_BOUNDS} and odometer between 0 and 500000 and make is not null and make <> ''),
valid as (
  select id, make, model, year, price, odometer as mileage, state, condition, ingested_at
  from silver
  where make not in ('', 'unknown') and length(state) = 2 and state in ({_STATES}))"""


_VALID = _chain()

_BY_MAKE = """
  select make, count(*) as listing_count,
    round(median(price), 0) as median_price, round(avg(price), 0) as avg_price,
    round(stddev_samp(price), 0) as price_stddev,
    round(min(price), 0) as min_price, round(max(price), 0) as max_price
  from valid group by make having count(*) >= 50"""

_BY_STATE = """
  select state, count(*) as listing_count,
    round(median(price), 0) as median_price, round(avg(price), 0) as avg_price
  from valid group by state"""

_BY_YEAR = """
  select make, year, count(*) as listing_count, round(median(price), 0) as median_price
  from valid
  where make in (select make from by_make order by listing_count desc, make limit 10)
  group by make, year"""

_SUMMARY = """
  select count(*) as total_listings, count(distinct make) as unique_makes,
    count(distinct state) as states_covered, round(median(price), 0) as overall_median_price,
    round(avg(price), 0) as overall_avg_price,
    min(year) as oldest_year, max(year) as newest_year
  from valid"""

# Rows pushed over the domain limits, coerced, with the first broken rule.
_JUDGED = f"""
pushed as (
  select l_orderkey || '-' || l_linenumber as id,
    ' Supplier ' || l_suppkey as manufacturer, 'Part ' || l_partkey as model,
    cast(year(l_shipdate) as integer) as year,
    case l_linenumber when 7 then -o_totalprice when 6 then o_totalprice * 1.25
         else o_totalprice end as price,
    case l_linenumber when 5 then l_quantity * -15000 else l_quantity * 25000 end as odometer,
    'CA' as state, l_returnflag as condition
  from lineitem join orders on l_orderkey = o_orderkey),
judged as (
  select id, lower(trim(manufacturer)) as make, lower(trim(model)) as model, year,
    {_half_up('price', 2)} as price, cast(trunc(odometer) as integer) as mileage, state, condition,
    case when price <= 0 then 'price_not_positive'
         when price > 500000 then 'price_too_high'
         when odometer < 0 then 'mileage_negative'
         when odometer > 1000000 then 'mileage_too_high' end as error
  from pushed)"""


def _json_member(name: str, text: bool = True) -> str:
    shown = f"""'"' || {name} || '"'""" if text else f"cast({name} as varchar)"
    return f"""'"{name}":' || coalesce({shown}, 'null')"""


_RECORD = " || ',' || ".join(
    _json_member(name, name not in ("year", "price", "mileage")) for name in spec.WIRE.fieldNames()
)

# What the producer lets through: padded state as it came, make and model normalised.
_SENT = f"""{_LISTINGS},
sent as (
  select raw.id, lower(trim(manufacturer)) as make, lower(trim(model)) as model, year,
    {_half_up('price', 2)} as price, cast(trunc(odometer) as integer) as mileage, state, condition
  from raw
  where price > 0 and price <= 500000 and odometer between 0 and 1000000)"""

# Arrival times tie in one micro-batch, so the record itself decides which copy stays.
_STREAM_SILVER = f"""{_SENT},
normal as (
  select id, make, model, year, price, mileage, upper(trim(state)) as state, condition
  from sent),
one as (
  select * from normal qualify row_number() over (partition by id order by
    make nulls first, model, year, price, mileage, state, condition) = 1),
silver as (
  select * from one
  where {_IN_BOUNDS} and mileage between 0 and 500000 and make is not null and make <> '')"""

_SPLIT = f"""{_LISTINGS},
ranked as (
  select *, ingested_at >= timestamp '1999-01-01' as fresh,
    row_number() over (
      partition by id, ingested_at >= timestamp '1999-01-01'
      order by ingested_at desc, l_partkey, l_suppkey, l_extendedprice) as nth
  from typed),
merged as (
  select * from ranked r where nth = 1 and (fresh or not exists (
    select 1 from ranked s where s.nth = 1 and s.fresh and s.id = r.id)))"""

_UPSERTED = f"""with {_SPLIT}
  select id, make, model, year, price, odometer, state, ingested_at from merged"""

# Two halves of the listings, each cleaned, made unique and filtered by itself.
_TWO_DAYS = f"""{_LISTINGS},
day as (select *, ingested_at >= timestamp '1999-01-01' as fresh from typed),
one as (
  select * from day qualify row_number() over (
    partition by id, fresh order by ingested_at desc, l_partkey, l_suppkey, l_extendedprice) = 1),
filtered as (
  select * from one
  where {_IN_BOUNDS} and odometer between 0 and 500000 and make is not null and make <> ''),
silver as (
  select * from filtered r
  where fresh or not exists (select 1 from filtered s where s.fresh and s.id = r.id)),
valid as (
  select id, make, model, year, price, odometer as mileage, state, condition, ingested_at
  from silver
  where make not in ('', 'unknown') and length(state) = 2 and state in ({_STATES}))"""

# The same through messages: what was sent on a day, ties decided by the record.
_STREAM_DAYS = f"""{_LISTINGS},
sent as (
  select raw.id, lower(trim(manufacturer)) as make, lower(trim(model)) as model, year,
    {_half_up('price', 2)} as price, cast(trunc(odometer) as integer) as mileage,
    upper(trim(state)) as state, condition, ingested_at >= timestamp '1999-01-01' as fresh
  from raw
  where price > 0 and price <= 500000 and odometer between 0 and 1000000),
one as (
  select * from sent qualify row_number() over (partition by id, fresh order by
    make nulls first, model, year, price, mileage, state, condition) = 1),
filtered as (
  select * from one
  where {_IN_BOUNDS} and mileage between 0 and 500000 and make is not null and make <> '')"""

# Unquoted commas give a cell too many, line breaks two lines with too few.
_LINES = f"""{_LISTINGS},
cells as (
  select *, split_part(id, '-', 2) as line, cast(trunc(price) as bigint) as whole_price,
    cast(trunc(odometer) as bigint) as whole_odometer
  from raw),
head as (
  select *, id || ',' || coalesce(manufacturer, '') || ',' as first_cells,
    ',' || year || ',' || whole_price || ',' || whole_odometer || ',' || state || ','
      || condition as last_cells
  from cells)"""

_UNFILTERED = f"""with {_JUDGED},
staged as (
  select id, case when odometer > 0 then lower(trim(manufacturer)) end as make,
    case when condition <> 'R' then price end as price
  from pushed)"""

_CSV_TIES = "manufacturer nulls first, model, year, price, odometer, state, condition, make"

ORACLES: dict[str, str] = {
    "clean_listings": f"""with {_LISTINGS}
      select id, make, model, year, price, odometer as mileage, state, condition, ingested_at
      from typed where price is not null and year is not null and manufacturer is not null""",
    "log_price": f"""with {_LISTINGS}
      select id, price, round(ln(1 + price), 6) as log_price from typed""",
    "clean_strings": """
      select p_partkey,
        lower(trim(regexp_replace(p_name, '[^a-zA-Z0-9 ]', '', 'g'))) as name,
        lower(trim(regexp_replace(p_brand, '[^a-zA-Z0-9 ]', '', 'g'))) as brand
      from part""",
    "record_fields": f"""with {_LISTINGS}
      select id, case when odometer <> 0 then {_half_up('price / odometer', 4)} end as price_per_mile,
        year between 1900 and 2025 as plausible_year,
        'USD ' || format('{{:,.2f}}', price) as price_label
      from typed where manufacturer is not null""",
    "dedup_latest": f"""with {_VALID}
      select id, make, model, year, price, odometer, state, l_partkey, l_suppkey, l_extendedprice
      from one""",
    "silver_listings": f"""with {_VALID}
      select id, make, model, year, price, odometer, state, condition, ingested_at,
        round(ln(1 + price), 6) as log_price
      from silver""",
    "gold_listings": f"with {_VALID} select * from valid",
    "domain_accept": f"""with {_JUDGED}
      select id, make, model, year, price, mileage, state, condition
      from judged where error is null""",
    "domain_quarantine": f"with {_JUDGED} select * from judged where error is not null",
    "produced_and_failed": f"""with {_JUDGED}
      select count(*) filter (error is null) as produced,
        count(*) filter (error is not null) as failed
      from judged""",
    "mart_price_by_make": f"with {_VALID} {_BY_MAKE} order by median_price desc, make",
    "mart_price_by_state": f"with {_VALID} {_BY_STATE} order by median_price desc, state",
    "mart_price_by_year": f"with {_VALID}, by_make as ({_BY_MAKE}) {_BY_YEAR} order by make, year",
    "mart_listings_summary": f"with {_VALID} {_SUMMARY}",
    "kpi_tiles": f"""with {_VALID}, summary as ({_SUMMARY})
      select total_listings, unique_makes, states_covered, overall_median_price from summary""",
    "top_makes": f"""with {_VALID}, by_make as ({_BY_MAKE})
      select make, median_price, listing_count from by_make
      order by median_price desc, make limit 20""",
    "depreciation_curve": f"""with {_VALID}, by_make as ({_BY_MAKE}), by_year as ({_BY_YEAR})
      select make, year, median_price from by_year order by make, year""",
    "state_map": f"""with {_VALID}, by_state as ({_BY_STATE})
      select state, median_price from by_state order by median_price desc, state""",
    "upsert_listings": _UPSERTED,
    "upsert_stored": _UPSERTED,
    "upsert_reopened": _UPSERTED,
    "upsert_touched": f"""with {_SPLIT}
      select id, make, model, year, price, odometer, state, ingested_at, 1 as folders_rewritten
      from merged""",
    "marts_after_upsert": f"""with {_TWO_DAYS}, by_make as ({_BY_MAKE})
      select 'make' as mart, * from by_make
      union all by name select 'state' as mart, * from ({_BY_STATE})
      union all by name select 'year' as mart, * from ({_BY_YEAR})
      union all by name select 'summary' as mart, * from ({_SUMMARY})""",
    "quality_failures": f"""{_UNFILTERED}
      select 'unique_id' as check_name, * from staged
      where id in (select id from staged group by id having count(*) > 1)
      union all select 'not_null_id', * from staged where id is null
      union all select 'not_null_price', * from staged where price is null
      union all select 'not_null_make', * from staged where make is null
      union all select 'price_positive', * from staged where price <= 0""",
    "median_of_doubles": """
      select l_returnflag, count(*) as n, round(median(l_extendedprice / l_quantity / 3), 6) as median
      from lineitem group by l_returnflag""",
    "coverage_sketch": f"""with {_LISTINGS}
      select count(distinct make) as make, count(distinct state) as state, true as ids_near
      from typed""",
    "message_keys": f"""with {_JUDGED}
      select id as key, '{{' || {_RECORD} || '}}' as value from judged where error is null""",
    "stream_restart": "select event_id, user_id, event_type, value from events",
    "stream_silver_incremental": f"""with {_STREAM_DAYS}
      select id, make, model, year, price, mileage, state, condition from filtered r
      where fresh or not exists (select 1 from filtered s where s.fresh and s.id = r.id)""",
    "csv_malformed": f"""with {_LINES}
      select id, lower(trim(manufacturer)) as make, lower(trim(model)) as model, year,
        cast(whole_price as double) as price, cast(whole_odometer as integer) as mileage, state,
        condition, cast(null as varchar) as error, cast(null as varchar) as line
      from head where line not in ('5', '6')
      union all
      select null, null, null, null, null, null, null, null, 'row_malformed', unnest(
        case line when '5' then [first_cells || 'a, b ' || model || last_cells]
          else [first_cells || 'a', model || last_cells] end)
      from head where line in ('5', '6')""",
    "silver_clustered": f"""with {_VALID}
      select id, make, model, year, price, mileage, state, condition from valid where state = 'CA'""",
    "ingest_stamps": """
      select count(*) as stamped, 1 as instants, true as after_start, true as before_end
      from lineitem""",
    "resumed_job": f"with {_chain(order=_CSV_TIES)} {_BY_MAKE}",
    "stg_view": f"""with {_chain(order=_CSV_TIES)}
      select id, make, model, year, price, odometer as mileage, state, condition from silver""",
    "quality_checks": f"""with {_VALID},
      staged as (select * from silver where manufacturer is not null)
      select 'unique_id' as check_name, count(*) as failures
      from (select id from staged where id is not null group by id having count(*) > 1)
      union all select 'not_null_id', count(*) from staged where id is null
      union all select 'not_null_price', count(*) from staged where price is null
      union all select 'not_null_make', count(*) from staged where make is null
      union all select 'price_positive', count(*) from valid where price <= 0""",
    "quality_checks_raw": f"""with {_JUDGED},
      staged as (
        select id, case when odometer > 0 then manufacturer end as make,
          case when condition <> 'R' then price end as price
        from pushed)
      select 'unique_id' as check_name, count(*) as failures
      from (select id from staged where id is not null group by id having count(*) > 1)
      union all select 'not_null_id', count(*) from staged where id is null
      union all select 'not_null_price', count(*) from staged where price is null
      union all select 'not_null_make', count(*) from staged where make is null
      union all select 'price_positive', count(*) from staged where price <= 0""",
    "wire_encode": f"""with {_JUDGED}
      select case when error is null then '{spec.TOPIC}' else '{spec.REJECTED_TOPIC}' end as topic,
        id as key,
        '{{' || {_RECORD} || case when error is null then '' else ',"error":"' || error || '"' end
          || '}}' as value
      from judged""",
    "json_parse": """
      select event_id, cast(json_extract(props, '$.k') as integer) as k from events""",
    "stream_to_bronze": "select event_id, user_id, event_type, value from events",
    "stream_listings": f"with {_SENT} select * from sent",
    "stream_silver": f"with {_STREAM_SILVER} select * from silver",
    "csv_roundtrip": f"""with {_LISTINGS}
      select id, manufacturer, model, year, price, cast(trunc(odometer) as integer) as odometer,
        state, condition
      from raw""",
    "csv_quoted": """
      select cast(p_partkey as bigint) as id,
        '"' || p_name || '", ' || p_brand || chr(10) || p_name as text, p_brand as brand
      from part""",
    "stage_counts": f"""with {_chain(order=_CSV_TIES)}
      select (select count(*) from raw) as bronze, (select count(*) from silver) as silver""",
    "bronze_append": """
      select o_orderkey as id, o_totalprice as price, null::varchar as condition from orders
      union all select c_custkey, c_acctbal, c_mktsegment from customer""",
    "batch_job": f"with {_chain(order=_CSV_TIES)} {_BY_MAKE}",
    "stream_job": f"""with {_STREAM_SILVER},
      valid as (select * from silver where make <> 'unknown' and state in ({_STATES}))
      {_BY_MAKE}""",
}
