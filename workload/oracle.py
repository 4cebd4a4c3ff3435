"""The same queries as DuckDB SQL over the given tables, written independently of the jobs."""

from __future__ import annotations

from workload import feed

RAW = feed.RAW_REQUESTS.format(
    created_ms="epoch_ms(o_orderdate)",
    shipped_ms="epoch_ms(l_shipdate)",
    orders="orders",
    lineitem="lineitem",
    customer="customer",
    nation="nation",
)

DIRTY = """select * replace (
  case when OBJECTID%97=0 then null else OBJECTID end as OBJECTID,
  case when OBJECTID%89=0 then null else Case_Created_Date end as Case_Created_Date) from raw0"""

# The feed's columns, the ones that are trimmed, and the limits, stated here a second time: a wrong
# list in the engine must not be right on both sides.
FEED = {
    "OBJECTID": "bigint",
    "Case_Summary": "string",
    "Case_Status": "string",
    "Case_Source": "string",
    "Case_Created_Date": "bigint",
    "Case_Created_dttm": "string",
    "Case_Closed_Date": "bigint",
    "Case_Closed_dttm": "string",
    "First_Call_Resolution": "string",
    "Customer_Zip_Code": "string",
    "Incident_Address_1": "string",
    "Incident_Address_2": "string",
    "Incident_Intersection_1": "string",
    "Incident_Intersection_2": "string",
    "Incident_Zip_Code": "string",
    "Longitude": "double",
    "Latitude": "double",
    "Agency": "string",
    "Division": "string",
    "Major_Area": "string",
    "Type": "string",
    "Topic": "string",
    "Council_District": "int",
    "Police_District": "int",
    "Neighborhood": "string",
}
TRIMMED_NAMES = (
    "Case_Summary Case_Status Case_Source Incident_Address_1 Incident_Address_2 Agency Division Major_Area "
    "Type Topic Neighborhood"
).split()
PREVIEW_ROWS, TOP_NEIGHBORHOODS, MAP_POINTS = 200, 15, 5000

RAW_NAMES = list(FEED)
TRIMMED = ", ".join(f"nullif(trim({c}),'') as {c}" for c in TRIMMED_NAMES)
TIDY = f"select * replace ({TRIMMED}) from latest"
DERIVED = """select *,
  Case_Created_Date as created_ms,
  Case_Closed_Date as closed_ms,
  Case_Closed_Date is not null as is_closed,
  (Case_Closed_Date//1000 - Case_Created_Date//1000)/3600.0e0 as resolution_hours,
  regexp_matches(Case_Source,'(?i)^email') or regexp_matches(Case_Summary,'(?i)end user digest') as is_likely_internal,
  coalesce(Latitude between 39.5e0 and 40.0e0 and Longitude between -105.2e0 and -104.6e0, false) as has_valid_coordinates
  from tidy"""
VALID = "select * from clean where not coalesce(closed_ms < created_ms, false)"

# What a landed copy is ordered by: creation, (one landing directory), closing, all the rest.
LANDED_ORDER = ", ".join(
    f"{c} desc nulls last"
    for c in ["Case_Created_Date", "Case_Closed_Date"]
    + [c for c in RAW_NAMES if c not in ("OBJECTID", "Case_Created_Date", "Case_Closed_Date")]
)


def newest(source: str, order: str = feed.DELIVERY_ORDER) -> str:
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by OBJECTID order by {order}) as rn "
        f"from {source}) where rn=1"
    )


def ctes(raw: str = RAW, where: str = "true", order: str = feed.DELIVERY_ORDER, latest: str | None = None) -> str:
    """Raw rows to valid cases as a WITH clause."""
    return (
        f"with raw0 as ({raw}), raw as (select * from raw0 where {where}), "
        f"latest as ({latest or newest('raw', order)}), tidy as ({TIDY}), clean as ({DERIVED}), "
        f"valid as ({VALID})"
    )


BASE = ctes()
DIRTY_LATEST = f"{newest('(select * from raw where OBJECTID is not null)')} union all select * from raw where OBJECTID is null"
DIRTY_BASE = (
    f"with raw0 as ({RAW}), raw as ({DIRTY}), latest as ({DIRTY_LATEST}), tidy as ({TIDY}), clean as ({DERIVED})"
)
EXTRA = ", ".join(feed.EXTRA_COLUMNS)

CASE_COLUMNS = ", ".join(
    [*RAW_NAMES, "created_ms", "closed_ms", "is_closed", "resolution_hours", "is_likely_internal", "has_valid_coordinates"]
)


def report(rows: str, base: str) -> str:
    """The gate's rows over the relation ``rows``."""
    count = f"(select count(*) from {rows})"

    def hard(name: str, value: str, message: str) -> str:
        return (
            f"select '{name}' as check_name, 'hard' as severity, cast(v as double) as value, 0.0e0 as threshold, "
            f"v > 0 as failed, case when v > 0 then {message} end as message from (select {value} as v from {rows})"
        )

    return f"""{base}
select 'row_count' as check_name, 'info' as severity, cast({count} as double) as value,
  cast(null as double) as threshold, false as failed, cast(null as varchar) as message
union all {hard("key_not_null", "count(*) filter (OBJECTID is null)", "v || ' rows have a null OBJECTID'")}
union all {hard("key_unique",
    "count(*) - count(distinct OBJECTID) - max(case when OBJECTID is null then 1 else 0 end)",
    "'OBJECTID is not unique: ' || v || ' surplus rows'")}
union all {hard("created_at_not_null", "count(*) filter (created_ms is null)", "v || ' rows have a null created_at'")}
union all {hard("closed_before_created", "count(*) filter (closed_ms < created_ms)", "v || ' rows have closed_at before created_at'")}
union all select 'internal_rate', 'warning', v, 0.4e0, v > 0.4e0,
  case when v > 0.4e0 then printf('%.0f%%', v*100) || ' of rows look internal, limit 40%' end
  from (select count(*) filter (is_likely_internal) / cast(count(*) as double) as v from {rows})
union all select 'coordinate_rate', 'warning', v, 0.9e0, v < 0.9e0,
  case when v < 0.9e0 then 'only ' || printf('%.0f%%', v*100) || ' of located rows are inside the area' end
  from (select count(*) filter (has_valid_coordinates and Latitude is not null)
        / cast(count(*) filter (Latitude is not null) as double) as v from {rows})"""


def surrogate(natural: list[str], base: str = "0") -> str:
    """Dense keys in the order of the natural key's digest."""
    joined = " || chr(1) || ".join(natural)
    return f"cast({base} + row_number() over (order by md5({joined}), {', '.join(natural)}) as integer)"


SERVICE_TYPES = "select distinct Type as type_name, Topic as topic_name from {0} where Type is not null and Topic is not null"
NEIGHBORHOODS = (
    "select Neighborhood as neighborhood_name, arg_min(Council_District, (created_ms, OBJECTID)) as council_district, "
    "arg_min(Police_District, (created_ms, OBJECTID)) as police_district from {0} where Neighborhood is not null group by 1"
)
DATES = """select distinct cast(strftime(d,'%Y%m%d') as integer) as date_key, cast(d as varchar) as full_date,
  cast(year(d) as integer) as year, cast(month(d) as integer) as month, cast(day(d) as integer) as day,
  cast(dayofweek(d) as integer) as day_of_week, dayofweek(d) in (0,6) as is_weekend
  from (select cast(make_timestamp(created_ms*1000) as date) as d from {0})"""

# Two deliveries, each deduplicated and checked on its own.
TWO = f"""with raw0 as ({RAW}),
first_latest as ({newest(f"(select * from raw0 where ingest_year <= {feed.SPLIT_YEAR})")}),
second_latest as ({newest(f"(select * from raw0 where ingest_year >= {feed.SPLIT_YEAR})")}),
first_clean as ({DERIVED.replace("from tidy", f"from ({TIDY.replace('from latest', 'from first_latest')})")}),
second_clean as ({DERIVED.replace("from tidy", f"from ({TIDY.replace('from latest', 'from second_latest')})")}),
one as ({VALID.replace("from clean", "from first_clean")}),
two as ({VALID.replace("from clean", "from second_clean")})"""

# Landed deliveries carry the feed's columns only, so ties are broken by those.
TWO_LANDED = TWO.replace(feed.DELIVERY_ORDER, LANDED_ORDER)


# Both deliveries landed before the first load; of equal creation times the later one is newer.
BOTH = f"""with raw0 as ({RAW}),
raw as (select *, 1 as delivery from raw0 where ingest_year <= {feed.SPLIT_YEAR}
  union all select *, 2 from raw0 where ingest_year >= {feed.SPLIT_YEAR}),
latest as ({newest("raw", LANDED_ORDER.replace("Case_Created_Date desc nulls last", "Case_Created_Date desc nulls last, delivery desc", 1))}),
tidy as ({TIDY}), clean as ({DERIVED}), valid as ({VALID})"""
THEN_BOTH = (
    TWO_LANDED.split("second_latest as")[0].rstrip().rstrip(",")
    + f""",
first_clean as ({DERIVED.replace("from tidy", f"from ({TIDY.replace('from latest', 'from first_latest')})")}),
one as ({VALID.replace("from clean", "from first_clean")}),
{BOTH[BOTH.index("raw as (select *, 1") :]},
two as (select * from valid)"""
)


def two_loads(members: str, key: str, natural: list[str], columns: str) -> str:
    """A dimension after both loads: first members keep their keys, later ones go above."""
    first, second = members.format("one"), members.format("two")
    on = " and ".join(f"n.{c}=d.{c}" for c in natural)
    later = ", ".join(f"n.{c}" for c in columns.split(", "))
    return f"""{TWO},
d1 as (select {surrogate(natural)} as {key}, {columns} from ({first})),
d2 as (select {surrogate(natural, f"(select max({key}) from d1)")} as {key}, {columns} from
  (select {later} from ({second}) n where not exists (select 1 from d1 d where {on})))
select * from d1 union all select * from d2"""


def fact_rows(source: str, loaded_ms: int) -> str:
    return f"""select OBJECTID as object_id, Agency as agency_name,
  case when Type is not null and Topic is not null then Type end as type_name,
  case when Type is not null and Topic is not null then Topic end as topic_name,
  Neighborhood as neighborhood_name,
  cast(strftime(make_timestamp(created_ms*1000),'%Y%m%d') as integer) as created_date_key,
  created_ms, closed_ms, Case_Status as case_status, Case_Source as case_source, is_closed,
  cast(cast(resolution_hours as decimal(10,2)) as double) as resolution_hours,
  coalesce(is_likely_internal,false) as is_likely_internal, has_valid_coordinates,
  Latitude as latitude, Longitude as longitude, Incident_Address_1 as incident_address,
  cast({loaded_ms} as bigint) as loaded_ms from {source}"""


FIRST_MS, SECOND_MS = 1704067200000, 1704153600000
FACT_NAMES = [
    "object_id", "agency_name", "type_name", "topic_name", "neighborhood_name", "created_date_key", "created_ms",
    "closed_ms", "case_status", "case_source", "is_closed", "resolution_hours", "is_likely_internal",
    "has_valid_coordinates", "latitude", "longitude", "incident_address", "loaded_ms",
]
REPLACED = {"case_status", "closed_ms", "is_closed", "resolution_hours", "loaded_ms"}


def upsert(base: str) -> str:
    picked = []
    for column in FACT_NAMES[1:]:
        winner, other = ("n", "o") if column in REPLACED else ("o", "n")
        picked.append(
            f"case when {winner}.object_id is not null then {winner}.{column} else {other}.{column} end as {column}"
        )
    return f"""{base}, o as ({fact_rows("one", FIRST_MS)}), n as ({fact_rows("two", SECOND_MS)})
select coalesce(o.object_id, n.object_id) as object_id, {", ".join(picked)}
from o full outer join n on o.object_id = n.object_id"""


STAR = f"{BASE}, fact as ({fact_rows('valid', FIRST_MS)}), public as (select * from fact where not is_likely_internal)"
HOURS = "select resolution_hours as h from public where is_closed and resolution_hours is not null"
AVERAGE = "cast(round(avg(cast(resolution_hours as decimal(10,2))),1) as double)"


def volume(name: str, closed: bool = True) -> str:
    closed_sum = "cast(sum(case when is_closed then 1 else 0 end) as bigint) as closed_requests, " if closed else ""
    return (
        f"select {name}, count(*) as total_requests, {closed_sum}{AVERAGE} as avg_resolution_hours "
        f"from public where {name} is not null group by {name}"
    )


def oracle() -> dict[str, str]:
    declared = ", ".join(f"({i},'{n}','{t}')" for i, (n, t) in enumerate(FEED.items()))
    filled = " ".join(f"when '{n}' then count({n})" for n in RAW_NAMES)
    landed = ctes(order=LANDED_ORDER)
    return {
        "agency_report_from_raw": f"""{BASE}
          select Agency as agency_name, count(*) as total_requests,
            cast(sum(case when is_closed then 1 else 0 end) as bigint) as closed_requests,
            {AVERAGE} as avg_resolution_hours
          from valid where not coalesce(is_likely_internal,false) and Agency is not null group by Agency""",
        "dedup_latest": f"{BASE} select * from latest",
        "dedup_dirty": f"{DIRTY_BASE} select OBJECTID, Case_Created_Date, {EXTRA} from latest",
        "dedup_null_as_key": f"with raw0 as ({RAW}), raw as ({DIRTY}) "
        f"select OBJECTID, Case_Created_Date, {EXTRA} from ({newest('raw')})",
        "clean_strings": f"with raw as ({RAW}) select OBJECTID, part_no, {TRIMMED}, First_Call_Resolution, "
        "Incident_Intersection_1 from raw",
        "epoch_to_ts": """select event_id, epoch_us(ts)//1000 as epoch_ms, epoch_us(ts)//1000000 as epoch_s,
            epoch_us(ts)//1000 as back_ms, (epoch_us(ts)//1000000 - 1704067200)/3600.0e0 as hours from events""",
        "derive_flags": f"{BASE} select OBJECTID, created_ms, closed_ms, is_closed, resolution_hours, "
        "is_likely_internal, has_valid_coordinates from clean",
        "clean_requests": f"{BASE} select {CASE_COLUMNS} from clean",
        "probable_copies_removed": f"""{BASE}
          select OBJECTID, created_ms, Incident_Address_1, Type from (
            select *, row_number() over (partition by created_ms, Incident_Address_1, Type order by OBJECTID desc) as rn
            from valid) where rn=1 or created_ms is null or Incident_Address_1 is null or Type is null""",
        "transform_summary": f"""{BASE}
          select (select count(*) from raw) as raw_rows, count(*) as clean_rows,
            (select count(*) from raw) - count(*) as duplicates_removed,
            count(*) filter (is_likely_internal) as internal_flagged,
            count(*) filter (not has_valid_coordinates and Latitude is not null) as invalid_coordinates from clean""",
        "duplicate_count": f"""with raw0 as ({RAW}), raw as ({DIRTY}),
          c as (select count(*) as n_rows, (select count(*) from (select distinct OBJECTID from raw)) as n_keys from raw)
          select n_rows, n_keys, n_rows - n_keys as n_surplus from c""",
        "preview_latest": f"""{BASE}
          select OBJECTID, created_ms, closed_ms, is_closed, resolution_hours, Case_Status, Case_Source, Agency, Type,
            Topic, Neighborhood, Incident_Address_1, is_likely_internal, has_valid_coordinates
          from valid order by created_ms desc nulls last, OBJECTID limit {PREVIEW_ROWS}""",
        "quality_report": report("clean", BASE),
        "quality_report_dirty": report("clean", DIRTY_BASE),
        "quality_report_repeated_keys": report("clean", ctes(latest="select * from raw")),
        "quarantine_counts": f"""{DIRTY_BASE}
          select problem, n_rows from (
            select 'key_not_null' as problem, count(*) as n_rows from clean where OBJECTID is null
            union all select 'created_at_not_null', count(*) from clean where created_ms is null
            union all select 'closed_before_created', count(*) from clean where closed_ms < created_ms) where n_rows > 0""",
        "contract_profile": f"""with raw as ({RAW}), d(i, name, declared_type) as (values {declared})
          select name, declared_type, declared_type as actual_type, true as matches, filled,
            (select count(*) from raw) as total
          from d join (select n as name, case n {filled} end as filled from raw,
            (select unnest([{", ".join(f"'{n}'" for n in RAW_NAMES)}]) as n) group by n) using (name)""",
        "contract_diff": """select * from (values
          ('Council_District','retyped','int','bigint'), ('Police_District','retyped','int','bigint'))
          t(name, change, declared_type, actual_type)""",
        "schema_describe": f"""select cast(row_number() over (order by name) as integer) as position, name,
            case declared_type when 'int' then 'bigint' else declared_type end as type, true as nullable
          from (values {declared}) t(i, name, declared_type)""",
        "freshness": f"""{BASE} select max(created_ms) as newest_ms,
          (epoch_ms(timestamp '2002-01-01')//1000 - max(created_ms)//1000)/3600.0e0 as age_hours from valid""",
        "dim_agency": f"""{BASE} select {surrogate(["agency_name"])} as agency_key, agency_name
          from (select distinct Agency as agency_name from valid where Agency is not null)""",
        "dim_service_type": f"""{BASE} select {surrogate(["type_name", "topic_name"])} as service_type_key,
          type_name, topic_name from ({SERVICE_TYPES.format("valid")})""",
        "dim_neighborhood": f"""{BASE} select {surrogate(["neighborhood_name"])} as neighborhood_key, *
          from ({NEIGHBORHOODS.format("valid")})""",
        "dim_neighborhood_lazy": f"""{BASE} select {surrogate(["neighborhood_name"])} as neighborhood_key, *
          from ({NEIGHBORHOODS.format("valid")})""",
        "dim_date": f"{BASE} {DATES.format('valid')}",
        "dim_service_type_after_two": two_loads(
            SERVICE_TYPES, "service_type_key", ["type_name", "topic_name"], "type_name, topic_name"
        ),
        "dim_neighborhood_after_two": two_loads(
            NEIGHBORHOODS, "neighborhood_key", ["neighborhood_name"],
            "neighborhood_name, council_district, police_district",
        ),
        "dim_date_after_two": f"{TWO} {DATES.format('(select created_ms from one union all select created_ms from two)')}",
        "fact_load": f"{BASE} {fact_rows('valid', FIRST_MS)}",
        "fact_upsert": upsert(TWO),
        "fact_reload": f"{BASE} {fact_rows('valid', FIRST_MS)}",
        "end_to_end_runs": upsert(TWO_LANDED),
        "load_counts": f"""{BASE} select count(Agency) as dim_agency_upserted,
          count(*) filter (Type is not null or Topic is not null) as dim_service_type_upserted,
          count(Neighborhood) as dim_neighborhood_upserted, count(created_ms) as dim_date_upserted,
          count(*) as facts_upserted from valid""",
        "load_report": f"""{TWO}
          select 'dim_agency' as table_name, (select count(Agency) from two) as attempted,
            (select count(*) from (select distinct Agency from two where Agency is not null
              and Agency not in (select Agency from one where Agency is not null))) as inserted
          union all select 'dim_service_type', (select count(*) from two where Type is not null or Topic is not null),
            (select count(*) from ({SERVICE_TYPES.format("two")} except {SERVICE_TYPES.format("one")}))
          union all select 'dim_neighborhood', (select count(Neighborhood) from two),
            (select count(*) from (select Neighborhood from two where Neighborhood is not null
              except select Neighborhood from one))
          union all select 'dim_date', (select count(created_ms) from two),
            (select count(*) from (select created_ms//86400000 from two except select created_ms//86400000 from one))
          union all select 'fact_service_request', (select count(*) from two),
            (select count(*) from (select OBJECTID from two except select OBJECTID from one))""",
        "headline_figures": f"""{STAR}, h as ({HOURS})
          select format('{{:,}}', (select count(*) from public)) as total_requests,
            (select count(distinct agency_name) from public) as agencies,
            printf('%.0f%%', 100*coalesce(count(*) filter (h=0)/cast(nullif(count(*),0) as double), 0.0e0)) as same_call_share,
            coalesce(printf('%.1f hrs', (select median(h) from h where h>0)), 'N/A') as median_time from h""",
        "total_requests": f"{STAR} select count(*) as total_requests from public",
        "agencies_represented": f"{STAR} select count(distinct agency_name) as agencies from public",
        "requests_by_agency": f"{STAR} {volume('agency_name')}",
        "requests_by_day": f"""{STAR} select cast(cast(make_timestamp(created_ms*1000) as date) as varchar) as full_date,
          count(*) as request_count from public group by 1""",
        "requests_by_neighborhood": f"""{STAR} {volume("neighborhood_name", closed=False)}
          order by total_requests desc, neighborhood_name limit {TOP_NEIGHBORHOODS}""",
        "resolution_population": f"{STAR} select h as resolution_hours from ({HOURS})",
        "resolution_stats": f"""{STAR} select count(*) as closed_rows, count(*) filter (h=0) as zero_hour_rows,
          coalesce(count(*) filter (h=0)/cast(nullif(count(*),0) as double), 0.0e0) as zero_hour_rate,
          (select median(h) from ({HOURS}) where h>0) as median_hours from ({HOURS})""",
        "resolution_histogram": f"""{STAR}, p as (select h from ({HOURS}) where h>0),
          e as (select min(h) as lo, max(h) as hi, (max(h)-min(h))/20.0e0 as w from p),
          b as (select cast(case when hi=lo then 10 else greatest(1,least(20,ceil((h-lo)/w))) end as integer) as bin,
            count(*) as n from p, e group by 1)
          select cast(g.bin as integer) as bin, lo+(g.bin-1)*w as bin_low,
            case when g.bin=20 then hi else lo+g.bin*w end as bin_high, coalesce(n,0) as request_count
          from e, (select unnest(generate_series(1,20)) as bin) g left join b on b.bin=g.bin""",
        "map_points": f"""{STAR} select latitude as lat, longitude as lon, case_status, incident_address from public
          where has_valid_coordinates order by object_id limit {MAP_POINTS}""",
        "slowest_agencies": f"""{STAR} select agency_name, closed_requests, avg_resolution_hours
          from ({volume("agency_name")})""",
        "slowest_neighborhoods": f"""{STAR} select neighborhood_name, closed_requests, avg_resolution_hours
          from ({volume("neighborhood_name")})""",
        "resolution_by_year": f"""{STAR}, y as (
            select cast(year(make_timestamp(created_ms*1000)) as integer) as year, count(*) as total_requests,
              cast(sum(cast(resolution_hours as decimal(20,2))) as double)/count(resolution_hours) as a
            from public group by 1)
          select year, total_requests, round(a,1) as avg_resolution_hours,
            round(a - lag(a) over (order by year),1) as change_hours from y""",
        "incremental_extract": "select o_orderkey, epoch_ms(o_orderdate) as created_ms from orders "
        "where o_orderdate > timestamp '1998-06-01'",
        "incremental_extract_events": "select event_id, event_type, value from events "
        "where ts > timestamp '2024-01-15 12:30:15'",
        "cold_start_extract": "select event_id from events where ts > timestamp '2024-01-11'",
        "full_refresh_extract": "select o_orderkey, o_orderstatus from orders",
        "changed_extract": f"""with raw as ({RAW}) select OBJECTID, part_no, Case_Created_Date, Case_Closed_Date from raw
          where Case_Created_Date > epoch_ms(timestamp '1998-06-01') or Case_Closed_Date > epoch_ms(timestamp '1998-06-01')""",
        "slice_marks": "select event_type as slice, max(epoch_us(ts)//1000) as mark_ms, count(*) as n_rows from events group by 1",
        "past_slice_marks": """with m as (select event_type, max(epoch_us(ts)//1000) as mark from events
            where ts <= timestamp '2024-01-15 12:30:15' group by 1)
          select event_id from events left join m using (event_type) where mark is null or epoch_us(ts)//1000 > mark""",
        "reconcile_run": """with a as (select count(*) as n, max(o_orderdate) as m from orders
            where o_orderdate <= timestamp '1998-06-01'),
          b as (select count(*) as n, max(o_orderdate) as m from orders where o_orderdate > (select m from a)),
          t as (select strftime(a.m,'%Y-%m-%dT%H:%M:%S+00:00') as first_mark,
            strftime(coalesce(b.m, a.m),'%Y-%m-%dT%H:%M:%S+00:00') as last_mark, a.n as n1, b.n as n2 from a, b)
          select 'run-1' as run_id, n1 as expected_record_count, n1 as actual_record_count,
            cast(null as varchar) as watermark_before, first_mark as watermark_after, 'ok' as status from t
          union all select 'run-2', n2, n2, first_mark, last_mark, 'ok' from t""",
        "dry_run": """select count(*) as expected_record_count, count(*) as actual_record_count,
            cast(0 as bigint) as file_count, strftime(date_trunc('milliseconds', max(ts)), '%Y-%m-%dT%H:%M:%S.%f+00:00') as watermark_after, 'ok' as status
          from events where ts > timestamp '2024-01-11'""",
        "landing_roundtrip": f"""with raw as ({RAW}) select {", ".join(RAW_NAMES)}, '2024' as ingest_year,
          '01' as ingest_month, '01' as ingest_day, 'run-1' as run_id from raw""",
        "landing_inventory": f"with raw as ({RAW}) select true as files_match, true as bytes_match, count(*) as lines from raw",
        "complete_runs_only": f"""with raw as ({RAW}) select {", ".join(RAW_NAMES)}, 'run-1' as run_id from raw
          where ingest_year <= {feed.SPLIT_YEAR}""",
        "transform_run": f"""{landed} select (select count(*) from raw) as raw_rows, count(*) as clean_rows,
            (select count(*) from raw) - (select count(*) from clean) as duplicates_removed,
            (select count(*) from clean) - count(*) as quarantined_rows,
            count(*) filter (is_likely_internal) as internal_flagged,
            count(*) filter (not has_valid_coordinates and Latitude is not null) as invalid_coordinates,
            cast(case when count(*) filter (is_likely_internal) > 0.4e0*count(*) then 1 else 0 end
              + case when count(*) filter (has_valid_coordinates and Latitude is not null)
                < 0.9e0*count(Latitude) then 1 else 0 end as bigint) as quality_warnings from valid""",
        "published_requests": f"{landed} select {CASE_COLUMNS} from valid",
        "quarantined_requests": f"""{landed} select OBJECTID, 'closed_before_created' as problems from clean
          where closed_ms < created_ms""",
        "stream_upsert": f"select * exclude (loaded_ms) from ({upsert(TWO_LANDED)})",
        "stream_quarantine": f"""{TWO_LANDED} select OBJECTID, 'closed_before_created' as problems, 1 as delivery
          from first_clean where closed_ms < created_ms
          union all select OBJECTID, 'closed_before_created', 2 from second_clean where closed_ms < created_ms""",
        "parked_run": f"select *, 'run-1' as parked from ({upsert(TWO)})",
        "recovered_runs": f"{BOTH} {fact_rows('valid', SECOND_MS)}",
        "stream_restart": f"select * exclude (loaded_ms) from ({upsert(THEN_BOTH)})",
        "empty_run": f"""{TWO_LANDED} select cast(2 as bigint) as n_runs,
          (select count(*) from raw0 where ingest_year <= {feed.SPLIT_YEAR}) as n_landed,
          (select count(*) from one) as n_cases, cast(1 as bigint) as n_versions""",
        "preview_file": f"""{BASE} select OBJECTID, Case_Status, Agency, Type, Topic, Neighborhood,
            cast(is_closed as varchar) as is_closed
          from valid order by created_ms desc nulls last, OBJECTID limit 200""",
        "landed_key_ranges": f"""with raw as ({RAW}) select count(*) as n_rows, cast(0 as bigint) as n_overlaps
          from raw where ingest_year <= {feed.SPLIT_YEAR}""",
        "quality_report_missing_columns": f"""{BASE}
          select 'row_count' as check_name, 'info' as severity, cast((select count(*) from clean) as double) as value,
            cast(null as double) as threshold, false as failed, cast(null as varchar) as message
          union all select 'required_columns', 'hard', 2.0e0, 0.0e0, true,
            'Missing required columns: Latitude, closed_at'""",
        "damaged_lines_report": f"""{ctes(where="OBJECTID % 50 <> 0", order=LANDED_ORDER)},
          n as (select (select count(*) from clean) as good, (select count(*) from raw0 where OBJECTID % 50 = 0) as cut,
            (select count(*) from clean where closed_ms < created_ms) as early)
          select 'row_count' as check_name, 'info' as severity, cast(good + cut as double) as value,
            cast(null as double) as threshold, false as failed from n
          union all select 'corrupt_share', 'hard', round(cut/cast(good + cut as double), 9), 0.05e0,
            cut/cast(good + cut as double) > 0.05e0 from n
          union all select 'quarantine_share', 'hard', round((cut + early)/cast(good + cut as double), 9), 0.1e0,
            (cut + early)/cast(good + cut as double) > 0.1e0 from n""",
        "contract_profile_delivery": f"""with raw as ({RAW}), d(i, name, declared_type) as (values {declared})
          select name, declared_type, case name when 'Division' then null when 'Police_District' then 'string'
              else declared_type end as actual_type,
            name not in ('Division', 'Police_District') as matches,
            case name when 'Division' then 0 else filled end as filled, (select count(*) from raw) as total
          from d join (select n as name, case n {filled} end as filled from raw,
            (select unnest([{", ".join(f"'{n}'" for n in RAW_NAMES)}]) as n) group by n) using (name)""",
        "contract_diff_delivery": f"""with raw as ({RAW})
          select 'Division' as name, 'missing' as change, 'string' as declared_type, cast(null as varchar) as actual_type,
            cast(null as bigint) as filled
          union all select 'Ward', 'added', null, 'string', (select count(Major_Area) from raw)
          union all select 'Police_District', 'retyped', 'int', 'string', (select count(Police_District) from raw)""",
        "map_points_all": f"""{STAR} select latitude as lat, longitude as lon, case_status, incident_address from public
          where has_valid_coordinates""",
        "key_discontinuity": f"""with raw as ({RAW}), r as (select ingest_year, ingest_month, min(OBJECTID) as min_key,
            max(OBJECTID) as max_key, count(*) as n_rows from raw group by all),
          l as (select *, lag(min_key) over w as pmin, lag(max_key) over w as pmax from r
            window w as (order by ingest_year, ingest_month))
          select ingest_year, ingest_month, min_key, max_key, n_rows, coalesce(max_key < pmin, false) as restarted,
            greatest(0, min_key - pmax - 1) as gap from l""",
        "volume_anomalies": """with d as (select cast(strftime(ts,'%Y%m%d') as integer) as date_key, count(*) as n_rows
            from events group by 1),
          s as (select *, avg(n_rows) over w as m, stddev_samp(n_rows) over w as sd from d
            window w as (order by date_key rows between 7 preceding and 1 preceding)),
          z as (select *, (n_rows - m)/nullif(sd,0) as score0 from s)
          select date_key, n_rows, round(m,6) as expected_rows, round(score0,6) as score,
            coalesce(abs(score0) > 1.5, false) as unusual from z""",
        "date_attributes": """select event_id, cast(strftime(ts,'%Y%m%d') as integer) as date_key,
            cast(cast(ts as date) as varchar) as full_date, cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
            cast(day(ts) as integer) as day, cast(dayofweek(ts) as integer) as day_of_week,
            dayofweek(ts) in (0,6) as is_weekend from events""",
        "utc_texts": """select event_id, strftime(ts,'%Y') as ingest_year, strftime(ts,'%m') as ingest_month,
            strftime(ts,'%d') as ingest_day, strftime(ts,'%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as iso,
            strftime(ts,'%Y-%m-%d %H:%M:%S') as seconds from events""",
        "guarded_numbers": """with v as (select *, case when event_id%7=0 then cast('nan' as double) else -value end as x,
            substr(props,7,2) as piece from events)
          select event_id,
            case when event_id%5=0 or isnan(x) then null else cast(trunc(x) as integer) end as whole,
            case when isnan(x) then null else x end as real,
            try_cast(piece as integer) as whole_from_text, try_cast(piece as double) as real_from_text,
            cast(cast(case when isnan(x) then null else x end as decimal(10,2)) as double) as hours,
            coalesce(event_id%3 > 0 and value > 10, false) as flag from v""",
        "size_texts": """with s as (select doc_id, n_chars * cast(pow(32, doc_id%7) as bigint) as b from documents)
          select doc_id, case when b < 1024 then printf('%.1fB', cast(b as double))
            when b < 1024::bigint*1024 then printf('%.1fKB', b/1024.0e0)
            when b < 1024::bigint*1024*1024 then printf('%.1fMB', b/1048576.0e0)
            when b < 1024::bigint*1024*1024*1024 then printf('%.1fGB', b/1073741824.0e0)
            else printf('%.1fTB', b/1099511627776.0e0) end as size from s""",
        "share_texts": """select user_id, printf('%.0f%%', 100*(count(*) filter (value > 10)/cast(count(*) as double))) as share
          from events group by 1""",
    }
