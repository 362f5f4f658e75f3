"""The same results as SQL for DuckDB, written from typed columns and without the engine.

Rounding is done on integers: hours are ``(seconds * 100 + 1800) // 3600`` hundredths, and
means and medians are rounded half up from hundredths.
"""

from __future__ import annotations

ZONE = "America/Chicago"


def epoch(ts: str) -> str:
    """Seconds since 1970 of local time; the earlier one where clocks are set back."""
    return (
        f"cast(floor(least(epoch(({ts}) at time zone '{ZONE}'),"
        f" epoch((({ts}) - interval 1 hour) at time zone '{ZONE}') + 3600)) as bigint)"
    )


def hours(seconds: str) -> str:
    return f"case when {seconds} >= 0 then (({seconds}) * 100 + 1800) // 3600 / 100.0::double end"


CREATED = "o_orderdate + to_seconds(floor(o_totalprice)::bigint % 86400)"
CLOSED = "l_shipdate + to_seconds(floor(l_extendedprice)::bigint % 86400)"
LATITUDE = "cast(cast(l_discount as decimal(4,2)) * 6 + 41.55 as double)"
LONGITUDE = "cast(cast(l_tax as decimal(4,2)) * 6.25 - 88 as double)"
NEWEST = "l_extendedprice desc, l_partkey desc, l_suppkey desc"
LAST = "desc nulls last"

TYPED = f"""
typed as (
    select
        l_orderkey || '-' || l_linenumber as sr_number,
        case o_orderpriority when '4-NOT SPECIFIED' then 'INFORMATION ONLY CALL'
            when '5-LOW' then 'Aircraft Noise Complaint' else o_orderpriority end as sr_type,
        left(o_orderpriority, 1) as sr_short_code,
        c_mktsegment as owner_department,
        case when l_linestatus = 'F' then 'Completed' else 'Open' end as status,
        l_returnflag as origin,
        case when not (o_orderstatus = 'P' and c_mktsegment = 'MACHINERY') then {CREATED} end as created_ts,
        case when l_linestatus = 'F' and not (l_returnflag = 'R' and l_discount = 0.05)
            then {CLOSED} end as closed_ts,
        l_shipdate as last_modified_ts,
        case when l_tax > 0 then c_nationkey + 1 end::integer as community_area,
        case when l_tax > 0 then l_linenumber end::integer as ward,
        case when l_tax > 0 then l_suppkey::varchar end as zip_code,
        case when l_tax > 0 then {LATITUDE} end as latitude,
        case when l_tax > 0 then {LONGITUDE} end as longitude,
        l_returnflag = 'R' as city_flagged_duplicate,
        o_orderdate < timestamp '1996-01-01' as legacy_record,
        l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
)"""

OUTCOME = f"""
timed as (
    select *, {epoch('closed_ts')} - {epoch('created_ts')} as seconds from latest
),
silver as (
    select
        sr_number, sr_type, sr_short_code, owner_department, status, origin,
        created_ts, closed_ts, last_modified_ts,
        {hours('seconds')} as resolution_hours,
        closed_ts is not null as is_closed,
        coalesce(seconds >= 0, false) as has_valid_resolution,
        community_area, ward, zip_code, latitude, longitude,
        coalesce(latitude >= 41.6 and latitude <= 42.1
            and longitude >= -87.95 and longitude <= -87.5, false) as has_valid_geo,
        city_flagged_duplicate, legacy_record,
        strftime(created_ts, '%Y-%m-%d') as created_date_only,
        year(created_ts)::integer as created_year,
        month(created_ts)::integer as created_month,
        coalesce(sr_type not ilike '%information only%' and sr_type not ilike '%aircraft noise%', true)
            as is_real_service_request
    from timed
)"""


def newest(rank: str) -> str:
    return f"""
latest as (
    select * from typed
    qualify row_number() over (partition by l_orderkey, l_linenumber order by {rank}) = 1
)"""


SILVER = f"with {TYPED}, {newest(f'last_modified_ts desc, {NEWEST}')}, {OUTCOME}"

# The engine's own tie order: every typed column, greatest first.
ALL_COLUMNS = ", ".join(
    f"{c} {LAST}"
    for c in (
        "last_modified_ts",
        "created_ts",
        "closed_ts",
        "community_area",
        "ward",
        "zip_code",
        "latitude",
        "longitude",
        "sr_type",
        "sr_short_code",
        "owner_department",
        "status",
        "origin",
        "city_flagged_duplicate",
        "legacy_record",
    )
)
SILVER_ALL_TIES = f"with {TYPED}, {newest(ALL_COLUMNS)}, {OUTCOME}"

SILVER_COLUMNS = "* exclude (is_real_service_request)"

CENSUS = """
people as (
    select c_nationkey,
        sum(round(c_acctbal * 100)::bigint)::bigint as cents,
        count(*) filter (where c_acctbal < 0) as in_debt,
        count(*) as people
    from customer group by c_nationkey
),
census as (
    select
        (c_nationkey + 1)::integer as community_area,
        n_name as community_area_name,
        null::double as pct_housing_crowded,
        ((in_debt * 2000 + people) // (people * 2)) / 10.0::double as pct_below_poverty,
        n_regionkey + 0.5::double as pct_unemployed,
        null::double as pct_no_hs_diploma,
        people::double as pct_under18_over64,
        ((cents * 2 + people * 100) // (people * 200))::integer as per_capita_income,
        n_regionkey::integer as hardship_index
    from people left join nation on c_nationkey = n_nationkey
)"""

AREAS = f"""{CENSUS},
areas as (
    select community_area, community_area_name, per_capita_income, hardship_index,
        pct_below_poverty, pct_unemployed,
        ntile(4) over (order by per_capita_income nulls last, community_area)::integer as income_quartile
    from census
)"""

COMPARED = f"""{AREAS},
base as (
    select sr_type, income_quartile, (resolution_hours * 100)::bigint as ticks
    from silver join areas using (community_area)
    where is_real_service_request and has_valid_resolution
)"""
BASE, BASE_ALL_TIES = f"{SILVER}, {COMPARED}", f"{SILVER_ALL_TIES}, {COMPARED}"

SUMMARY = """count(*) as request_count,
    ((2 * sum(ticks) + 10 * count(*)) // (20 * count(*)))::bigint / 10.0::double as avg_resolution_hours,
    ((2 * median(ticks))::bigint + 10) // 20 / 10.0::double as median_resolution_hours"""

BOTH_MARTS = f"""select sr_type, income_quartile, {SUMMARY} from base group by sr_type, income_quartile
    union all select null, income_quartile, {SUMMARY} from base group by income_quartile"""

EVENTS = "select event_id, ts, user_id, event_type, value, props from events"
LINES = "l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity, l_tax"
ONE_LINE = "partition by l_orderkey, l_linenumber order by l_shipdate desc"
EVENT_SECONDS = f"{epoch('noon')} - {epoch('ts')}"


def rule(
    kind: str,
    column: str,
    bad: str,
    source: str,
    severity: str = "error",
    mostly: float = 1.0,
    judged: str = "count(*)",
) -> str:
    return f"""select '{kind}' as rule, '{column}' as "column", count(*) as element_count,
        {bad} as unexpected_count,
        coalesce(({judged} - ({bad})) / nullif({judged}, 0)::double >= {mostly}, true) as success,
        '{severity}' as severity from {source}"""


def outside(column: str, low: float | None = None, high: float | None = None) -> str:
    tests = [f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)
    return f"count(*) filter (where {' or '.join(tests)})"


def between(column, source, low=None, high=None, **options):
    return rule(
        "between", column, outside(column, low, high), source, judged=f"count({column})", **options
    )


def unique(columns: str, source: str) -> str:
    groups = f"(select {columns}, count(*) as n from {source} group by {columns})"
    return f"""select 'unique' as rule, '{columns}' as "column", sum(n)::bigint as element_count,
        coalesce(sum(n) filter (where n > 1), 0)::bigint as unexpected_count,
        count(*) filter (where n > 1) = 0 as success, 'error' as severity from {groups}"""


def key_tests(model: str, column: str, source: str) -> str:
    groups = f"(select {column} as k, count(*) as n from {source} group by {column})"
    head = f"select '{model}' as model"
    tail = "'error' as severity, case when failures = 0 then 'pass' else 'fail' end as status"
    return f"""{head}, 'unique' as test, '{column}' as "column", failures, {tail}
        from (select count(*) filter (where k is not null and n > 1) as failures from {groups})
        union all {head}, 'not_null', '{column}', failures, {tail}
        from (select coalesce(sum(n) filter (where k is null), 0)::bigint as failures from {groups})"""


def relation(model, column, parent, field, severity="error", source=None, parent_source=None) -> str:
    bad = "warn" if severity == "warn" else "fail"
    return f"""select '{model}' as model, 'relationships' as test, '{column}' as "column", failures,
        '{severity}' as severity, case when failures = 0 then 'pass' else '{bad}' end as status
        from (select count(*) as failures from {source or model} c where c.{column} is not null
            and not exists (select 1 from {parent_source or parent} p where p.{field} = c.{column}))"""


def union(*parts: str) -> str:
    return "\nunion all\n".join(parts)


def rows(*records: tuple) -> str:
    return ", ".join(str(r) for r in records)


FLAGS = ("has_valid_resolution", "has_valid_geo", "is_closed")
LINE_VERDICT = "3::bigint + 1 as rules, (n_bad > 0)::bigint as failed, n_bad = 0 as passed"

# The declared target as a dry run lists it.
TARGET = (
    ("SR_NUMBER", "string"),
    ("SR_TYPE", "string"),
    ("SR_SHORT_CODE", "string"),
    ("OWNER_DEPARTMENT", "string"),
    ("STATUS", "string"),
    ("ORIGIN", "string"),
    ("CREATED_TS", "timestamp_ntz"),
    ("CLOSED_TS", "timestamp_ntz"),
    ("LAST_MODIFIED_TS", "timestamp_ntz"),
    ("RESOLUTION_HOURS", "double"),
    ("IS_CLOSED", "boolean"),
    ("HAS_VALID_RESOLUTION", "boolean"),
    ("COMMUNITY_AREA", "int"),
    ("WARD", "int"),
    ("ZIP_CODE", "string"),
    ("LATITUDE", "double"),
    ("LONGITUDE", "double"),
    ("HAS_VALID_GEO", "boolean"),
    ("CITY_FLAGGED_DUPLICATE", "boolean"),
    ("LEGACY_RECORD", "boolean"),
    ("CREATED_DATE_ONLY", "date"),
    ("CREATED_YEAR", "int"),
    ("CREATED_MONTH", "int"),
)

DATED_ORDERS = """select o_orderkey, o_totalprice,
    case when o_orderstatus <> 'P' then year(o_orderdate) end::integer as created_year,
    case when o_orderstatus <> 'P' then month(o_orderdate) end::integer as created_month
    from orders"""


def tests_of(source: str) -> str:
    """The tests of all models that are built from ``source``."""
    return f"{AREAS}, types as (select distinct sr_type from {source})" + union(
        key_tests("stg_requests", "sr_number", source),
        key_tests("stg_census", "community_area", "census"),
        key_tests(
            "dim_date", "date_day",
            f"(select distinct created_date_only as date_day from {source} where created_date_only is not null)",
        ),
        key_tests("dim_community_area", "community_area", "areas"),
        key_tests("dim_service_type", "sr_type", "types"),
        key_tests("fct_service_requests", "sr_number", source),
        relation(
            "fct_service_requests", "community_area", "dim_community_area", "community_area",
            "warn", source=source, parent_source="areas",
        ),
        relation(
            "fct_service_requests", "sr_type", "dim_service_type", "sr_type",
            source=source, parent_source="types",
        ),
    )


ORACLE: dict[str, str] = {
    "clean_requests": f"{SILVER} select {SILVER_COLUMNS} from silver",
    "build_silver": f"{SILVER_ALL_TIES} select {SILVER_COLUMNS} from silver",
    "silver_conform": f"{SILVER} select {SILVER_COLUMNS} from silver",
    "latest_version": f"select {LINES} from lineitem qualify row_number() over ({ONE_LINE}, {NEWEST}) = 1",
    "incremental_upsert": f"""select {LINES}, l_returnflag from lineitem
        qualify row_number() over ({ONE_LINE}, {NEWEST}, l_returnflag desc) = 1""",
    "merge_pulls": f"""with pulls as (
            select * replace (null::double as l_tax) from lineitem
                where l_shipdate is null or l_shipdate < timestamp '1999-01-01'
            union all select * from lineitem where l_shipdate >= timestamp '1998-01-01')
        select {LINES} from pulls
        qualify row_number() over ({ONE_LINE}, {NEWEST}, l_tax desc nulls last) = 1""",
    "parse_timestamps": """select event_id, case when event_type not in ('click', 'error')
        then date_trunc('milliseconds', ts)::timestamp end as parsed_ts from events""",
    "blank_to_null": """select p_partkey,
            case p_type when 'PROMO' then null when 'SMALL' then 'n/a' else trim(p_name) end as name,
            case when p_type not in ('PROMO', 'SMALL') then p_size end as size,
            case when p_type not in ('PROMO', 'SMALL') then p_retailprice end as price
        from part""",
    "resolution_hours": f"""with timed as (
            select event_id, ts, case when event_type <> 'signup'
                then date_trunc('day', ts)::timestamp + interval 12 hour end as noon from events),
        gaps as (select event_id, {EVENT_SECONDS} as seconds from timed)
        select event_id, {hours('seconds')} as resolution_hours from gaps""",
    "resolution_flags": f"""with timed as (
            select *, {CREATED} as created, case when l_linestatus = 'F' then {CLOSED} end as closed
            from lineitem join orders on l_orderkey = o_orderkey)
        select l_orderkey, l_linenumber, l_extendedprice, closed is not null as is_closed,
            coalesce({epoch('closed')} >= {epoch('created')}, false) as has_valid_resolution
        from timed""",
    "geo_flag": f"""with placed as (
            select l_orderkey, l_linenumber, l_extendedprice,
                case when l_tax > 0 then {LATITUDE} end as latitude,
                case when l_tax < 0.08 then {LONGITUDE} end as longitude from lineitem)
        select *, coalesce(latitude between 41.6 and 42.1 and longitude between -87.95 and -87.5, false)
            as has_valid_geo from placed""",
    "calendar_columns": f"""with placed as (select o_orderkey, {CREATED} as created_ts from orders)
        select o_orderkey, created_ts, strftime(created_ts, '%Y-%m-%d') as created_date_only,
            year(created_ts)::integer as created_year, month(created_ts)::integer as created_month
        from placed""",
    "real_request_flag": """select o_orderkey, nullif(lower(o_orderpriority), '1-urgent') as sr_type,
            o_orderpriority not in ('4-NOT SPECIFIED', '5-LOW') as is_real_service_request
        from orders""",
    "stg_requests": f"""{SILVER} select sr_number, sr_type, sr_short_code, owner_department, status,
            origin, created_ts, closed_ts, resolution_hours, is_closed, has_valid_resolution,
            community_area, ward, zip_code, latitude, longitude, has_valid_geo, created_date_only,
            is_real_service_request from silver""",
    "stg_dimension": f"with {CENSUS} select * from census",
    "fct_requests": f"""{SILVER} select sr_number, created_date_only as date_day, community_area,
            sr_type, status, origin, resolution_hours, is_closed, has_valid_resolution,
            is_real_service_request, has_valid_geo from silver""",
    "dim_area": f"with {AREAS} select * from areas",
    "dim_date": """with days as (
            select distinct o_orderdate::date as d from orders where o_orderstatus <> 'P')
        select strftime(d, '%Y-%m-%d') as date_day, year(d)::integer as year,
            month(d)::integer as month, day(d)::integer as day_of_month,
            dayofweek(d)::integer as day_of_week, strftime(d, '%b') as month_name,
            dayofweek(d) in (0, 6) as is_weekend from days""",
    "dim_service_type": """select nullif(p_type, 'PROMO') as sr_type, max(p_brand) as sr_short_code,
            max(p_name) as owner_department, bool_or(p_type <> 'SMALL') as is_real_service_request
        from part group by 1""",
    "equity_by_quartile": f"""{BASE} select income_quartile, {SUMMARY} from base
        group by income_quartile order by income_quartile""",
    "equity_by_type": f"""{BASE} select sr_type, income_quartile, {SUMMARY} from base
        where sr_type in (select sr_type from base group by sr_type having count(*) >= 1000)
        group by sr_type, income_quartile order by sr_type, income_quartile""",
    "high_volume_types": f"""{BASE} select sr_type, count(*) as request_count from base
        group by sr_type having count(*) >= 1000""",
    "high_volume_types_on_edge": f"""{BASE}, volumes as (
            select sr_type, count(*) as request_count from base group by sr_type)
        select * from volumes
        where request_count >= (select quantile_disc(request_count, 0.5) from volumes)""",
    "equity_by_type_on_edge": f"""{BASE}, volumes as (
            select sr_type, count(*) as n from base group by sr_type)
        select sr_type, income_quartile, {SUMMARY} from base
        where sr_type in (select sr_type from volumes
            where n >= (select quantile_disc(n, 0.5) from volumes))
        group by sr_type, income_quartile order by sr_type, income_quartile""",
    "build_marts": f"{BASE} {BOTH_MARTS}",
    "run_all": f"{BASE_ALL_TIES} {BOTH_MARTS}",
    "mart_views": f"""{BASE},
        by_type as (select sr_type, income_quartile, {SUMMARY} from base group by all),
        whole as (select income_quartile, {SUMMARY} from base group by all)
        select t.sr_type, t.income_quartile, t.request_count, s.request_count as of_quartile,
            (select count(*) from areas a where a.income_quartile = t.income_quartile) as areas,
            t.median_resolution_hours > s.median_resolution_hours as is_slower
        from by_type t join whole s using (income_quartile)""",
    "equity_gap": f"""{BASE}, medians as (
            select sr_type, count(*) as n,
                (2 * median(ticks) filter (where income_quartile = 1))::bigint as low,
                (2 * median(ticks) filter (where income_quartile = 4))::bigint as high
            from base group by sr_type)
        select sr_type, (low + 10) // 20 / 10.0::double as low_income_median,
            (high + 10) // 20 / 10.0::double as high_income_median,
            round((low - high) * 100 / nullif(high, 0)::double)::bigint as gap_pct
        from medians where n >= 1000""",
    "bronze_json_scan": EVENTS,
    "bronze_landing_roundtrip": EVENTS,
    "silver_partition_roundtrip": DATED_ORDERS,
    "silver_partition_scan": f"""select created_year, created_month, count(*) as row_count
        from ({DATED_ORDERS}) group by created_year, created_month""",
    "seed_csv_scan": """select c_custkey::varchar as c_custkey, c_name, c_nationkey::varchar as c_nationkey,
        nullif(c_mktsegment, 'BUILDING') as c_mktsegment from customer""",
    "window_extract": f"{EVENTS} where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-13'",
    "incremental_extract": f"{EVENTS} where ts >= timestamp '2024-01-17' and ts < timestamp '2024-01-21'",
    "ordered_page": f"{EVENTS} order by ts, event_id limit 100 offset 200",
    "page_after": f"{EVENTS} where (ts, event_id) > (timestamp '2024-01-15', 0) order by ts, event_id limit 100",
    "load_dry_run": f"""{SILVER} select position::integer as position, column_name, column_type,
            (select count(*) from silver) as row_count
        from (values {rows(*((i, *column) for i, column in enumerate(TARGET, 1)))})
            target(position, column_name, column_type)""",
    "warehouse_reload": f"""{SILVER} select sr_number, status, community_area, resolution_hours
        from silver""",
    "load_reconcile": f"""{SILVER}, sides as (
            select (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as source_rows,
                (select count(*) from silver) as target_rows)
        select *, source_rows = target_rows as matches from sides""",
    "reconcile_difference": """with sides as (
            select count(*) as source_rows, count(distinct (l_orderkey, l_linenumber)) as target_rows
            from lineitem)
        select *, source_rows = target_rows as matches from sides""",
    "row_counts": """select 'bronze' as stage, count(*) as row_count from lineitem
        union all select 'silver', count(*) from (select distinct l_orderkey, l_linenumber from lineitem)
        union all select 'orders', count(*) from orders""",
    "gate_report": SILVER
    + union(
        rule("not_null", "sr_number", "count(*) - count(sr_number)", "silver"),
        unique("sr_number", "silver"),
        rule("not_null", "status", "count(*) - count(status)", "silver"),
        between("resolution_hours", "silver", low=0),
        between("community_area", "silver", low=1, high=77),
        between("latitude", "silver", low=41.6, high=42.1),
        between("longitude", "silver", low=-87.95, high=-87.5),
        *[
            rule("in_set", flag, f"count(*) filter (where {flag} not in (true, false))", "silver")
            for flag in FLAGS
        ],
    ),
    "gate_verdict": f"""with latest as (select * from lineitem
            qualify row_number() over ({ONE_LINE}, {NEWEST}) = 1),
        repeated as (
            select 'versions' as dataset, l_orderkey, l_linenumber, count(*) as n from lineitem group by all
            union all
            select 'latest', l_orderkey, l_linenumber, count(*) from latest group by all),
        counts as (select dataset, count(*) filter (where n > 1) as n_bad from repeated group by dataset)
        select dataset, {LINE_VERDICT} from counts""",
    "expect_unique": union(
        unique("l_orderkey,l_linenumber", "lineitem"),
        unique("l_orderkey", "lineitem"),
        unique("c_custkey", "customer"),
    ),
    "expect_mostly": union(
        between("l_discount", "lineitem", low=0.02, mostly=0.75),
        between("l_discount", "lineitem", high=0.08, mostly=0.95),
        between("l_tax", "lineitem", low=0.01, high=0.06, mostly=0.5),
        between("l_quantity", "lineitem", low=1),
    ),
    "expect_in_set": union(
        rule(
            "in_set",
            "l_returnflag",
            "count(*) filter (where l_returnflag not in ('A', 'N', 'R'))",
            "lineitem",
        ),
        rule(
            "in_set",
            "l_linestatus",
            "count(*) filter (where l_linestatus not in ('F'))",
            "lineitem",
            severity="warn",
        ),
    ),
    "model_tests": f"{SILVER}, {tests_of('silver')}",
    "model_tests_failing": f"""with {TYPED}, latest as (select * from typed), {OUTCOME},
        broken as (select * replace (case when sr_number not like '%-7' then sr_number end as sr_number,
            nullif(sr_type, '1-URGENT') as sr_type) from silver), {tests_of('broken')}""",
    "test_relationships": union(
        relation("orders", "o_custkey", "customer", "c_custkey"),
        relation("documents", "doc_id", "labels", "doc_id", "warn"),
        relation("labels", "doc_id", "documents", "doc_id"),
    ),
    "landing_survives_a_failure": EVENTS,
    "landing_resumed": f"{EVENTS} where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01'",
    "field_census": """with pulls as (
            select o_orderpriority as pull, count(*) as records from orders group by o_orderpriority)
        select pull, 'o_orderstatus' as field, 'absent' as finding, null::varchar as kind, 'STRING' as expected, records
        from pulls where pull = '2-HIGH'
        union all select pull, 'total', 'renamed', 'STRING', 'o_totalprice', records from pulls where pull = '3-MEDIUM'
        union all select pull, 'o_orderkey', 'retyped', 'BIGINT', 'STRING', records from pulls where pull = '5-LOW'
        union all select pull, 'o_custkey', 'additional', 'BIGINT', null, records from pulls where pull = '5-LOW'
        union all select pull, 'total', 'absent', null, 'STRING', records from pulls where pull = '5-LOW'""",
    "failed_build_keeps_models": f"{BASE} {BOTH_MARTS}",
    "upsert_publish_delta": f"{SILVER_ALL_TIES} select {SILVER_COLUMNS} from silver",
    "marts_by_difference": f"{BASE_ALL_TIES} {BOTH_MARTS}",
    "reconcile_rows": f"""{SILVER}, changes as (
            select sr_number, right(sr_number, 1) as line,
                (right(sr_number, 1) = '7' and is_closed) or (sr_type = '2-HIGH' and right(sr_number, 1) = '5'
                    and origin is not null) as is_changed
            from silver)
        select sr_number, 'changed' as change, 1::bigint as source_rows, 1::bigint as target_rows
        from changes where is_changed and line <> '6'
        union all select sr_number, 'missing', 1, 0 from changes where line = '6'
        union all select sr_number || 'b', 'additional', 0, 1 from changes where line = '6'""",
    "reconcile_partitions": f"""{SILVER}, dated as (
            select year(created_ts)::integer as created_year, month(created_ts)::integer as created_month, count(*) as n
            from typed group by all), kept as (
            select created_year, created_month, count(*) as n from silver group by all)
        select d.created_year, d.created_month, d.n as source_rows, coalesce(k.n, 0)::bigint as target_rows
        from dated d left join kept k on d.created_year is not distinct from k.created_year
            and d.created_month is not distinct from k.created_month
        where d.n <> coalesce(k.n, 0)""",
    "unexpected_values": """with wrong as (
            select 'between' as rule, 'l_discount' as column, l_discount::varchar as value, count(*) as n
            from lineitem where l_discount < 0.02 or l_discount > 0.08 group by l_discount
            union all select 'in_set', 'l_returnflag', l_returnflag, count(*)
            from lineitem where l_returnflag <> 'N' group by l_returnflag
            union all select 'unique', 'l_orderkey', l_orderkey::varchar, count(*)
            from lineitem where l_orderkey is not null group by l_orderkey having count(*) > 1)
        select rule, "column", position::integer as position, value, n from (
            select *, row_number() over (partition by rule, "column" order by n desc, value) as position from wrong)
        where position <= 4""",
}
