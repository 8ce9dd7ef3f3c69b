"""Oracle SQL, one text per query.

The rules are written a second time here, in another shape where there is one: patterns sit in a
table instead of a CASE, fact rows are joined one by one instead of by counts, membership is an IN
list instead of a join. Shared with the pipelines are only the sample data; names and sources are in contract.py.
"""

from __future__ import annotations

from haulbook.sources.sample import AS_OF, CSV_ARRAYS, SAMPLE, branch_expressions
from oracle_checks import contract

DAY = f"date '{AS_OF}'"
RECENT = f"created_at >= {DAY} - 30"
SCORED = "delivery_type not in ('route', 'cms')"
ACCURACY = """violation_type_code in ('did_not_follow_delivery_instructions', 'wrong_vehicle',
    'confirmed_wrong_vehicle', 'wrong_accessories', 'did_not_deliver_all_items')"""
FAILURE = """violation_type_code in ('self_unassignment', 'scheduled_delivery_failure',
    'did_not_complete_multistop_delivery')"""

# The array behind each list column.
LIST_SOURCES = {
    "driver_accessory_names": "Driver_Accessories__c",
    "driver_capability_names": "Driver_Capabilities__c",
    "active_violation_types": "Active_Violation_Types__c",
    "lifetime_violation_types": "Lifetime_Violation_types__c",
    "driver_vehicle_accessory_names": "Vehicle_Accessories__c",
    "preferred_delivery_methods": "Preferred_Delivery_Methods__c",
    "upscale_delivery_methods": "Upscale_Delivery_Methods__c",
}
# State names in test order, with postal codes.
STATE_TABLE = [
    ("Alabama", "AL"),
    ("Alaska", "AK"),
    ("Arizona", "AZ"),
    ("Arkansas", "AR"),
    ("California", "CA"),
    ("Colorado", "CO"),
    ("Connecticut", "CT"),
    ("Delaware", "DE"),
    ("District Of Columbia", "DC"),
    ("Florida", "FL"),
    ("Georgia", "GA"),
    ("Hawaii", "HI"),
    ("Idaho", "ID"),
    ("Illinois", "IL"),
    ("Indiana", "IN"),
    ("Iowa", "IA"),
    ("Kansas", "KS"),
    ("Kentucky", "KY"),
    ("Louisiana", "LA"),
    ("Maine", "ME"),
    ("Maryland", "MD"),
    ("Massachusetts", "MA"),
    ("Michigan", "MI"),
    ("Minnesota", "MN"),
    ("Mississippi", "MS"),
    ("Missouri", "MO"),
    ("Montana", "MT"),
    ("Nebraska", "NE"),
    ("Nevada", "NV"),
    ("New Hampshire", "NH"),
    ("New Jersey", "NJ"),
    ("New Mexico", "NM"),
    ("New York", "NY"),
    ("North Carolina", "NC"),
    ("North Dakota", "ND"),
    ("Ohio", "OH"),
    ("Oklahoma", "OK"),
    ("Oregon", "OR"),
    ("Pennsylvania", "PA"),
    ("Rhode Island", "RI"),
    ("South Carolina", "SC"),
    ("South Dakota", "SD"),
    ("Tennessee", "TN"),
    ("Texas", "TX"),
    ("Utah", "UT"),
    ("Vermont", "VT"),
    ("Virginia", "VA"),
    ("Washington", "WA"),
    ("West Virginia", "WV"),
    ("Wisconsin", "WI"),
    ("Wyoming", "WY"),
]


def adapter(table: str) -> str:
    """CTE text of one sample table."""
    branches = []
    for base, where, key, given in SAMPLE[table]:
        expressions = branch_expressions(table, key, given)
        columns = [f"{sql} as {name}" for name, sql in expressions.items()]
        inner = f"select {', '.join(columns)} from {base}" + (f" where {where}" if where else "")
        arrays = [
            f"case when {csv} = '' then []::varchar[] else string_split({csv}, ';') end as {array}"
            for csv, array in CSV_ARRAYS.items()
            if csv in expressions
        ]
        branches.append(f"select {', '.join(['*', *arrays])} from ({inner})")
    return f"{table} as ({' union all by name '.join(branches)})"


def states_cte() -> str:
    rows = []
    for order, (name, code) in enumerate(STATE_TABLE):
        rows.append(f"({order}, '%{name.lower().replace(' ', '%')}%', '{code}')")
    return f"states(rank, pattern, code) as (values {', '.join(rows)})"


def query(tables: str, body: str, *ctes: str) -> str:
    """WITH clause of the needed sample tables and CTEs, then the body."""
    return f"with {', '.join([*map(adapter, tables.split()), *ctes])} {body}"


def state(x: str) -> str:
    return (
        f"coalesce((select arg_min(code, rank) from states where lower(trim({x})) like pattern), "
        f"(select max(code) from states where code = upper(trim({x}))))"
    )


def phone(x: str) -> str:
    """Take the ten digits out where there are exactly ten to take, instead of rewriting the text."""
    ten = "^(?:\\+1[\\s-]*)?(\\d{3})[\\s.-]*(\\d{3})[\\s.-]*(\\d{4})$"
    digits = " || ".join(f"regexp_extract({x}, '{ten}', {group})" for group in (1, 2, 3))
    eleven = f"regexp_extract({x}, '^(1\\d{{10}})[^\\n]*$', 1)"
    leading = f"regexp_extract({x}, '^(\\d{{10}})[^\\n]*$', 1)"
    link = f"regexp_replace({x}, 'tel://.+(\\+1)?(\\d{{10}})', '\\2', 'g')"
    return f"""if({x} ilike 'tel://%', '+1' || {link},
        if(regexp_matches({x}, '^tel|del', 'i') or {x} in ('', '--'), null,
            coalesce('+1' || nullif({digits}, ''), '+' || nullif({eleven}, ''), '+1' || nullif({leading}, ''), {x})))"""


def domains(x: str) -> str:
    text = f"regexp_replace(regexp_replace({x}, '^\\^', ''), '^\\(\\.\\*\\)\\(', '')"
    return f"trim(replace(replace(replace(replace({text}, ')$', ''), '\\', ''), '|', ', '), '@', ''))"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def rounded(x: str, places: int) -> str:
    """Round the shortest text of the double, which a decimal holds exactly."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 16)), {places}) as double)"


def percent(part: str, whole: str) -> str:
    n, d = f"cast({part} as bigint)", f"nullif(cast({whole} as bigint), 0)"
    return f"(((2 * {n} * 1000000 + {d}) // (2 * {d}) + 50) // 100) / 100.0"


def title(parent: str) -> str:
    return f"""left(case when account_name is null or account_name = ' ' then 'Unnamed: ' || company
        when {parent} is null or coalesce(account_type, '') = 'company' then account_name
        else company || ' | ' || account_name end, 255)"""


def record_type(parent: str) -> str:
    return f"if({parent} is not null and account_type is distinct from 'company', 'Team Account', 'Company')"


FORMATS = {
    "copy": "{0}",
    "text": "{0}::varchar",
    "cut40": "left({0}, 40)",
    "list": "array_to_string({0}, ';')",
    "or_false": "({0} is not distinct from true)",
    "or_zero": "coalesce({0}, 0)",
    "known": "({0} is not null)",
    "email": "lower(trim({0}))",
}
BUILDERS = {
    "iso": iso,
    "state": state,
    "phone": phone,
    "round2": lambda x: rounded(x, 2),
    "round3": lambda x: rounded(x, 3),
}


def layout_sql(layout: list[tuple[str, str, str]]) -> str:
    items = []
    for alias, source, form in layout:
        sql = BUILDERS[form](source) if form in BUILDERS else FORMATS[form].format(source)
        items.append(f'{sql} as "{alias}"')
    return ", ".join(items)


# --- pieces shared by several queries -----------------------------------------------------------

LIVE_PARENTS = """parents as (
    select child.id as child_id, parent.external_id as parent_external_id
    from accounts child join accounts parent on parent.id = child.parent_account_id
    where child.is_deleted is distinct from true and parent.is_deleted is distinct from true)"""


def active(key: str, *labels: str) -> str:
    tops = ", ".join(f"max({c}) as {c}" for c in labels)
    one = f"select {key}, {tops} from {{}} where {RECENT} and {SCORED} and {key} is not null group by {key}"
    return f"{one.format('deliveries')} union {one.format('violations')}"


def completions(key: str) -> str:
    return f"""completions as (
    select {key}, count(distinct driver_external_id) as driver_count, count(*) as completed_deliveries,
        count(*) - count(*) filter (where delivery_external_id in (
            select delivery_external_id from violations where {RECENT} and {SCORED} and {ACCURACY}
        )) as accurate_deliveries
    from deliveries where {RECENT} and {SCORED} and is_completed_delivery and {key} is not null group by {key})"""


def ratings(key: str) -> str:
    return f"""ratings as (
    select {key}, avg(customer_rating) as avg_customer_rating, count(customer_rating) as rated_deliveries
    from deliveries where is_completed_delivery and {SCORED} and {key} is not null group by {key})"""


def failures(key: str) -> str:
    return f"""failures as (
    select {key}, count(*) as completion_violation_count from violations
    where {RECENT} and {SCORED} and {FAILURE} and {key} is not null group by {key})"""


def eta(key: str) -> str:
    pickup = percent("count(*) filter (seconds_to_origin_delta between -1800 and 1620)", "count(*)")
    dropoff = percent("count(*) filter (seconds_to_destination_delta between -1800 and 720)", "count(*)")
    return f"""eta as (
    select d.{key}, count(*) as eta_delivery_count, {pickup} as pickup_ontime_pct, {dropoff} as dropoff_ontime_pct
    from deliveries d, etas e
    where d.delivery_id = e.delivery_id and d.{RECENT} and {SCORED} and is_completed_delivery and d.{key} is not null
    group by d.{key})"""


def scorecard(key: str) -> list[str]:
    """CTE ``card``: every scorecard column of every entity that has any metric."""
    done, failed = "coalesce(completed_deliveries, 0)", "coalesce(completion_violation_count, 0)"
    rating = "avg_customer_rating" if key.startswith("carrier") else "average_customer_rating"
    card = f"""card as (
    select {key}, coalesce(driver_count, 0) as scorecard_driver_count__c,
        {done} as scorecard_completed_deliveries__c,
        {failed} as scorecard_completion_violations__c,
        {percent(done, f"{done} + {failed}")} as scorecard_completion_rate__c,
        coalesce(accurate_deliveries, 0) as scorecard_accurate_deliveries__c,
        {percent("coalesce(accurate_deliveries, 0)", done)} as scorecard_delivery_accuracy__c,
        {rounded("avg_customer_rating", 2)} as scorecard_{rating}__c,
        coalesce(rated_deliveries, 0) as scorecard_rated_deliveries__c,
        eta_delivery_count as scorecard_eta_delivery_count__c,
        pickup_ontime_pct as scorecard_pickup_ontime_percent__c,
        dropoff_ontime_pct as scorecard_dropoff_ontime_percent__c
    from entities left join completions using ({key}) left join ratings using ({key})
        left join failures using ({key}) left join eta using ({key}))"""
    return [completions(key), ratings(key), failures(key), eta(key), card]


CARRIER_IDS = "entities as (select distinct external_id as carrier_external_id from carriers)"
DRIVER_IDS = "entities as (select distinct driver_external_id from drivers)"

ROUTE_HISTORY = f"""history as (
    select distinct d.driver_external_id, c.external_id as carrier_id, t.external_id as route_template_id,
        r.fulfilled_on, r.fulfilled_on >= {DAY} - 7 as active
    from routes r left join route_templates t on t.id = r.route_template_id
        left join route_drivers d on d.driver_id = r.driver_id
        left join carriers c on c.id = r.carrier_id)"""
ACTIVE_ROUTES = """active_routes as (
    select driver_external_id, route_template_id, active from history where active
    qualify row_number() over (partition by driver_external_id
        order by fulfilled_on desc nulls last, route_template_id asc nulls last) = 1)"""


def list_ctes() -> list[str]:
    """One CTE per list column over the rows whose arrays are all non-empty, and their join."""
    full = " and ".join(f"len({a}) > 0" for a in LIST_SOURCES)
    ctes = [f"full_rows as (select * from drivers where {full})"]
    for i, (array, name) in enumerate(LIST_SOURCES.items()):
        ctes.append(f"""list{i} as (
            select driver_external_id, coalesce(string_agg(distinct v, ';' order by v), '') as {name}
            from (select driver_external_id, unnest({array}) as v from full_rows) group by driver_external_id)""")
    joins = " ".join(f"join list{i} using (driver_external_id)" for i in range(1, len(LIST_SOURCES)))
    return [*ctes, f"lists as (select * from list0 {joins})"]


def unlisted(table: str) -> str:
    return f"email_address in (select email_address from {table}) is false"


# --- the queries --------------------------------------------------------------------------------


def oracle_queries() -> dict[str, str]:
    carrier, driver = "carrier_external_id", "driver_external_id"
    facts = "deliveries violations"
    flag = (
        "exists (select 1 from routes r join route_drivers using (driver_id) "
        "where route_drivers.driver_external_id = drivers.driver_external_id)"
    )
    equipped = """equipped as (
        select distinct driver_external_id
        from (select driver_external_id, unnest(driver_accessory_names) as v from drivers) where v ilike '%(PPE)%')"""
    verdict = """case when coalesce(list_contains(driver_tags, 'ppe-certified'), false) then 'Certified'
        when driver_external_id in (select driver_external_id from equipped) then 'Unverified' else 'None' end"""
    named_drivers = """coalesce(first_name, '') <> '' and coalesce(last_name, '') <> ''
        and phone_number not like '%del%'"""

    return {
        "rolling_lookback": query(
            "deliveries",
            f"select delivery_type, count(*) as rows_in_window from deliveries where {RECENT} group by delivery_type",
        ),
        "active_entities": query(facts, active(carrier, "carrier_name")),
        "active_drivers": query(facts, active(driver, "driver_name", carrier, "carrier_name")),
        "active_entities_fanout": query(
            f"carriers {facts}",
            """select external_id, count(*) as copies from carriers left join seen
            on seen.carrier_external_id = external_id group by external_id""",
            f"seen as ({active(carrier, 'carrier_name')})",
        ),
        "accurate_deliveries": query(
            facts,
            "select carrier_external_id, completed_deliveries, accurate_deliveries from completions",
            completions(carrier),
        ),
        "distinct_driver_count": query(
            facts, "select carrier_external_id, driver_count from completions", completions(carrier)
        ),
        "entity_ratings": query("deliveries", "from ratings", ratings(carrier)),
        "completion_violations": query("violations", "from failures", failures(carrier)),
        "eta_ontime": query("deliveries etas", "from eta", eta(carrier)),
        "scorecard_rates": query(
            facts,
            f"""select carrier_external_id,
                {percent("coalesce(completed_deliveries, 0)",
                         "coalesce(completed_deliveries, 0) + coalesce(completion_violation_count, 0)")}
                as completion_rate,
                {percent("coalesce(accurate_deliveries, 0)", "completed_deliveries")} as delivery_accuracy
            from completions full join failures using (carrier_external_id)""",
            completions(carrier),
            failures(carrier),
        ),
        "carrier_scorecard": query(
            f"{facts} etas carriers",
            "select carrier_external_id as external_id, * exclude (carrier_external_id) from card",
            CARRIER_IDS,
            *scorecard(carrier),
        ),
        "driver_scorecard": query(
            f"{facts} etas drivers",
            "select * exclude (scorecard_driver_count__c) from card",
            DRIVER_IDS,
            *scorecard(driver),
        ),
        "state_code": query(
            "account_profiles",
            f"select account_id, {state('location_state')} as state_code from account_profiles",
            states_cte(),
        ),
        "phone_normalize": query(
            "drivers", f"select driver_external_id, phone_number, {phone('phone_number')} as phone from drivers"
        ),
        "email_normalize": query(
            "drivers", "select driver_external_id, trim(lower(email_address)) as email from drivers"
        ),
        "domain_list": query("accounts", f"select id, {domains('account_regex')} as domain_list from accounts"),
        "account_name": query(
            "account_profiles accounts",
            f"""select account_id, {title('parent_external_id')} as name
            from account_profiles left join parents on child_id = account_id""",
            LIVE_PARENTS,
        ),
        "account_record_type": query(
            "account_profiles accounts",
            f"""select account_id, {record_type('parent_external_id')} as account_record_type
            from account_profiles left join parents on child_id = account_id""",
            LIVE_PARENTS,
        ),
        "iso_utc_timestamp": f"select event_id, {iso('ts')} as ts_iso from events",
        "round_measures": query(
            "account_profiles serviceability",
            f"""select account_id, {rounded('location_latitude', 3)} as latitude,
                {rounded('overall_score', 2)} as overall_score
            from account_profiles left join serviceability on zip_code = location_zip_code""",
        ),
        "array_to_string": query(
            "carriers", "select external_id, array_to_string(preferences, ';') as preferences from carriers"
        ),
        "non_blank_filter": query("carriers", "select external_id, name from carriers where name not in ('', ' ')"),
        "soft_delete_filter": query("accounts", "select id from accounts where is_deleted is distinct from true"),
        "exclusion_list": query(
            "drivers email_exclusions",
            f"select driver_external_id, email_address from drivers where {unlisted('email_exclusions')}",
        ),
        "dimension_enrich": query(
            "account_profiles serviceability churn_risk",
            """select account_id, location_zip_code as zip_code, overall_grade, priority_score from account_profiles
            left join serviceability s on s.zip_code = location_zip_code
            left join churn_risk c on c.account_external_id = account_profiles.account_external_id""",
        ),
        "parent_lookup": query(
            "account_profiles accounts",
            "select account_id, parent_external_id from account_profiles left join parents on child_id = account_id",
            LIVE_PARENTS,
        ),
        "composite_key_join": query(
            "carriers drivers",
            """select external_id, driver_external_id from carriers c left join drivers d
            on d.email_address = c.email_address and d.carrier_external_id = c.external_id
            and d.carrier_permissions = 'owner'""",
        ),
        "existence_flag": query(
            "drivers routes route_drivers", f"select driver_external_id, {flag} as is_route_driver from drivers"
        ),
        "route_templates": query(
            "routes route_templates route_drivers carriers", "select * from history", ROUTE_HISTORY
        ),
        "active_route_driver": query(
            "routes route_templates route_drivers carriers", "select * from active_routes", ROUTE_HISTORY, ACTIVE_ROUTES
        ),
        "latest_per_key": query(
            "drivers",
            """select driver_external_id, last_request_viewed, driver_accessory_csv from drivers
            qualify row_number() over (partition by driver_external_id order by last_request_viewed desc nulls last) = 1
            """,
        ),
        "array_list_columns": query("drivers", "select * from lists", *list_ctes()),
        "listagg_distinct": query(
            "deliveries",
            """select carrier_external_id,
                coalesce(string_agg(distinct delivery_type, ';' order by delivery_type), '') as delivery_types
            from deliveries group by carrier_external_id""",
        ),
        "tag_rows": query(
            "drivers",
            """select driver_external_id, v as accessory_name
            from (select driver_external_id, unnest(driver_accessory_names) as v from drivers)
            where lower(v) like '%(ppe)%'""",
        ),
        "ppe_certification": query(
            "drivers", f"select driver_external_id, {verdict} as ppe_certification from drivers", equipped
        ),
        "distinct_rows": query(
            "deliveries", "select carrier_external_id, delivery_type from deliveries group by all"
        ),
        "accounts_model": query(
            "account_profiles accounts serviceability churn_risk",
            f"select distinct {layout_sql(contract.ACCOUNTS)} from joined",
            LIVE_PARENTS,
            states_cte(),
            f"""joined as (
                select a.*, parent_external_id, {title('parent_external_id')} as title,
                    {record_type('parent_external_id')} as record_type,
                    s.* exclude (zip_code), c.* exclude (account_external_id),
                    {domains('own.account_regex')} as domain_list
                from account_profiles a left join parents on child_id = account_id
                    left join serviceability s on s.zip_code = location_zip_code
                    left join churn_risk c on c.account_external_id = a.account_external_id
                    left join accounts own on own.id = account_id
                where a.is_deleted is distinct from true)""",
        ),
        "carriers_model": query(
            f"carriers drivers {facts} etas",
            f"select {layout_sql(contract.CARRIERS)} from joined",
            states_cte(),
            CARRIER_IDS,
            *scorecard(carrier),
            f"seen as ({active(carrier, 'carrier_name')})",
            """joined as (
                select c.*, d.driver_external_id, card.*
                from carriers c left join drivers d on d.carrier_permissions = 'owner'
                        and (d.email_address, d.carrier_external_id) = (c.email_address, c.external_id)
                    left join seen on seen.carrier_external_id = c.external_id
                    left join card on card.carrier_external_id = c.external_id
                where name not in ('', ' '))""",
        ),
        "drivers_model": query(
            f"drivers {facts} etas routes route_templates route_drivers carriers email_exclusions",
            f"select {layout_sql(contract.DRIVERS)} from joined",
            states_cte(),
            DRIVER_IDS,
            *scorecard(driver),
            ROUTE_HISTORY,
            ACTIVE_ROUTES,
            *list_ctes(),
            equipped,
            f"""joined as (
                select drivers.*, ar.active as active_route_driver, ar.route_template_id, card.*, lists.*,
                    {flag} as is_route_driver, 'Driver' as contact_record_type,
                    {verdict.replace('driver_external_id in', 'drivers.driver_external_id in')} as certification
                from drivers left join active_routes ar using (driver_external_id)
                    left join lists using (driver_external_id) left join card using (driver_external_id)
                where {named_drivers} and {unlisted('email_exclusions')}
                qualify row_number() over (
                    partition by drivers.driver_external_id order by last_request_viewed desc nulls last) = 1)""",
        ),
    }
