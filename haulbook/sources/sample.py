"""The input tables derived from the star-schema sample data, for checks and the benchmark.

Every expression is SQL that Spark and the oracle engine read alike, so both see the same rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from haulbook.sources.tables import COLUMNS

AS_OF = "2001-06-30"

PHONES = [
    "5555550123", "+15555550123", "15555550123", "555-555-0123", "555.555.0123", "(555) 555-0123",
    "+1 (555) 555-0123", "1 (555) 555-0123", "+1 555 555 0123", "+1+15555550123", "tel://+15555550123",
    "tel://5555550123", "tel://15555550123", "tel://+15555550123;ext=5", "TEL://+15555550123",
    "tel:5555550123", "5555550123 x9", "15555550123 x9", "5555550123deleted", "deleted", "--", "---", "",
    "555-0123", " 5555550123", "+445555550123", None,
]
STATES = [
    "Texas", " tx ", "TX", "West Virginia", "Virginia", "WV", "Arkansas", "Kansas", "Washington DC",
    "District of Columbia", "Washington, District of Columbia", "Indianapolis", "Delaware County, Ohio",
    "New  York", "newyork", "Puerto Rico", "PR", "", None, "D.C.",
]
DOMAINS = [
    "^(.*)(@foo.com|@bar.com)$", "(.*)(@foo.com)$", "^(.*)@foo.com$", None, "", " @foo.com ", "@a.com)$|@b.com)$",
]
CODES = [
    "did_not_follow_delivery_instructions", "wrong_vehicle", "confirmed_wrong_vehicle", "wrong_accessories",
    "did_not_deliver_all_items", "self_unassignment", "scheduled_delivery_failure",
    "did_not_complete_multistop_delivery", "late_arrival",
]


def pick(values: list[str | None], key: str) -> str:
    """CASE that deals the values out by key."""
    cases = " ".join(f"when {i} then {'null' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"case {key} % {len(values)} {cases} end"


def filler(kind: str, column: str, key: str) -> str:
    """Stand-in expression for a column the sample says nothing about; another one for each column."""
    n = zlib.crc32(column.encode()) % 99_991
    clock = f"{n % 24:02}:{n // 24 % 60:02}:{n // 1440 % 60:02}.125"
    return {
        "string": f"concat('{column}-', {key})",
        "bigint": f"cast({key} % 97 + {n} as bigint)",
        "double": f"cast({key} % 1000 + {n} as double) / 8",
        "boolean": f"case when ({key} + {n % 5}) % 5 = 0 then null else ({key} + {n % 61}) % {7 + n % 53} < {3 + n % 4} end",
        "timestamp": f"cast(concat('2001-06-0', {key} % 9 + 1, ' {clock}') as timestamp)",
    }[kind]


def june_morning(key: str) -> str:
    return f"cast(concat('2001-06-0', {key} % 9 + 1, ' 08:30:00.125') as timestamp)"


CARRIER = "case when l_partkey % 17 = 0 then null else concat('C', l_suppkey) end"
DRIVER = "case when l_partkey % 23 = 0 then null else concat('D', l_partkey) end"
DELIVERY_TYPE = (
    "case when l_returnflag = 'R' and l_linenumber % 2 = 0 then 'route' when l_returnflag = 'R' then 'cms' "
    "when l_returnflag = 'A' and l_linenumber = 7 then null when l_returnflag = 'A' then 'msd' else 'hotshot' end"
)
DELETED = "case c_custkey % 7 when 0 then true when 1 then null else false end"

DRIVER_COLUMNS = {
    "driver_external_id": "concat('D', p_partkey)",
    "carrier_external_id": "concat('C', p_partkey % 10)",
    "carrier_id": "case when p_partkey % 6 = 0 then null else p_partkey % 10 end",
    "email_address": (
        "case when p_partkey % 4 = 0 then concat('ops', p_partkey % 10, '@example.com') "
        "when p_partkey % 31 = 0 then null else concat(' Drv', p_partkey, '@Example.com ') end"
    ),
    "carrier_permissions": "case p_partkey % 3 when 0 then 'owner' when 1 then 'driver' else null end",
    "first_name": "case p_partkey % 19 when 0 then '' when 1 then null else p_name end",
    "last_name": "case p_partkey % 29 when 0 then '' when 1 then null else p_brand end",
    "phone_number": pick(PHONES, "p_partkey"),
    "state": pick(STATES, "p_partkey"),
    "last_request_viewed": f"case when p_partkey % 7 = 0 then null else {june_morning('p_partkey')} end",
    "driver_accessory_csv": (
        "case p_partkey % 5 when 0 then null when 1 then '' when 2 then 'Hard Hat (PPE);Ramp' "
        "when 3 then 'vest (ppe);Dolly;Dolly' else 'Straps' end"
    ),
    "driver_capability_csv": "case when p_partkey % 8 = 0 then '' else concat(p_type, ';', p_brand) end",
    "active_violation_csv": "case when p_partkey % 9 = 0 then null else 'late;late;no_show' end",
    "lifetime_violation_csv": "'late;no_show'",
    "driver_vehicle_accessory_csv": "'liftgate;ramp'",
    "preferred_delivery_csv": "'hotshot'",
    "upscale_delivery_csv": "concat('u', p_size % 3, ';u0')",
    "driver_tag_csv": (
        "case p_partkey % 4 when 0 then 'ppe-certified;vip' when 1 then null when 2 then 'PPE-certified' else '' end"
    ),
}

# Text columns that stand for arrays: null stays null, '' is an empty array, else split at ';'.
CSV_ARRAYS = {
    "driver_accessory_csv": "driver_accessory_names",
    "driver_capability_csv": "driver_capability_names",
    "active_violation_csv": "active_violation_types",
    "lifetime_violation_csv": "lifetime_violation_types",
    "driver_vehicle_accessory_csv": "driver_vehicle_accessory_names",
    "preferred_delivery_csv": "preferred_delivery_methods",
    "upscale_delivery_csv": "upscale_delivery_methods",
    "driver_tag_csv": "driver_tags",
    "preferences_csv": "preferences",
}

# table -> branches (base table, filter or None, base key, column expressions), united as they are.
SAMPLE: dict[str, list[tuple[str, str | None, str, dict[str, str]]]] = {
    "deliveries": [
        (
            "lineitem",
            None,
            "l_orderkey",
            {
                "delivery_id": "l_orderkey",
                "delivery_external_id": "concat('X', l_orderkey, '-', l_linenumber)",
                "carrier_external_id": CARRIER,
                "carrier_name": "concat('Carrier ', l_suppkey)",
                "driver_external_id": DRIVER,
                "driver_name": "concat('Driver ', l_partkey)",
                "delivery_type": DELIVERY_TYPE,
                "created_at": "l_shipdate",
                "is_completed_delivery": "case when l_linenumber = 6 then null else l_linestatus = 'F' end",
                "customer_rating": (
                    "case when l_orderkey % 3 = 0 or l_suppkey % 10 = 9 then null "
                    "else cast(l_partkey % 5 + 1 as double) end"
                ),
            },
        )
    ],
    "violations": [
        (
            "lineitem",
            "l_orderkey % 5 = 0",
            "l_orderkey",
            {
                "delivery_external_id": "concat('X', l_orderkey, '-', l_linenumber)",
                "carrier_external_id": CARRIER,
                "carrier_name": (
                    "case when l_suppkey % 4 = 0 then concat('Carrier ', l_suppkey, ' LLC') "
                    "else concat('Carrier ', l_suppkey) end"
                ),
                "driver_external_id": DRIVER,
                "driver_name": "concat('Driver ', l_partkey)",
                "delivery_type": DELIVERY_TYPE,
                "created_at": "l_shipdate",
                "violation_type_code": pick(CODES, "l_partkey"),
            },
        )
    ],
    "etas": [
        (
            "orders",
            None,
            "o_orderkey",
            {
                "delivery_id": "o_orderkey",
                "seconds_to_origin_delta": (
                    "case when o_orderkey % 11 = 0 then null else (o_orderkey * 60) % 7200 - 3600 end"
                ),
                "seconds_to_destination_delta": "(o_orderkey * 30) % 5400 - 2700",
            },
        )
    ],
    "carriers": [
        (
            "supplier",
            None,
            "s_suppkey",
            {
                "id": "s_suppkey",
                "external_id": "concat('C', s_suppkey)",
                "name": "case s_suppkey % 10 when 7 then '' when 8 then ' ' when 9 then null else s_name end",
                "email_address": "concat('ops', s_suppkey, '@example.com')",
                "phone_number": pick(PHONES, "s_suppkey"),
                "state": pick(STATES, "s_suppkey"),
                "preferences_csv": "case s_suppkey % 3 when 0 then null when 1 then '' else 'local;overnight' end",
            },
        )
    ],
    "drivers": [
        ("part", None, "p_partkey", DRIVER_COLUMNS),
        (
            "part",
            "p_partkey % 25 = 0",
            "p_partkey",
            {
                **DRIVER_COLUMNS,
                "last_request_viewed": "cast('2001-06-15 00:00:00' as timestamp)",
                "driver_accessory_csv": "'Straps;Gloves (PPE)'",
            },
        ),
    ],
    "routes": [
        (
            "orders",
            None,
            "o_orderkey",
            {
                "route_template_id": "o_custkey % 30",
                "driver_id": "case when o_orderkey % 13 = 0 then null else o_custkey end",
                "carrier_id": "o_custkey % 10",
                "fulfilled_on": "case when o_orderkey % 37 = 0 then null else cast(o_orderdate as date) end",
            },
        )
    ],
    "route_templates": [
        ("nation", None, "n_nationkey", {"id": "n_nationkey", "external_id": "concat('RT', n_nationkey)"})
    ],
    "route_drivers": [
        ("part", None, "p_partkey", {"driver_id": "p_partkey", "driver_external_id": "concat('D', p_partkey)"})
    ],
    "accounts": [
        (
            "customer",
            None,
            "c_custkey",
            {
                "id": "c_custkey",
                "external_id": "concat('A', c_custkey)",
                "parent_account_id": "case when c_custkey % 3 = 0 then null else c_custkey % 40 end",
                "is_deleted": DELETED,
                "account_regex": pick(DOMAINS, "c_custkey"),
            },
        )
    ],
    "account_profiles": [
        (
            "customer",
            None,
            "c_custkey",
            {
                "account_id": "c_custkey",
                "account_external_id": "concat('A', c_custkey)",
                "root_account_external_id": "concat('A', c_custkey % 40)",
                "account_type": "case c_custkey % 4 when 0 then 'company' when 1 then null else 'team' end",
                "account_name": "case c_custkey % 9 when 0 then ' ' when 1 then null when 2 then '' else c_name end",
                "company": "case when c_custkey % 11 = 0 then null else c_mktsegment end",
                "location_state": pick(STATES, "c_custkey"),
                "location_zip_code": "case when c_custkey % 13 = 0 then null else concat('Z', c_nationkey) end",
                "location_latitude": "c_acctbal / cast(128 as double)",
                "is_deleted": DELETED,
            },
        )
    ],
    "serviceability": [
        (
            "nation",
            None,
            "n_nationkey",
            {
                "zip_code": "concat('Z', n_nationkey % 20)",
                "overall_score": "cast(n_nationkey as double) / 8",
                "overall_grade": "concat('G', n_regionkey)",
            },
        )
    ],
    "churn_risk": [
        (
            "customer",
            "c_custkey % 3 = 0",
            "c_custkey",
            {
                "account_external_id": "concat('A', c_custkey)",
                "priority_score": "cast(c_custkey % 100 as double) / 4",
                "potential_supply_issue": "case c_custkey % 2 when 0 then true else null end",
            },
        )
    ],
    "email_exclusions": [
        ("part", "p_partkey % 14 = 0", "p_partkey", {"email_address": "concat(' Drv', p_partkey, '@Example.com ')"})
    ],
}


def branch_expressions(table: str, key: str, given: dict[str, str]) -> dict[str, str]:
    """All column expressions of one branch: the given ones, then fillers for the remaining columns."""
    rest = {
        column: filler(kind, column, key)
        for kind, columns in COLUMNS[table].items()
        if kind != "array"
        for column in columns
        if column not in given
    }
    return {**given, **rest}


def sample_table(spark: SparkSession, sf_dir: str, table: str, files: dict[str, DataFrame] | None = None) -> DataFrame:
    """One input table; ``files`` remembers the base files already opened."""
    files = {} if files is None else files
    parts = []
    for base, where, key, given in SAMPLE[table]:
        if base not in files:
            files[base] = spark.read.parquet(f"{sf_dir}/{base}.parquet")
        df = files[base].filter(where) if where else files[base]
        expressions = branch_expressions(table, key, given)
        # Zoneless timestamps, like those in the files, whatever the session time zone.
        zoneless = {name: sql.replace("as timestamp)", "as timestamp_ntz)") for name, sql in expressions.items()}
        df = df.selectExpr(*[f"{sql} as {name}" for name, sql in zoneless.items()])
        arrays = {
            array: f"case when {csv} = '' then array() else split({csv}, ';') end"
            for csv, array in CSV_ARRAYS.items()
            if csv in expressions
        }
        parts.append(df.selectExpr("*", *[f"{sql} as {name}" for name, sql in arrays.items()]) if arrays else df)
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first


class SampleTables(dict):
    """All sample tables by name, each opened when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir, self.files = spark, sf_dir, {}

    def __missing__(self, table: str) -> DataFrame:
        self[table] = sample_table(self.spark, self.sf_dir, table, self.files)
        return self[table]
