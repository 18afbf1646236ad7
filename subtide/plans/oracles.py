"""Hand-written DuckDB SQL for every query, over the same parquet tables.

The SQL uses its own formulations: plain window numbering, filtered distinct
counts, generate_series and exact integer rounding.
"""

from __future__ import annotations

CUTOFF = "TIMESTAMP '2001-09-01 23:59:59'"


def rounded(num: str, den: str) -> str:
    """num / den rounded half away from zero to 2 digits, by integer arithmetic."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"CASE WHEN {d} <> 0 THEN "
        f"sign({n}) * ((200 * abs({n}) + {d}) // (2 * {d})) / 100.0 END"
    )


def percent(part: str, whole: str) -> str:
    return rounded(f"100 * ({part})", whole)


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def spans(start: str, end: str, unit_seconds: int, names: tuple[str, str, str]) -> str:
    """Average, minimum and maximum duration columns."""
    us = f"(epoch_us({end}) - epoch_us({start}))"
    unit = unit_seconds * 1_000_000
    return f"""
        {rounded(f"SUM({us})", f"COUNT(*) * {unit}")} AS {names[0]},
        {rounded(f"MIN({us})", str(unit))} AS {names[1]},
        {rounded(f"MAX({us})", str(unit))} AS {names[2]}"""


DAY, HOUR = 86400, 3600

LINE_ORDER = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)



def stored(created: str, number: str) -> str:
    """Times of creation and update, of which some are not later or NULL."""
    return f"""{created} AS created_at, CASE WHEN ({number}) % 7 <> 0
        THEN {created} + to_days(CAST(({number}) % 5 - 1 AS INT)) END AS updated_at"""


VIEWS = f"""
WITH b_plans AS (
    SELECT CAST(o_orderpriority[1:1] AS BIGINT) AS plan_id,
        o_orderpriority[3:] AS plan_name,
        MIN(CAST(o_totalprice AS DECIMAL(10,2))) AS monthly_price,
        MAX(o_orderdate) >= TIMESTAMP '2001-07-30' AS is_available,
        {stored("MIN(o_orderdate)", "CAST(o_orderpriority[1:1] AS BIGINT) * 3 + 4")}
    FROM orders GROUP BY 1, 2
), b_customers AS (
    SELECT c_custkey AS customer_id, upper(c_mktsegment[1:1]) AS gender,
        DATE '1992-01-01' + CAST(floor(abs(c_acctbal) / 2) AS INTEGER) AS signup_date,
        CAST(c_nationkey AS VARCHAR) AS state_code, lower(c_mktsegment) AS acquisition_channel,
        {stored("CAST(DATE '1992-01-01' + CAST(floor(abs(c_acctbal) / 2) AS INTEGER) AS TIMESTAMP)", "c_custkey")}
    FROM customer
), b_span AS (
    SELECT l_orderkey AS k, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship,
        COUNT(*) AS lines
    FROM lineitem GROUP BY 1
), b_status AS (
    SELECT *, CASE o_orderstatus
        WHEN 'F' THEN CASE o_orderkey % 2 WHEN 0 THEN 'cancelled' ELSE 'completed' END
        WHEN 'O' THEN 'active'
        ELSE CASE o_orderkey % 3 WHEN 0 THEN 'rejected' ELSE 'pending' END END AS status
    FROM orders
), b_started AS (
    SELECT *, CASE WHEN status NOT IN ('rejected', 'pending') AND last_ship > o_orderdate
        THEN greatest(first_ship, o_orderdate + INTERVAL 1 DAY) END AS activated_at
    FROM b_status LEFT JOIN b_span ON k = o_orderkey
), b_subs AS (
    SELECT o_orderkey AS subscription_id, o_custkey AS customer_id,
        CAST(o_orderpriority[1:1] AS BIGINT) AS plan_id, status AS subscription_status,
        o_orderdate AS selected_at, activated_at,
        CASE WHEN status = 'rejected' THEN o_orderdate + to_days(CAST(1 + o_orderkey % 7 AS INT))
            WHEN status IN ('cancelled', 'completed') AND last_ship > activated_at
            THEN last_ship END AS ended_at, {stored("o_orderdate", "o_orderkey")}
    FROM b_started
), b_intakes AS (
    SELECT k AS intake_id, k AS subscription_id,
        CASE lines WHEN 1 THEN 'expired' WHEN 2 THEN 'pending' ELSE 'completed' END
            AS intake_status,
        CASE WHEN NOT (lines = 1 AND k % 2 = 0) THEN first_ship - INTERVAL 48 HOUR END
            AS started_at,
        CASE WHEN lines > 2 OR (lines = 2 AND k % 2 = 1)
            THEN first_ship + to_hours(CAST(lines * 6 - 24 AS BIGINT)) END AS completed_at,
        {stored("first_ship", "k")}
    FROM b_span
), b_slots AS (
    SELECT l_orderkey AS k, l_linenumber AS line, MIN(l_shipdate) AS slot_at,
        CAST(MAX(l_quantity) AS BIGINT) AS q
    FROM lineitem GROUP BY 1, 2
), b_slot_status AS (
    SELECT *, CASE WHEN q % 6 = 0 THEN 'no_show' WHEN q % 6 = 1 THEN 'cancelled'
        WHEN q % 6 = 2 THEN 'scheduled' WHEN q % 12 = 3 THEN 'rescheduled'
        ELSE 'completed' END AS status
    FROM b_slots
), b_appts AS (
    SELECT k * 10 + line AS appointment_id, k AS subscription_id, slot_at AS scheduled_at,
        if(line = 1, 'initial_appt', 'follow_up') AS appointment_type,
        status AS appointment_status,
        CASE q % 7 WHEN 4 THEN 'not_eligible' WHEN 5 THEN NULL WHEN 6 THEN NULL
            ELSE 'eligible' END AS eligibility_result,
        CASE WHEN status = 'completed' OR q % 11 = 0 THEN slot_at + INTERVAL 60 MINUTE END
            AS completed_at, {stored("slot_at", "k + line")}
    FROM b_slot_status
), b_lines AS (
    SELECT *, row_number() OVER (ORDER BY {LINE_ORDER}) AS line_no FROM lineitem
), b_payments AS (
    SELECT line_no AS payment_id, l_orderkey AS subscription_id, l_shipdate AS payment_date,
        CASE WHEN l_linestatus = 'F' THEN 'successful' WHEN l_returnflag = 'N' THEN 'pending'
            ELSE 'failed' END AS payment_status,
        if(l_linenumber = 1, 'initial', 'renewal') AS payment_type,
        CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, {stored("l_shipdate", "l_partkey")}
    FROM b_lines
), b_refunds AS (
    SELECT line_no AS refund_id, line_no AS payment_id,
        l_shipdate + to_days(CAST(l_quantity AS INT) % 5 - 1) AS processed_at,
        CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2))
            AS DECIMAL(10,2)) AS refund_amount,
        CASE l_linenumber WHEN 1 THEN 'treatment_rejection' WHEN 2 THEN 'duplicate_charge'
            WHEN 3 THEN 'plan_change' ELSE 'subscription_cancelled' END AS refund_reason,
        if(l_tax > 0.04, 'completed', 'declined') AS refund_status,
        {stored("l_shipdate", "l_partkey")}
    FROM b_lines WHERE l_returnflag = 'R'
), b_events AS (
    SELECT line_no AS event_id, l_orderkey AS subscription_id,
        ['selected', 'activated', 'treatment_started', 'rejected', 'cancelled',
            'treatment_completed', 'plan_changed'][l_linenumber] AS event_type,
        CASE WHEN l_linenumber IN (4, 5) OR l_returnflag = 'R' THEN
            ['intake_expired', 'not_eligible', 'appointment_no_show', 'payment_failed',
                'patient_request', 'side_effects', 'not_satisfied', 'no_longer_needed', 'other',
                NULL][l_suppkey % 10 + 1] END AS event_reason,
        l_shipdate AS event_timestamp
    FROM b_lines
)
"""

PAYMENTS_BY_PLAN = """b_payments JOIN b_subs USING (subscription_id)
    JOIN b_plans USING (plan_id)"""


def reached(stages: dict[str, str], entity: str, type_col: str = "event_type") -> str:
    return ", ".join(
        f"COUNT(DISTINCT {entity}) FILTER ({type_col} = '{value}') AS {name}"
        for name, value in stages.items()
    )


LIFECYCLE_STAGES = {
    s: s
    for s in [
        "selected",
        "activated",
        "treatment_started",
        "treatment_completed",
        "rejected",
        "cancelled",
    ]
}
VISIT_STAGES = {
    "viewed": "view",
    "clicked": "click",
    "signed_up": "signup",
    "purchased": "purchase",
    "failed": "error",
}


def chronology(table: str, entity: str, type_col: str, ts: str, stages, pairs) -> str:
    latest = ", ".join(
        f"MAX({ts}) FILTER ({type_col} = '{value}') AS {name}" for name, value in stages.items()
    )
    broken = " OR ".join(f"{later} <= {earlier}" for earlier, later in pairs)
    return f"""SELECT * FROM (SELECT {entity}, {latest} FROM {table} GROUP BY {entity})
        WHERE {broken}"""


def row_counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {source}"
        for name, source in tables.items()
    )


LIFECYCLE_TABLES = {
    "customers": "b_customers",
    "plans": "b_plans",
    "subscriptions": "b_subs",
    "intakes": "b_intakes",
    "appointments": "b_appts",
    "payments": "b_payments",
    "refunds": "b_refunds",
    "subscription_events": "b_events",
}


def orphan_rows(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""SELECT '{name}' AS relation, CAST(c.{key} AS BIGINT) AS missing_key,
            COUNT(*) AS row_count
        FROM {child} c
        WHERE c.{key} IS NOT NULL AND c.{key} NOT IN (SELECT {parent_key} FROM {parent})
        GROUP BY c.{key}"""


DRIVER_RELATIONS = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
]

LIFECYCLE_RELATIONS = [
    ("subscriptions", "customer_id", "customers", "customer_id"),
    ("subscriptions", "plan_id", "plans", "plan_id"),
    ("intakes", "subscription_id", "subscriptions", "subscription_id"),
    ("appointments", "subscription_id", "subscriptions", "subscription_id"),
    ("payments", "subscription_id", "subscriptions", "subscription_id"),
    ("refunds", "payment_id", "payments", "payment_id"),
    ("subscription_events", "subscription_id", "subscriptions", "subscription_id"),
]

# Parents of which some rows are gone.
THINNED = {
    "customers": "customer_id % 10 <> 3",
    "plans": "plan_id <> 4",
    "subscriptions": "subscription_status <> 'pending'",
    "payments": "payment_status = 'successful'",
}

DRIVER_KEYS = [
    ("lineitem", "l_orderkey, l_linenumber"),
    ("lineitem", "l_orderkey, l_partkey, l_suppkey"),
    ("orders", "o_orderkey"),
    ("orders", "o_custkey, o_orderdate"),
    ("customer", "c_custkey"),
    ("part", "p_name"),
    ("events", "event_id"),
    ("events", "user_id, event_type"),
    ("documents", "doc_id"),
    ("conversations", "conv_id, turn"),
]


def words(*values: str) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# Table -> (columns that must not be NULL, check name -> predicate that must not be
# FALSE), with the domains of status, type and reason columns.
CHECKS = {
    "customers": (
        ["customer_id", "gender", "state_code", "acquisition_channel"],
        {
            "gender_length": "length(gender) <= 1",
            "state_code_length": "length(state_code) <= 2",
            "acquisition_channel_length": "length(acquisition_channel) <= 20",
        },
    ),
    "plans": (
        ["plan_id", "plan_name", "monthly_price", "is_available"],
        {"plan_name_length": "length(plan_name) <= 30"},
    ),
    "subscriptions": (
        ["subscription_id", "customer_id", "plan_id", "subscription_status", "selected_at"],
        {
            "status_domain": "subscription_status IN "
            + words("pending", "active", "cancelled", "rejected", "completed"),
            "activated_not_before_selected": "NOT activated_at < selected_at",
            "ended_after_selected": "NOT ended_at <= selected_at",
        },
    ),
    "intakes": (
        ["intake_id", "subscription_id", "intake_status"],
        {
            "status_domain": "intake_status IN " + words("completed", "pending", "expired"),
            "completed_needs_earlier_start": "completed_at IS NULL OR "
            "(started_at IS NOT NULL AND completed_at > started_at)",
        },
    ),
    "appointments": (
        [
            "appointment_id",
            "subscription_id",
            "scheduled_at",
            "appointment_type",
            "appointment_status",
        ],
        {
            "type_domain": "appointment_type IN " + words("initial_appt", "follow_up"),
            "status_domain": "appointment_status IN "
            + words("completed", "no_show", "rescheduled", "scheduled", "cancelled"),
            "eligibility_domain": "eligibility_result IN " + words("eligible", "not_eligible"),
            "completed_not_before_scheduled": "NOT completed_at < scheduled_at",
        },
    ),
    "payments": (
        ["payment_id", "subscription_id", "payment_status", "payment_type", "amount"],
        {
            "status_domain": "payment_status IN " + words("successful", "failed", "pending"),
            "type_domain": "payment_type IN " + words("initial", "renewal"),
            "amount_positive": "amount > 0",
        },
    ),
    "refunds": (
        [
            "refund_id",
            "payment_id",
            "processed_at",
            "refund_amount",
            "refund_reason",
            "refund_status",
        ],
        {
            "reason_domain": "refund_reason IN "
            + words(
                "treatment_rejection", "duplicate_charge", "plan_change", "subscription_cancelled"
            ),
            "status_domain": "refund_status IN " + words("completed", "declined"),
            "amount_positive": "refund_amount > 0",
            "processed_not_before_created": "processed_at >= created_at",
        },
    ),
    "subscription_events": (
        ["event_id", "subscription_id", "event_type", "event_timestamp"],
        {
            "type_domain": "event_type IN "
            + words(
                "selected",
                "activated",
                "rejected",
                "plan_changed",
                "cancelled",
                "treatment_started",
                "treatment_completed",
            ),
            "reason_domain": "event_reason IN "
            + words(
                "intake_expired",
                "not_eligible",
                "appointment_no_show",
                "payment_failed",
                "patient_request",
                "side_effects",
                "not_satisfied",
                "no_longer_needed",
                "other",
            ),
        },
    ),
}


def failed_checks() -> str:
    selects = []
    for table, (required, checks) in CHECKS.items():
        rules = {f"{c}_not_null": f"{c} IS NOT NULL" for c in required} | checks
        if table != "subscription_events":
            rules["updated_after_created"] = "updated_at > created_at"
        for name, rule in rules.items():
            selects.append(
                f"SELECT '{table}' AS table_name, '{name}' AS check_name, "
                f"COUNT(*) AS failed_rows FROM {LIFECYCLE_TABLES[table]} WHERE NOT ({rule})"
            )
    return " UNION ALL ".join(selects)


REASON_CASE = """CASE WHEN {slot} <= 50 THEN 'patient_request' WHEN {slot} <= 84
    THEN 'side_effects' WHEN {slot} <= 118 THEN 'not_satisfied' WHEN {slot} <= 152
    THEN 'no_longer_needed' ELSE 'other' END"""

RENEWALS = f"""
    SELECT subscription_id, subscription_status, unnest(generate_series(
        selected_at + INTERVAL 1 MONTH, coalesce(ended_at, {CUTOFF}), INTERVAL 1 MONTH
    )) AS payment_date
    FROM b_subs WHERE activated_at IS NOT NULL"""

REPORTS = {
    "stage_funnel": f"""
        SELECT *, {percent("activated", "selected")} AS activation_rate,
            {percent("treatment_started", "activated")} AS treatment_start_rate,
            {percent("treatment_completed", "treatment_started")} AS treatment_completion_rate
        FROM (SELECT plan_id, plan_name, {reached(LIFECYCLE_STAGES, "s.subscription_id")}
            FROM b_plans LEFT JOIN b_subs s USING (plan_id)
            LEFT JOIN b_events e ON e.subscription_id = s.subscription_id
            GROUP BY ALL)""",
    "reason_share": f"""
        SELECT *, {percent("entity_count", "type_total")} AS reason_pct FROM (
            SELECT *, CAST(SUM(entity_count) OVER (PARTITION BY event_type) AS BIGINT)
                AS type_total
            FROM (SELECT event_type, event_reason,
                    COUNT(DISTINCT subscription_id) AS entity_count
                FROM b_events WHERE event_type IN ('cancelled', 'rejected') GROUP BY 1, 2))""",
    "conversion_by_dimension": f"""
        SELECT *, {percent("converted_count", "selected_count")} AS conversion_pct FROM (
            SELECT acquisition_channel, COUNT(DISTINCT subscription_id) AS selected_count,
                COUNT(DISTINCT if(activated_at IS NULL, NULL, subscription_id))
                    AS converted_count
            FROM b_subs JOIN b_customers USING (customer_id) GROUP BY 1)""",
    "duration_stats": f"""
        SELECT plan_id, plan_name, COUNT(DISTINCT subscription_id) AS activated_count,
            {spans("selected_at", "activated_at", DAY, ("avg_days", "min_days", "max_days"))}
        FROM b_subs JOIN b_plans USING (plan_id) WHERE activated_at IS NOT NULL GROUP BY 1, 2""",
    "payment_outcome_share": f"""
        SELECT payment_type, payment_status, n AS payment_count, type_total,
            {percent("n", "type_total")} AS status_pct
        FROM (SELECT payment_type, payment_status, COUNT(*) AS n FROM b_payments GROUP BY 1, 2)
        JOIN (SELECT payment_type, COUNT(*) AS type_total FROM b_payments GROUP BY 1)
            USING (payment_type)""",
    "conditional_sums": f"""
        SELECT plan_id, plan_name, COUNT(*) AS row_count,
            CAST(SUM(CASE payment_type WHEN 'initial' THEN amount END) AS DOUBLE)
                AS initial_amount,
            CAST(SUM(CASE payment_type WHEN 'renewal' THEN amount END) AS DOUBLE)
                AS renewal_amount,
            CAST(SUM(amount) AS DOUBLE) AS total_amount
        FROM {PAYMENTS_BY_PLAN} WHERE payment_status = 'successful' GROUP BY 1, 2""",
    "status_summary": """
        SELECT refund_status, COUNT(refund_id) AS refund_count,
            CAST(SUM(refund_amount) AS DOUBLE) AS total_amount
        FROM b_refunds GROUP BY 1""",
    "net_of_adjustments": f"""
        SELECT plan_id, plan_name, CAST(gross AS DOUBLE) AS gross_amount,
            CAST(back AS DOUBLE) AS adjusted_amount, CAST(gross - back AS DOUBLE) AS net_amount,
            {percent(cents("back"), cents("gross"))} AS adjusted_pct
        FROM (SELECT plan_id, plan_name, SUM(amount) AS gross,
                coalesce(SUM(refund_amount), 0) AS back
            FROM {PAYMENTS_BY_PLAN} LEFT JOIN (
                SELECT payment_id, refund_amount FROM b_refunds WHERE refund_status = 'completed'
            ) USING (payment_id)
            WHERE payment_status = 'successful' GROUP BY 1, 2)""",
    "extreme_period_changes": f"""
        SELECT period, CAST(amount AS DOUBLE) AS amount,
            CAST(previous AS DOUBLE) AS previous_amount,
            {percent(f"{cents('amount')} - {cents('previous')}", cents("previous"))} AS change_pct
        FROM (SELECT *, min(change) OVER () AS lo, max(change) OVER () AS hi
            FROM (SELECT *, (amount - previous) / nullif(previous, 0) AS change
                FROM (SELECT *, lag(amount) OVER (ORDER BY period) AS previous
                    FROM (SELECT CAST(date_trunc('month', payment_date) AS TIMESTAMP) AS period,
                            SUM(amount) AS amount
                        FROM b_payments WHERE payment_status = 'successful' GROUP BY 1))))
        WHERE change IN (lo, hi)""",
    "period_comparison": """
        SELECT CAST(date_trunc('month', payment_date) AS TIMESTAMP) AS period, payment_type,
            COUNT(*) AS row_count, CAST(SUM(amount) AS DOUBLE) AS total_amount
        FROM b_payments
        WHERE payment_status = 'successful' AND year(payment_date) = 1998
            AND month(payment_date) IN (3, 4)
        GROUP BY 1, 2""",
    "period_status_share": f"""
        SELECT period, payment_status, n AS row_count, CAST(paid AS DOUBLE) AS total_amount,
            {percent("n", "SUM(n) OVER (PARTITION BY period)")} AS status_pct
        FROM (SELECT CAST(date_trunc('month', payment_date) AS TIMESTAMP) AS period,
                payment_status, COUNT(*) AS n, SUM(amount) AS paid
            FROM b_payments
            WHERE payment_type = 'renewal' AND year(payment_date) = 1998
                AND month(payment_date) IN (3, 4)
            GROUP BY 1, 2)""",
    "appointment_outcome_share": f"""
        SELECT appointment_type, appointment_status, n AS appointment_count, type_total,
            {percent("n", "type_total")} AS status_pct
        FROM (SELECT appointment_type, appointment_status, COUNT(*) AS n
            FROM b_appts GROUP BY 1, 2)
        JOIN (SELECT appointment_type, COUNT(*) AS type_total FROM b_appts GROUP BY 1)
            USING (appointment_type)""",
    "outcome_split_by_dimension": f"""
        SELECT *, {percent("eligible", "row_count")} AS eligible_pct,
            {percent("not_eligible", "row_count")} AS not_eligible_pct
        FROM (SELECT plan_id, plan_name, COUNT(*) AS row_count,
                COUNT(*) FILTER (eligibility_result = 'eligible') AS eligible,
                COUNT(*) FILTER (eligibility_result = 'not_eligible') AS not_eligible
            FROM b_appts JOIN b_subs USING (subscription_id) JOIN b_plans USING (plan_id)
            WHERE appointment_type = 'initial_appt' AND appointment_status = 'completed'
            GROUP BY 1, 2)""",
    "event_pair_duration": f"""
        SELECT plan_id, plan_name, COUNT(*) AS row_count,
            {spans("a", "b", DAY, ("avg_duration", "min_duration", "max_duration"))}
        FROM (SELECT subscription_id, MIN(event_timestamp) AS a FROM b_events
            WHERE event_type = 'treatment_started' GROUP BY 1)
        JOIN (SELECT subscription_id, MAX(event_timestamp) AS b FROM b_events
            WHERE event_type = 'treatment_completed' GROUP BY 1) USING (subscription_id)
        JOIN b_subs USING (subscription_id) JOIN b_plans USING (plan_id) GROUP BY 1, 2""",
    "time_to_exit": f"""
        SELECT plan_id, plan_name, COUNT(*) AS row_count,
            {spans("activated_at", "ended_at", DAY,
                ("avg_duration", "min_duration", "max_duration"))}
        FROM b_subs JOIN b_plans USING (plan_id)
        WHERE subscription_status = 'cancelled' AND activated_at IS NOT NULL
            AND ended_at IS NOT NULL
        GROUP BY 1, 2""",
    "entity_frequency": f"""
        SELECT n AS rows_per_entity, COUNT(*) AS entity_count,
            (SELECT COUNT(DISTINCT customer_id) FROM b_subs) AS total_entities,
            {percent("COUNT(*)", "(SELECT COUNT(DISTINCT customer_id) FROM b_subs)")}
                AS entity_pct,
            CAST(SUM(n) AS BIGINT) AS rows_represented
        FROM (SELECT customer_id, COUNT(*) AS n FROM b_subs GROUP BY 1) GROUP BY 1""",
    "nth_transition": """
        SELECT f.plan_id AS first_plan_id, f.plan_name AS first_plan_name,
            g.plan_id AS second_plan_id, g.plan_name AS second_plan_name,
            COUNT(*) AS customer_count
        FROM (SELECT customer_id,
                list(plan_id ORDER BY selected_at, subscription_id) AS chosen
            FROM b_subs GROUP BY 1 HAVING COUNT(*) > 1)
        JOIN b_plans f ON f.plan_id = chosen[1] JOIN b_plans g ON g.plan_id = chosen[2]
        GROUP BY ALL""",
    "status_share": f"""
        SELECT intake_status, COUNT(*) AS intake_count,
            (SELECT COUNT(*) FROM b_intakes) AS total_intakes,
            {percent("COUNT(*)", "(SELECT COUNT(*) FROM b_intakes)")} AS status_pct
        FROM b_intakes GROUP BY 1""",
    "completion_hours": f"""
        SELECT plan_id, plan_name, COUNT(*) AS completed_count,
            {spans("started_at", "completed_at", HOUR, ("avg_hours", "min_hours", "max_hours"))}
        FROM b_intakes JOIN b_subs USING (subscription_id) JOIN b_plans USING (plan_id)
        WHERE intake_status = 'completed' AND started_at IS NOT NULL
            AND completed_at IS NOT NULL
        GROUP BY 1, 2""",
    "status_crosstab": """
        SELECT intake_status, subscription_status, COUNT(*) AS row_count
        FROM b_subs JOIN b_intakes USING (subscription_id) GROUP BY 1, 2""",
    "exit_rate_by_dimension": f"""
        SELECT *, {percent("exit_count", "entity_count")} AS exit_pct FROM (
            SELECT plan_id, plan_name, COUNT(*) AS entity_count,
                nullif(COUNT(*) FILTER (subscription_status = 'cancelled'), 0) AS exit_count
            FROM b_subs JOIN b_plans USING (plan_id) WHERE activated_at IS NOT NULL
            GROUP BY 1, 2)""",
    "exit_reason_share_by_dimension": f"""
        SELECT *, {percent("entity_count", "dimension_total")} AS reason_pct FROM (
            SELECT plan_id, plan_name, event_reason,
                COUNT(DISTINCT subscription_id) AS entity_count,
                CAST(SUM(COUNT(DISTINCT subscription_id)) OVER (PARTITION BY plan_id) AS BIGINT)
                    AS dimension_total
            FROM b_events JOIN b_subs USING (subscription_id) JOIN b_plans USING (plan_id)
            WHERE event_type = 'cancelled' GROUP BY 1, 2, 3)""",
}

DRIVER_TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

QUALITY = {
    "table_row_counts": row_counts({t: t for t in DRIVER_TABLES}),
    "lifecycle_row_counts": row_counts(LIFECYCLE_TABLES),
    "column_profile": """
        SELECT COUNT(*) AS row_count, MIN(signup_date) AS min_signup_date,
            MAX(signup_date) AS max_signup_date,
            COUNT(DISTINCT state_code) AS distinct_state_code,
            COUNT(DISTINCT acquisition_channel) AS distinct_acquisition_channel,
            COUNT(DISTINCT gender) AS distinct_gender
        FROM b_customers""",
    "order_profile": """
        SELECT COUNT(*) AS row_count, MIN(o_orderdate) AS min_o_orderdate,
            MAX(o_orderdate) AS max_o_orderdate,
            COUNT(DISTINCT o_orderstatus) AS distinct_o_orderstatus,
            COUNT(DISTINCT o_orderpriority) AS distinct_o_orderpriority,
            COUNT(DISTINCT o_custkey) AS distinct_o_custkey
        FROM orders""",
    "row_domain_violations": """
        SELECT * FROM b_customers
        WHERE coalesce(gender NOT IN ('F', 'M'), TRUE)
            OR coalesce(signup_date > DATE '2001-09-01', TRUE)
            OR coalesce(length(rtrim(state_code)) <> 2, TRUE)
            OR coalesce(acquisition_channel NOT IN
                ('automobile', 'building', 'furniture', 'household'), TRUE)""",
    "dimension_listing": """
        SELECT plan_name, CAST(monthly_price AS DOUBLE) AS monthly_price, is_available
        FROM b_plans""",
    "duplicate_dimension_names": """
        SELECT p_name, COUNT(*) AS row_count FROM part GROUP BY 1 HAVING COUNT(*) > 1""",
    "duplicate_keys": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS row_count
        FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "status_counts": """
        SELECT subscription_status, COUNT(*) AS row_count FROM b_subs GROUP BY 1""",
    "state_timestamp_consistency": """
        SELECT subscription_id, subscription_status, selected_at, activated_at, ended_at
        FROM b_subs
        WHERE CASE subscription_status
            WHEN 'pending' THEN coalesce(activated_at, ended_at) IS NOT NULL
            WHEN 'active' THEN activated_at IS NULL OR ended_at IS NOT NULL
            WHEN 'rejected' THEN activated_at IS NOT NULL OR ended_at IS NULL
            ELSE activated_at IS NULL OR ended_at IS NULL END""",
    "prerequisite_violations": """
        SELECT subscription_id, subscription_status, activated_at, intake_id, intake_status,
            completed_at
        FROM b_subs LEFT JOIN b_intakes USING (subscription_id)
        WHERE activated_at IS NOT NULL
            AND NOT coalesce(intake_status = 'completed' AND completed_at < activated_at, FALSE)
        """,
    "child_status_consistency": """
        SELECT subscription_id, intake_status, started_at, completed_at, selected_at
        FROM b_intakes JOIN b_subs USING (subscription_id)
        WHERE coalesce(started_at < selected_at, FALSE)
            OR CASE intake_status WHEN 'completed'
                THEN started_at IS NULL OR completed_at IS NULL
                ELSE completed_at IS NOT NULL END""",
    "violation_counts": """
        SELECT COUNT(*) FILTER (intake_status = 'completed' AND completed_at >= ended_at)
                AS completed_after_rejection,
            COUNT(*) FILTER (intake_status = 'expired' AND started_at >= ended_at)
                AS started_after_rejection
        FROM b_subs JOIN b_intakes USING (subscription_id)
        WHERE subscription_status = 'rejected'""",
    "appointment_rules": """
        SELECT * FROM b_appts
        WHERE (appointment_status = 'completed') <> (completed_at IS NOT NULL)
            OR (appointment_type = 'initial_appt'
                AND (appointment_status = 'completed') <> (eligibility_result IS NOT NULL))
            OR (appointment_type = 'follow_up' AND eligibility_result IS NOT NULL)""",
    "status_pair_counts": """
        SELECT appointment_status, eligibility_result, COUNT(*) AS row_count
        FROM b_appts GROUP BY 1, 2""",
    "eligible_population": f"""
        SELECT subscription_status, COUNT(*) AS eligible_count FROM b_subs
        WHERE coalesce(ended_at, {CUTOFF}) - INTERVAL 30 DAY >= activated_at GROUP BY 1""",
    "timeline_violations": f"""
        SELECT subscription_id, appointment_id, appointment_type, appointment_status,
            scheduled_at, a.completed_at AS appointment_completed_at, activated_at, ended_at,
            intake_id, intake_status, i.completed_at AS intake_completed_at
        FROM b_appts a JOIN b_subs USING (subscription_id)
        LEFT JOIN b_intakes i USING (subscription_id)
        WHERE scheduled_at > coalesce(ended_at, {CUTOFF})
            OR CASE appointment_type WHEN 'initial_appt'
                THEN coalesce(intake_status, '') <> 'completed'
                    OR (appointment_status = 'completed' AND a.completed_at <= i.completed_at)
                ELSE activated_at IS NULL OR scheduled_at - INTERVAL 30 DAY < activated_at
                END""",
    "amount_vs_reference": f"""
        SELECT payment_id, subscription_id, payment_status, payment_type, payment_date,
            CAST(amount AS DOUBLE) AS amount, CAST(monthly_price AS DOUBLE) AS monthly_price,
            selected_at, ended_at
        FROM {PAYMENTS_BY_PLAN}
        WHERE payment_date IS NULL OR amount IS DISTINCT FROM monthly_price
            OR payment_date NOT BETWEEN selected_at AND coalesce(ended_at, {CUTOFF})
            OR (payment_type = 'initial' AND payment_status <> 'successful')""",
    "child_cardinality": """
        SELECT subscription_id, COUNT(DISTINCT payment_id) AS child_count
        FROM b_appts a LEFT JOIN (SELECT * FROM b_payments WHERE payment_type = 'initial')
            USING (subscription_id)
        WHERE appointment_type = 'initial_appt'
        GROUP BY 1 HAVING COUNT(DISTINCT payment_id) <> 1""",
    "after_first_event": """
        SELECT subscription_id, payment_id, payment_date,
            (SELECT MIN(f.payment_date) FROM b_payments f
                WHERE f.payment_type = 'initial' AND f.subscription_id = r.subscription_id)
                AS first_date
        FROM b_payments r
        WHERE payment_type = 'renewal'
            AND NOT coalesce(payment_date > first_date, FALSE)""",
    "payment_status_summary": """
        SELECT payment_type, payment_status, COUNT(*) AS row_count,
            CAST(SUM(amount) AS DOUBLE) AS total_amount
        FROM b_payments GROUP BY 1, 2""",
    "refund_rules": """
        SELECT refund_id, payment_id, refund_status, refund_reason,
            CAST(refund_amount AS DOUBLE) AS refund_amount,
            processed_at, payment_status, CAST(amount AS DOUBLE) AS amount, payment_date
        FROM b_refunds LEFT JOIN b_payments p USING (payment_id)
        WHERE p.payment_id IS NULL OR refund_amount > amount OR processed_at < payment_date
            OR (refund_status = 'completed' AND coalesce(payment_status, '') <> 'successful')""",
    "refund_summary": """
        SELECT refund_reason, refund_status, COUNT(*) AS row_count,
            CAST(SUM(refund_amount) AS DOUBLE) AS total_amount
        FROM b_refunds GROUP BY 1, 2""",
    "conditional_domain": """
        SELECT event_id, subscription_id, event_type, event_reason, event_timestamp FROM b_events
        WHERE CASE event_type
            WHEN 'plan_changed' THEN FALSE
            WHEN 'rejected' THEN coalesce(event_reason NOT IN
                ('intake_expired', 'appointment_no_show', 'not_eligible'), TRUE)
            WHEN 'cancelled' THEN coalesce(event_reason NOT IN
                ('patient_request', 'side_effects', 'not_satisfied', 'no_longer_needed',
                    'other'), TRUE)
            ELSE event_reason IS NOT NULL END""",
    "lifecycle_coverage": f"""
        SELECT subscription_status, COUNT(DISTINCT s.subscription_id) AS total_count,
            {reached(LIFECYCLE_STAGES, "s.subscription_id")}
        FROM b_subs s LEFT JOIN b_events e ON e.subscription_id = s.subscription_id
        GROUP BY 1""",
    "duplicate_events": """
        SELECT subscription_id, event_type, COUNT(*) AS row_count FROM b_events
        GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "chronology_violations": chronology(
        "b_events JOIN b_subs USING (subscription_id)",
        "subscription_id",
        "event_type",
        "event_timestamp",
        LIFECYCLE_STAGES,
        [
            ("selected", "activated"),
            ("selected", "rejected"),
            ("activated", "treatment_started"),
            ("treatment_started", "cancelled"),
            ("treatment_started", "treatment_completed"),
        ],
    ),
    "source_consistency": """
        SELECT subscription_id, event_type, event_timestamp, selected_at, activated_at, ended_at
        FROM b_events LEFT JOIN b_subs USING (subscription_id)
        WHERE event_type NOT IN ('treatment_started', 'plan_changed')
            AND event_timestamp IS DISTINCT FROM CASE event_type
                WHEN 'selected' THEN selected_at WHEN 'activated' THEN activated_at
                ELSE ended_at END""",
    "check_constraints": failed_checks(),
    "referential_integrity": " UNION ALL ".join(
        orphan_rows(f"{child}.{key}->{parent}", child, key, parent, parent_key)
        for child, key, parent, parent_key in DRIVER_RELATIONS
    ),
    "lifecycle_references": " UNION ALL ".join(
        orphan_rows(
            f"{child}.{key}",
            LIFECYCLE_TABLES[child],
            key,
            f"(SELECT * FROM {LIFECYCLE_TABLES[parent]} WHERE {THINNED[parent]})",
            parent_key,
        )
        for child, key, parent, parent_key in LIFECYCLE_RELATIONS
    ),
    "uniqueness": " UNION ALL ".join(
        f"""SELECT '{table}.{key.replace(", ", "+")}' AS key_name, COUNT(*) AS duplicate_keys,
            CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS surplus_rows
        FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {key} HAVING COUNT(*) > 1)"""
        for table, key in DRIVER_KEYS
    ),
}

TRANSFORMS = {
    "dense_number": """
        SELECT line_no, l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
            l_shipdate
        FROM b_lines""",
    "dense_number_by_group": """
        SELECT o_orderkey, o_orderstatus, o_orderdate, row_number() OVER (
            PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS row_no
        FROM orders""",
    "cyclic_bucket": f"""
        SELECT o_orderkey, {REASON_CASE.format(slot="(o_orderkey * 37 % 170)")} AS reason
        FROM orders""",
    "every_nth": """
        SELECT o_orderkey, o_orderstatus, row_number() OVER (
            PARTITION BY o_orderstatus ORDER BY o_orderkey) AS row_no
        FROM orders QUALIFY row_no % 5 = 0""",
    "every_nth_remainders": """
        SELECT o_orderkey, o_orderstatus, row_number() OVER (
            PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS row_no
        FROM orders QUALIFY row_no % 5 < 3""",
    "derive_timestamps": """
        SELECT *, CASE subscription_status
            WHEN 'completed' THEN review_at + to_days(CAST(90 + subscription_id * 5 % 276 AS INT))
            WHEN 'cancelled'
            THEN selected_at + to_days(CAST(30 + subscription_id * 5 % 151 AS INT)) END
            AS closed_at
        FROM (SELECT subscription_id, subscription_status, selected_at,
                CASE subscription_status
                WHEN 'active' THEN selected_at + to_days(CAST(1 + subscription_id * 3 % 7 AS INT))
                WHEN 'completed'
                THEN selected_at + to_days(CAST(1 + subscription_id * 3 % 7 AS INT))
                WHEN 'rejected' THEN selected_at + to_hours(12 + subscription_id * 5 % 48) END
                AS review_at
            FROM b_subs)""",
    "expand_recurring": RENEWALS,
    "censor_at": """
        SELECT subscription_id,
            if(ended_at > TIMESTAMP '2000-01-01', 'active', subscription_status)
                AS subscription_status,
            if(ended_at <= TIMESTAMP '2000-01-01', ended_at, NULL) AS ended_at
        FROM b_subs""",
    "due_status": f"""
        SELECT subscription_id, subscription_status, payment_date,
            CASE WHEN subscription_status = 'active'
                    AND payment_date >= {CUTOFF} - INTERVAL 7 DAY THEN 'pending'
                WHEN row_number() OVER (ORDER BY payment_date, subscription_id) % 12 = 0
                THEN 'failed' ELSE 'successful' END AS payment_status
        FROM ({RENEWALS})""",
    "first_charge": """
        SELECT subscription_id, i.completed_at + INTERVAL 60 MINUTE AS payment_date,
            'successful' AS payment_status, 'initial' AS payment_type,
            CAST(monthly_price AS DOUBLE) AS amount
        FROM b_appts JOIN b_intakes i USING (subscription_id) JOIN b_subs USING (subscription_id)
        JOIN b_plans USING (plan_id)
        WHERE appointment_type = 'initial_appt' AND intake_status = 'completed'""",
    "full_reversal": """
        SELECT payment_id, a.completed_at + INTERVAL 30 MINUTE AS processed_at,
            CAST(amount AS DOUBLE) AS refund_amount, 'treatment_rejection' AS refund_reason,
            'completed' AS refund_status, a.completed_at AS created_at
        FROM b_payments JOIN b_appts a USING (subscription_id)
        WHERE payment_type = 'initial' AND payment_status = 'successful'
            AND appointment_type = 'initial_appt' AND appointment_status = 'completed'
            AND eligibility_result = 'not_eligible'""",
    "latest_in_window": f"""
        SELECT payment_id, ended_at + INTERVAL 30 MINUTE AS processed_at,
            CAST(amount AS DOUBLE) AS refund_amount, 'subscription_cancelled' AS refund_reason,
            if(row_number() OVER (ORDER BY ended_at, payment_id) % 5 = 0, 'declined', 'completed')
                AS refund_status,
            ended_at AS created_at
        FROM b_payments JOIN (
            SELECT payment_id, ended_at FROM (
                SELECT ended_at, arg_max(payment_id, (payment_date, payment_id)) AS payment_id
                FROM b_payments JOIN b_subs USING (subscription_id)
                WHERE subscription_status = 'cancelled' AND payment_status = 'successful'
                    AND payment_date <= ended_at
                    AND payment_date >= ended_at - INTERVAL 365 DAY
                GROUP BY subscription_id, ended_at)
            WHERE ended_at <= {CUTOFF} - INTERVAL 30 MINUTE) USING (payment_id)""",
    "state_to_events": f"""
        SELECT subscription_id, 'selected' AS event_type, CAST(NULL AS VARCHAR) AS event_reason,
            selected_at AS event_timestamp FROM b_subs
        UNION ALL SELECT subscription_id, 'activated', NULL, activated_at FROM b_subs
            WHERE activated_at IS NOT NULL
        UNION ALL SELECT subscription_id, 'cancelled',
            {REASON_CASE.format(slot="(subscription_id * 37 % 170)")}, ended_at FROM b_subs
            WHERE subscription_status = 'cancelled' AND ended_at IS NOT NULL
        UNION ALL SELECT subscription_id, 'treatment_completed', NULL, ended_at FROM b_subs
            WHERE subscription_status = 'completed' AND ended_at > activated_at""",
    "reason_from_context": """
        SELECT subscription_id, 'rejected' AS event_type,
            CASE WHEN intake_status = 'expired' THEN 'intake_expired'
                WHEN subscription_id IN (SELECT subscription_id FROM b_appts
                    WHERE appointment_type = 'initial_appt' AND appointment_status = 'no_show')
                THEN 'appointment_no_show' ELSE 'not_eligible' END AS event_reason,
            ended_at AS event_timestamp
        FROM b_subs JOIN b_intakes USING (subscription_id)
        WHERE subscription_status = 'rejected'""",
    "update_from": """
        SELECT intake_id, i.subscription_id, intake_status,
            CASE WHEN activated_at IS NOT NULL
                    OR (subscription_status = 'rejected' AND started_at IS NOT NULL)
                THEN selected_at + to_hours(2 + i.subscription_id * 3 % 4)
                WHEN subscription_status = 'rejected' THEN NULL
                ELSE started_at END AS started_at,
            CASE WHEN subscription_status = 'rejected' THEN
                    if(intake_status = 'completed',
                        ended_at - to_hours(10 + i.subscription_id * 3 % 5), NULL)
                WHEN activated_at IS NOT NULL
                THEN activated_at - to_hours(12 + i.subscription_id * 5 % 7)
                ELSE completed_at END AS completed_at,
            i.created_at, i.updated_at
        FROM b_intakes i LEFT JOIN b_subs s ON s.subscription_id = i.subscription_id""",
    "bounded_event": f"""
        SELECT * FROM (
            SELECT subscription_id,
                activated_at + to_days(CAST(7 + subscription_id * 5 % 8 AS INT))
                    AS event_timestamp
            FROM b_subs
            WHERE activated_at + to_days(CAST(7 + subscription_id * 5 % 8 AS INT))
                <= coalesce(ended_at, {CUTOFF}))""",
    "append_with_defaults": """
        SELECT * FROM (
            SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal
            FROM supplier
            UNION ALL
            SELECT (SELECT MAX(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_custkey),
                c_name, c_nationkey, 0.0
            FROM customer)""",
}

ACTIVITY = {
    "daily_funnel": f"""
        SELECT *, {percent("clicked", "viewed")} AS click_rate,
            {percent("signed_up", "clicked")} AS signup_rate,
            {percent("purchased", "signed_up")} AS purchase_rate
        FROM (SELECT c_mktsegment AS segment,
                {reached(VISIT_STAGES, "(user_id, CAST(ts AS DATE))")}
            FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1)""",
    "event_type_share": f"""
        SELECT event_type, COUNT(*) AS row_count,
            (SELECT COUNT(*) FROM events) AS total_count,
            {percent("COUNT(*)", "(SELECT COUNT(*) FROM events)")} AS share_pct
        FROM events GROUP BY 1""",
    "event_reason_share": f"""
        SELECT *, {percent("entity_count", "type_total")} AS reason_pct FROM (
            SELECT event_type, props, COUNT(DISTINCT user_id) AS entity_count,
                CAST(SUM(COUNT(DISTINCT user_id)) OVER (PARTITION BY event_type) AS BIGINT)
                    AS type_total
            FROM events WHERE event_type IN ('error', 'purchase') GROUP BY 1, 2)""",
    "view_to_purchase": f"""
        SELECT c_mktsegment AS segment, COUNT(*) AS row_count,
            {spans("a", "b", DAY, ("avg_duration", "min_duration", "max_duration"))}
        FROM (SELECT user_id, MIN(ts) AS a FROM events WHERE event_type = 'view' GROUP BY 1)
        JOIN (SELECT user_id, MAX(ts) AS b FROM events WHERE event_type = 'purchase' GROUP BY 1)
            USING (user_id)
        JOIN customer ON c_custkey = user_id GROUP BY 1""",
    "error_reasons_by_segment": f"""
        SELECT *, {percent("entity_count", "dimension_total")} AS reason_pct FROM (
            SELECT c_mktsegment AS segment, props, COUNT(DISTINCT user_id) AS entity_count,
                CAST(SUM(COUNT(DISTINCT user_id)) OVER (PARTITION BY c_mktsegment) AS BIGINT)
                    AS dimension_total
            FROM events JOIN customer ON c_custkey = user_id
            WHERE event_type = 'error' GROUP BY 1, 2)""",
    "segment_coverage": f"""
        SELECT c_mktsegment AS segment, COUNT(DISTINCT c_custkey) AS total_count,
            {reached(VISIT_STAGES, "user_id")}
        FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1""",
    "user_chronology": chronology(
        "events JOIN customer ON c_custkey = user_id",
        "user_id",
        "event_type",
        "ts",
        VISIT_STAGES,
        [("viewed", "clicked"), ("clicked", "signed_up"), ("signed_up", "purchased")],
    ),
    "repeated_event_types": """
        SELECT user_id, event_type, COUNT(*) AS row_count FROM events
        GROUP BY 1, 2 HAVING COUNT(*) > 1""",
}

INTEGER_COLUMNS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "part": ["p_partkey", "p_size"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
    "events": ["event_id", "user_id"],
}



def placed(body: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({body})"


PLACED = {
    "placed_status_pairs": placed(
        QUALITY["status_pair_counts"], "appointment_status NULLS LAST, eligibility_result NULLS LAST"
    ),
    "placed_status_share": placed(
        REPORTS["status_share"], "intake_count DESC, intake_status DESC NULLS FIRST"
    ),
    "placed_outcome_share": placed(
        REPORTS["appointment_outcome_share"],
        "appointment_type NULLS LAST, appointment_count DESC, appointment_status NULLS LAST",
    ),
}

STORED = {
    "checks_on_write": QUALITY["check_constraints"],
    "key_ranges": " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count,
            CAST(MIN({c}) AS BIGINT) AS min_value, CAST(MAX({c}) AS BIGINT) AS max_value FROM {table}"""
        for table, columns in INTEGER_COLUMNS.items()
        for c in columns
    ),
    "partials_comparison": REPORTS["period_comparison"],
    "partials_extremes": REPORTS["extreme_period_changes"],
    "partition_update": """
        SELECT o_orderkey, o_orderpriority,
            CASE WHEN o_orderpriority LIKE '1%' AND lines >= 6 THEN last_ship ELSE o_orderdate END AS o_orderdate
        FROM orders LEFT JOIN (SELECT l_orderkey, MAX(l_shipdate) AS last_ship, COUNT(*) AS lines
            FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "bucketed_prerequisites": QUALITY["prerequisite_violations"],
}

ORACLES: dict[str, str] = {
    name: (VIEWS + body if "b_" in body else body).strip()
    for name, body in {**REPORTS, **QUALITY, **TRANSFORMS, **PLACED, **STORED, **ACTIVITY}.items()
}
