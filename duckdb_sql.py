"""The SQL that DuckDB runs on the same tables, one statement per query.

Written per operator from its definition and not from the Spark plans: every check is its own
aggregation, ranks are plain windows and the last event type is a join.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-04-15 00:00:00'"

# Building blocks, each a CTE that may use those before it.
_CTES = {
    "raw": """
        SELECT event_id AS record_id,
               user_id * 100 + (event_id * 7919) % 37 AS client_id,
               CASE event_type WHEN 'signup' THEN 'applied' WHEN 'view' THEN 'docs_submitted'
                    WHEN 'error' THEN 'rejected' WHEN 'purchase' THEN 'signed'
                    WHEN 'click' THEN 'churned' END AS event_type,
               CASE WHEN k <> 99 THEN DATE '2024-01-01' + CAST(date_diff('second',
                    TIMESTAMP '2024-01-01 00:00:00', date_trunc('second', ts)) // 28800 AS INTEGER)
               END AS event_date,
               CASE WHEN k % 10 <> 0 THEN CASE k % 3 WHEN 0 THEN 'basic' WHEN 1 THEN 'pro'
                    ELSE 'premium' END END AS plan,
               CASE WHEN k % 13 <> 0 THEN r_name END AS region,
               CASE WHEN k % 17 <> 0 THEN CASE k % 4 WHEN 0 THEN 'Email'
                    WHEN 1 THEN 'Organic Search' WHEN 2 THEN 'Paid Ads' ELSE 'Referral' END
               END AS marketing_channel,
               CASE WHEN k % 11 <> 0 THEN 50 + k % 25 END AS sales_rep_id,
               CASE WHEN k % 19 <> 0 THEN CASE k % 3 WHEN 0 THEN 'internal_form'
                    WHEN 1 THEN 'web_api' ELSE 'manual_upload' END END AS source_system
        FROM (SELECT *, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e
        LEFT JOIN customer ON user_id = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "filled": """
        SELECT record_id, client_id, event_type, CAST(event_date AS TIMESTAMP) AS event_date,
               upper(substr(coalesce(plan, 'unknown'), 1, 1))
                   || lower(substr(coalesce(plan, 'unknown'), 2)) AS plan,
               region, coalesce(marketing_channel, 'unknown') AS marketing_channel,
               coalesce(sales_rep_id, -1) AS sales_rep_id,
               coalesce(source_system, 'unknown') AS source_system
        FROM raw""",
    "staged": """
        SELECT *, row_number() OVER (PARTITION BY client_id, event_type
                                     ORDER BY event_date, record_id) AS event_rank
        FROM filled WHERE event_date IS NOT NULL""",
    "funnel": """
        SELECT client_id,
               min(event_date) FILTER (event_type = 'applied') AS applied_date,
               min(event_date) FILTER (event_type = 'docs_submitted') AS docs_submitted_date,
               min(event_date) FILTER (event_type = 'rejected') AS rejected_date,
               min(event_date) FILTER (event_type = 'signed') AS signed_date,
               min(event_date) FILTER (event_type = 'churned') AS churned_date
        FROM staged WHERE event_rank = 1 GROUP BY client_id""",
    "funnel_counts": """
        SELECT count(*) AS total_clients, count(applied_date) AS applied_clients,
               count(docs_submitted_date) AS docs_submitted_clients,
               count(rejected_date) AS rejected_clients, count(signed_date) AS signed_clients,
               count(churned_date) AS churned_clients
        FROM funnel""",
    "metrics": """
        SELECT *,
               CASE WHEN total_clients > 0 THEN applied_clients / total_clients ELSE 0.0 END
                   AS application_rate,
               CASE WHEN applied_clients > 0 THEN docs_submitted_clients / applied_clients
                   ELSE 0.0 END AS docs_submission_rate,
               CASE WHEN applied_clients > 0 THEN rejected_clients / applied_clients ELSE 0.0 END
                   AS rejection_rate,
               CASE WHEN applied_clients > 0 THEN signed_clients / applied_clients ELSE 0.0 END
                   AS conversion_rate,
               CASE WHEN signed_clients > 0 THEN churned_clients / signed_clients ELSE 0.0 END
                   AS churn_rate,
               greatest(signed_clients - churned_clients, 0) AS active_clients
        FROM funnel_counts""",
    "durations": """
        SELECT client_id, stage, CAST(floor(micros / 86400000000.0) AS INTEGER) AS days FROM (
            SELECT client_id, 'Applied → Docs' AS stage,
                   date_diff('microsecond', applied_date, docs_submitted_date) AS micros FROM funnel
            UNION ALL SELECT client_id, 'Applied → Rejected',
                   date_diff('microsecond', applied_date, rejected_date) FROM funnel
            UNION ALL SELECT client_id, 'Applied → Signed',
                   date_diff('microsecond', applied_date, signed_date) FROM funnel
            UNION ALL SELECT client_id, 'Signed → Churned',
                   date_diff('microsecond', signed_date, churned_date) FROM funnel)
        WHERE micros IS NOT NULL""",
    "last_events": """
        SELECT client_id, max(event_date) AS last_event_date,
               max(event_date) FILTER (event_type = 'applied') AS applied_date,
               max(event_date) FILTER (event_type = 'signed') AS signed_date,
               max(event_date) FILTER (event_type = 'churned') AS churned_date
        FROM staged GROUP BY client_id""",
    "last_types": """
        SELECT * FROM last_events LEFT JOIN (
            SELECT client_id, event_date AS last_event_date, event_type AS last_event_type
            FROM staged WHERE event_rank = 1) USING (client_id, last_event_date)""",
    "churn": f"""
        SELECT *, CASE WHEN churned_date IS NOT NULL THEN 1 ELSE 0 END AS is_churned,
               date_diff('microsecond', last_event_date, {AS_OF}) / 86400000000.0
                   AS days_since_last_event,
               date_diff('microsecond', signed_date, {AS_OF}) / 86400000000.0 AS days_since_signed
        FROM last_types""",
    "risk": """
        SELECT *, CASE WHEN is_churned = 1 THEN 'Already Churned'
                       WHEN days_since_last_event IS NULL THEN 'Unknown'
                       WHEN days_since_last_event <= 30 THEN 'Low Risk'
                       WHEN days_since_last_event <= 60 THEN 'Medium Risk'
                       ELSE 'High Risk' END AS risk_category
        FROM churn""",
    "summary": """
        SELECT *, CASE WHEN total_clients > 0 THEN churned_clients / total_clients * 100
                       ELSE 0.0 END AS churned_percentage
        FROM (SELECT count(*) AS total_clients,
                     count(*) FILTER (risk_category = 'Already Churned') AS churned_clients,
                     count(*) FILTER (risk_category IN ('High Risk', 'Medium Risk'))
                         AS at_risk_clients,
                     count(*) FILTER (risk_category = 'High Risk') AS high_risk_clients,
                     count(*) FILTER (risk_category = 'Medium Risk') AS medium_risk_clients,
                     count(*) FILTER (risk_category = 'Low Risk') AS low_risk_clients,
                     count(*) FILTER (risk_category = 'Unknown') AS unknown_risk_clients,
                     count(signed_date) AS clients_with_signed,
                     coalesce(avg(days_since_last_event)
                              FILTER (risk_category <> 'Already Churned'), 0.0) AS avg_days_active,
                     avg(days_since_last_event) AS avg_days_since_last_event,
                     avg(days_since_signed) AS avg_days_since_signed
              FROM risk)""",
    "multiple_applications": """
        SELECT client_id, 'Q1_multiple_applications' AS inconsistency_type,
               'Client has multiple application events' AS description,
               min(event_date) AS relevant_date, count(*) AS application_count,
               CAST(trunc(date_diff('microsecond', min(event_date), max(event_date))
                          / 86400000000.0) AS INTEGER) AS date_range_days
        FROM staged WHERE event_type = 'applied' GROUP BY client_id HAVING count(*) > 1""",
    "signed_without_applied": """
        SELECT client_id, 'Q2_signed_without_applied' AS inconsistency_type,
               'Client signed without applying first' AS description,
               min(event_date) FILTER (event_type = 'signed') AS relevant_date,
               count(*) FILTER (event_type = 'applied') AS applied_count,
               count(*) FILTER (event_type = 'signed') AS signed_count
        FROM staged GROUP BY client_id HAVING signed_count > 0 AND applied_count = 0""",
    "churned_without_signed": """
        SELECT client_id, 'Q3_churned_without_signed' AS inconsistency_type,
               'Client churned without ever signing' AS description,
               min(event_date) FILTER (event_type = 'churned') AS relevant_date,
               count(*) FILTER (event_type = 'signed') AS signed_count,
               count(*) FILTER (event_type = 'churned') AS churned_count
        FROM staged GROUP BY client_id HAVING churned_count > 0 AND signed_count = 0""",
    "long_inactive": f"""
        SELECT client_id, 'Q6_long_inactive_unsigned' AS inconsistency_type,
               'Unsigned client with long inactivity (>60 days) - potential at-risk' AS description,
               last_event_date AS relevant_date, CAST(trunc(idle) AS INTEGER) AS days_inactive,
               signed_count
        FROM (SELECT client_id, max(event_date) AS last_event_date,
                     count(*) FILTER (event_type = 'signed') AS signed_count,
                     date_diff('microsecond', max(event_date), {AS_OF}) / 86400000000.0 AS idle
              FROM staged GROUP BY client_id)
        WHERE signed_count = 0 AND idle > 60""",
    "unknown_values": """
        SELECT client_id, record_id, event_type, event_date,
               'unknown_values' AS inconsistency_type, reason AS description,
               plan, sales_rep_id, region, marketing_channel, source_system
        FROM (SELECT *, coalesce(
                if(plan = 'Unknown', 'Plan field has Unknown value', NULL),
                if(sales_rep_id = -1, 'Sales rep ID is -1 (missing/unknown)', NULL),
                if(coalesce(region, '') = '', 'Region field is missing', NULL),
                if(coalesce(marketing_channel, '') = '', 'Marketing channel is missing', NULL),
                if(coalesce(source_system, '') = '', 'Source system is missing', NULL)) AS reason
              FROM staged)
        WHERE reason IS NOT NULL""",
    "sequence": """
        SELECT client_id, 'sequence_violation' AS inconsistency_type, description, violation_type,
               applied_date AS first_applied_date, signed_date AS first_signed_date,
               docs_submitted_date AS first_docs_date, rejected_date AS first_rejected_date,
               churned_date AS first_churned_date
        FROM (SELECT *, least(if(signed_date < applied_date, 1, NULL),
                              if(docs_submitted_date < applied_date, 2, NULL),
                              if(rejected_date < applied_date, 3, NULL),
                              if(churned_date < signed_date, 4, NULL)) AS n
              FROM funnel)
        JOIN (VALUES (1, 'signed_before_applied', 'Client signed before applying'),
                     (2, 'docs_submitted_before_applied', 'Client submitted docs before applying'),
                     (3, 'rejected_before_applied', 'Client was rejected before applying'),
                     (4, 'churned_before_signed', 'Client churned before signing'))
             AS v(n, violation_type, description) USING (n)""",
    "docs_pattern": """
        SELECT client_id, 'docs_submitted_analysis' AS inconsistency_type,
               CASE WHEN docs_count > 0 THEN 'Has docs submission event'
                    WHEN signed_count > 0 THEN 'Applied and signed without docs submission'
                    WHEN rejected_count = 0 THEN 'Applied but no docs submission (still pending?)'
                    ELSE 'Other pattern' END AS description,
               applied_count, docs_count, signed_count, rejected_count, first_applied, first_signed
        FROM (SELECT client_id, count(*) FILTER (event_type = 'applied') AS applied_count,
                     count(*) FILTER (event_type = 'docs_submitted') AS docs_count,
                     count(*) FILTER (event_type = 'signed') AS signed_count,
                     count(*) FILTER (event_type = 'rejected') AS rejected_count,
                     min(event_date) FILTER (event_type = 'applied') AS first_applied,
                     min(event_date) FILTER (event_type = 'signed') AS first_signed
              FROM staged GROUP BY client_id HAVING applied_count > 0)""",
    "plan_changes": """
        SELECT client_id, 'plan_inconsistency' AS inconsistency_type,
               'Client has multiple different plans across events' AS description,
               count(DISTINCT plan) AS unique_plans,
               string_agg(DISTINCT plan, ',' ORDER BY plan) AS all_plans,
               min(event_date) AS first_event, max(event_date) AS last_event
        FROM staged GROUP BY client_id HAVING count(DISTINCT plan) > 1""",
    "distribution": """
        SELECT event_type, count(*) AS event_count, count(DISTINCT client_id) AS unique_clients,
               min(event_date) AS earliest_date, max(event_date) AS latest_date,
               round(avg(sales_rep_id), 2) AS avg_sales_rep_id,
               string_agg(DISTINCT plan, ',' ORDER BY plan) AS plans_involved,
               string_agg(DISTINCT region, ',' ORDER BY region) AS regions_involved
        FROM staged GROUP BY event_type""",
    "findings": """
        SELECT client_id, inconsistency_type, description, relevant_date, days_inactive,
               signed_count, churned_count, application_count, date_range_days, record_id,
               event_type, event_date, plan, sales_rep_id, region, marketing_channel,
               source_system, violation_type, first_applied_date, first_signed_date,
               first_docs_date, first_rejected_date, first_churned_date, applied_count, docs_count,
               rejected_count, first_applied, first_signed, unique_plans, all_plans, first_event,
               last_event
        FROM (SELECT * FROM churned_without_signed
              UNION ALL BY NAME SELECT * FROM long_inactive
              UNION ALL BY NAME SELECT * FROM signed_without_applied
              UNION ALL BY NAME SELECT * FROM multiple_applications
              UNION ALL BY NAME SELECT * FROM unknown_values
              UNION ALL BY NAME SELECT * FROM sequence
              UNION ALL BY NAME SELECT * FROM docs_pattern
              UNION ALL BY NAME SELECT * FROM plan_changes)""",
    "details": """
        SELECT client_id, record_id, event_type, event_date, plan, region, marketing_channel,
               sales_rep_id, source_system, event_rank
        FROM staged WHERE client_id IN (SELECT client_id FROM findings)""",
}

_NEEDS = {
    "raw": [],
    "filled": ["raw"],
    "staged": ["filled"],
    "funnel": ["staged"],
    "funnel_counts": ["funnel"],
    "metrics": ["funnel_counts"],
    "durations": ["funnel"],
    "last_events": ["staged"],
    "last_types": ["last_events", "staged"],
    "churn": ["last_types"],
    "risk": ["churn"],
    "summary": ["risk"],
    "multiple_applications": ["staged"],
    "signed_without_applied": ["staged"],
    "churned_without_signed": ["staged"],
    "long_inactive": ["staged"],
    "unknown_values": ["staged"],
    "sequence": ["funnel"],
    "docs_pattern": ["staged"],
    "plan_changes": ["staged"],
    "distribution": ["staged"],
    "findings": [
        "churned_without_signed",
        "long_inactive",
        "signed_without_applied",
        "multiple_applications",
        "unknown_values",
        "sequence",
        "docs_pattern",
        "plan_changes",
    ],
    "details": ["staged", "findings"],
}


def _with(needs: list[str], select: str) -> str:
    used: set[str] = set()
    todo = list(needs)
    while todo:
        name = todo.pop()
        if name not in used:
            used.add(name)
            todo += _NEEDS[name]
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _CTES.items() if name in used)
    return f"WITH {ctes}\n{select}"


def _all(name: str) -> str:
    return _with([name], f"SELECT * FROM {name}")


def _percent(rate: str) -> str:
    return f"printf('%.1f%%', {rate} * 100)"


def _histogram(source: str, column: str, where: str, bins: int) -> str:
    return f"""
        , vals AS (SELECT {column} AS v FROM {source} WHERE {where} AND {column} IS NOT NULL),
        lims AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
        binned AS (
            SELECT lo, hi, CAST(CASE WHEN hi > lo
                   THEN least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1})
                   ELSE 0 END AS INTEGER) AS bin
            FROM vals, lims)
        SELECT CAST(b AS INTEGER) AS bin, lo + b * ((hi - lo) / {bins}) AS bin_start,
               CASE WHEN b = {bins - 1} THEN hi ELSE lo + (b + 1) * ((hi - lo) / {bins}) END
                   AS bin_end,
               (SELECT count(*) FROM binned WHERE bin = b) AS clients
        FROM lims, range({bins}) AS r(b) WHERE lo IS NOT NULL"""


def _stage_rows(stages: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS stage, {column} AS clients FROM metrics" for label, column in stages
    )


_STAGES = [
    ("Applied", "applied_clients"),
    ("Docs Submitted", "docs_submitted_clients"),
    ("Rejected", "rejected_clients"),
    ("Signed", "signed_clients"),
    ("Churned", "churned_clients"),
    ("Active", "active_clients"),
]


def _scenario(condition: str) -> str:
    return f"(SELECT count(*) FROM findings WHERE {condition})"


def statements() -> dict[str, str]:
    """One statement per key of `queries()`."""
    sql: dict[str, str] = {}

    # Staging.
    sql["stage_cast"] = _with(
        ["raw"],
        """
        SELECT record_id,
               CASE WHEN record_id % 100 NOT IN (5, 15, 25) THEN client_id END AS client_id,
               event_type,
               CASE record_id % 100 WHEN 29 THEN event_date + INTERVAL 8 HOUR
                   WHEN 39 THEN event_date + INTERVAL 36000250 MILLISECOND
                   WHEN 49 THEN NULL ELSE CAST(event_date AS TIMESTAMP) END AS event_date,
               plan, region, marketing_channel,
               CASE WHEN record_id % 100 <> 17 THEN sales_rep_id END AS sales_rep_id,
               source_system
        FROM raw""",
    )
    sql["stage_unreadable"] = _with(
        ["raw"],
        """
        SELECT CAST(record_id AS VARCHAR) AS record_id, 'client_id' AS column_name,
               CASE record_id % 100 WHEN 5 THEN 'abc' WHEN 15 THEN client_id || '.5'
                   ELSE client_id || 'd' END AS value
        FROM raw WHERE record_id % 100 IN (5, 15, 25)
        UNION ALL SELECT CAST(record_id AS VARCHAR), 'sales_rep_id', sales_rep_id || 'f'
        FROM raw WHERE record_id % 100 = 17 AND sales_rep_id IS NOT NULL
        UNION ALL SELECT CAST(record_id AS VARCHAR), 'event_date',
               CASE WHEN event_date IS NULL THEN 'not-a-date' ELSE '2024' END
        FROM raw WHERE event_date IS NULL OR record_id % 100 = 49""",
    )
    sql["stage_date_order"] = _with(
        ["raw"],
        """
        , counts AS (
            SELECT count(*) FILTER (WHERE record_id % 100 = 9 AND day(event_date) > 12) AS month_first,
                   count(*) FILTER (WHERE record_id % 100 = 9 AND day(event_date) <= 12
                                    AND day(event_date) <> month(event_date)) AS ambiguous
            FROM raw)
        SELECT 'event_date' AS column_name, CAST(0 AS BIGINT) AS day_first, month_first, ambiguous,
               CASE WHEN month_first > 0 THEN 'month' END AS date_order
        FROM counts""",
    )
    sql["stage_fill"] = _all("filled")
    sql["staged_events"] = _all("staged")

    # Funnel.
    sql["client_funnel"] = _all("funnel")
    sql["funnel_metrics"] = _all("metrics")
    sql["funnel_overview"] = _with(["metrics"], _stage_rows(_STAGES))
    sql["funnel_waterfall"] = _with(
        ["metrics"], _stage_rows([("Total Clients", "total_clients"), *_STAGES])
    )
    sql["funnel_rates"] = _with(
        ["metrics"],
        " UNION ALL ".join(
            f"SELECT '{label}' AS rate_type, {rate} * 100 AS percentage, "
            f"{_percent(rate)} AS label FROM metrics"
            for label, rate in [
                ("Application Rate", "application_rate"),
                ("Docs Submission Rate", "docs_submission_rate"),
                ("Rejection Rate", "rejection_rate"),
                ("Conversion Rate", "conversion_rate"),
                ("Churn Rate", "churn_rate"),
            ]
        ),
    )
    shares = [
        ("Applied Clients", "applied_clients", "application_rate"),
        ("Docs Submitted", "docs_submitted_clients", "docs_submission_rate"),
        ("Rejected Clients", "rejected_clients", "rejection_rate"),
        ("Signed Clients", "signed_clients", "conversion_rate"),
        ("Churned Clients", "churned_clients", "churn_rate"),
    ]
    sql["funnel_summary"] = _with(
        ["metrics"],
        " UNION ALL ".join(
            [
                "SELECT 'Total Clients' AS metric, "
                "CAST(total_clients AS VARCHAR) AS value FROM metrics",
                *[
                    f"SELECT '{label}', {n} || ' (' || {_percent(rate)} || ')' FROM metrics"
                    for label, n, rate in shares
                ],
                "SELECT 'Active Clients', CAST(active_clients AS VARCHAR) FROM metrics",
                f"SELECT 'Success Rate: Applied → Signed', {_percent('conversion_rate')} "
                "FROM metrics",
                f"SELECT 'Retention Rate: Signed → Active', {_percent('(1 - churn_rate)')} "
                "FROM metrics",
            ]
        ),
    )
    sql["funnel_insights"] = _with(
        ["metrics"],
        """SELECT conversion_rate, 1 - conversion_rate AS drop_off_rate, churn_rate,
                  1 - churn_rate AS retention_rate FROM metrics""",
    )
    sql["stage_durations"] = _all("durations")
    sql["stage_duration_stats"] = _with(
        ["durations"],
        """SELECT stage, count(*) AS clients, min(days) AS min_days,
                  quantile_cont(days, 0.25) AS q1_days, quantile_cont(days, 0.5) AS median_days,
                  quantile_cont(days, 0.75) AS q3_days, max(days) AS max_days
           FROM durations GROUP BY stage""",
    )
    sql["journey_types"] = _with(
        ["funnel"],
        """SELECT CASE
                  WHEN rejected_date IS NOT NULL THEN 'Rejected (Applied → Rejected)'
                  WHEN churned_date IS NOT NULL AND docs_submitted_date IS NOT NULL
                       THEN 'Full Journey with Docs (Applied → Docs → Signed → Churned)'
                  WHEN churned_date IS NOT NULL THEN 'Full Journey (Applied → Signed → Churned)'
                  WHEN signed_date IS NOT NULL AND docs_submitted_date IS NOT NULL
                       THEN 'Active with Docs (Applied → Docs → Signed)'
                  WHEN signed_date IS NOT NULL THEN 'Active Client (Applied → Signed)'
                  WHEN docs_submitted_date IS NOT NULL THEN 'Docs Submitted (Applied → Docs)'
                  WHEN applied_date IS NOT NULL THEN 'Applied Only (No Progress)'
                  ELSE 'Other' END AS journey_type, count(*) AS clients
           FROM funnel GROUP BY 1""",
    )
    sql["funnel_client_table"] = _with(
        ["funnel"],
        "SELECT CAST(client_id AS VARCHAR) AS client_id, "
        + ", ".join(
            f"coalesce(strftime({c}, '%Y-%m-%d'), '-') AS {c}"
            for c in [
                "applied_date",
                "docs_submitted_date",
                "rejected_date",
                "signed_date",
                "churned_date",
            ]
        )
        + """, coalesce(CAST(CAST(floor(date_diff('microsecond', applied_date, signed_date)
                 / 86400000000.0) AS INTEGER) AS VARCHAR), '-') AS days_to_sign,
             coalesce(CAST(CAST(floor(date_diff('microsecond', signed_date, churned_date)
                 / 86400000000.0) AS INTEGER) AS VARCHAR), '-') AS days_to_churn
           FROM funnel""",
    )
    sql["funnel_monthly"] = _with(
        ["funnel"],
        """SELECT month, coalesce(applications, 0) AS applications,
                  coalesce(conversions, 0) AS conversions
           FROM (SELECT strftime(applied_date, '%Y-%m') AS month, count(*) AS applications
                 FROM funnel WHERE applied_date IS NOT NULL GROUP BY 1)
           FULL JOIN (SELECT strftime(signed_date, '%Y-%m') AS month, count(*) AS conversions
                      FROM funnel WHERE applied_date IS NOT NULL AND signed_date IS NOT NULL
                      GROUP BY 1) USING (month)""",
    )

    # Churn.
    sql["churn_last_events"] = _all("last_events")
    sql["churn_last_type"] = _all("last_types")
    sql["churn_last_type_dedup"] = _with(
        ["last_events", "staged"],
        """SELECT l.*, s.event_type AS last_event_type
           FROM last_events l
           JOIN (SELECT client_id, event_type, row_number() OVER (PARTITION BY client_id
                        ORDER BY event_date DESC, record_id DESC) AS n FROM staged) s
             ON l.client_id = s.client_id AND s.n = 1""",
    )
    sql["client_churn"] = _all("churn")
    sql["client_risk"] = _all("risk")
    sql["churn_summary"] = _all("summary")
    labels = [
        ("Total Clients", "total_clients"),
        ("Clients Churned", "churned_clients"),
        ("Clients in Risk of Churn", "at_risk_clients"),
        ("High Risk (>60 days)", "high_risk_clients"),
        ("Medium Risk (31-60 days)", "medium_risk_clients"),
        ("Low Risk (≤30 days)", "low_risk_clients"),
        ("Unknown Risk", "unknown_risk_clients"),
    ]
    sql["churn_summary_table"] = _with(
        ["summary"],
        " UNION ALL ".join(
            [
                *[
                    f"SELECT '{label}' AS metric, CAST({c} AS VARCHAR) AS value FROM summary"
                    for label, c in labels
                ],
                "SELECT 'Avg Days Since Last Event (Active)', "
                "printf('%.1f', avg_days_active) FROM summary",
                "SELECT 'Churn Rate', printf('%.1f%%', churned_percentage) FROM summary",
            ]
        ),
    )
    sql["churn_insights"] = _with(
        ["summary"],
        """SELECT churned_clients, at_risk_clients, high_risk_clients,
                  churned_percentage AS churn_rate,
                  at_risk_clients / total_clients * 100 AS at_risk_percentage,
                  high_risk_clients / total_clients * 100 AS high_risk_percentage,
                  avg_days_active
           FROM summary""",
    )
    sql["churned_vs_at_risk"] = _with(
        ["summary"],
        """SELECT 'Clients Churned' AS category, churned_clients AS clients FROM summary
           UNION ALL SELECT 'Clients in Risk of Churn', at_risk_clients FROM summary""",
    )
    sql["risk_distribution"] = _with(
        ["risk"],
        """SELECT risk_category, count(*) AS clients FROM risk
           WHERE risk_category <> 'Already Churned' GROUP BY risk_category""",
    )
    sql["idle_histogram"] = _with(
        ["risk"],
        _histogram("risk", "days_since_last_event", "risk_category <> 'Already Churned'", 30),
    )
    sql["signed_histogram"] = _with(["churn"], _histogram("churn", "days_since_signed", "true", 25))
    sql["churn_client_table"] = _with(
        ["risk"],
        "SELECT CAST(client_id AS VARCHAR) AS client_id, "
        + ", ".join(
            f"coalesce(strftime({c}, '%Y-%m-%d'), '-') AS {c}"
            for c in ["applied_date", "signed_date", "last_event_date", "churned_date"]
        )
        + """, coalesce(CAST(CAST(trunc(days_since_last_event) AS BIGINT) AS VARCHAR), '-')
                   AS days_since_last_event,
               coalesce(CAST(CAST(trunc(days_since_signed) AS BIGINT) AS VARCHAR), '-')
                   AS days_since_signed,
               last_event_type, risk_category
           FROM risk""",
    )
    sql["last_event_monthly"] = _with(
        ["churn"],
        """SELECT strftime(last_event_date, '%Y-%m') AS month, count(*) AS last_events
           FROM churn GROUP BY 1""",
    )
    sql["risk_by_region"] = _with(
        ["risk", "staged"],
        """SELECT region,
                  count(*) FILTER (risk_category = 'High Risk') AS high_risk,
                  count(*) FILTER (risk_category = 'Medium Risk') AS medium_risk,
                  count(*) FILTER (risk_category = 'Low Risk') AS low_risk,
                  count(*) FILTER (risk_category = 'Already Churned') AS already_churned,
                  count(*) FILTER (risk_category = 'Unknown') AS "unknown"
           FROM risk JOIN (SELECT client_id, region, row_number() OVER (PARTITION BY client_id
                                  ORDER BY event_date DESC, record_id DESC) AS n FROM staged) s
             USING (client_id)
           WHERE s.n = 1 AND region IS NOT NULL GROUP BY region""",
    )

    # Checks.
    sql["chk_multiple_applications"] = _all("multiple_applications")
    sql["chk_signed_without_applied"] = _all("signed_without_applied")
    sql["chk_churned_without_signed"] = _all("churned_without_signed")
    sql["chk_long_inactive"] = _all("long_inactive")
    sql["chk_unknown_values"] = _all("unknown_values")
    sql["chk_unknown_values_strict"] = _with(
        ["staged"],
        """SELECT client_id, record_id, event_type, event_date,
                  'unknown_values' AS inconsistency_type, reason AS description,
                  plan, sales_rep_id, region, marketing_channel, source_system
           FROM (SELECT *, coalesce(
                   if(plan = 'Unknown', 'Plan field has Unknown value', NULL),
                   if(sales_rep_id = -1, 'Sales rep ID is -1 (missing/unknown)', NULL),
                   if(coalesce(region, 'unknown') IN ('', 'unknown'),
                      'Region field is missing', NULL),
                   if(marketing_channel IN ('', 'unknown'), 'Marketing channel is missing', NULL),
                   if(source_system IN ('', 'unknown'), 'Source system is missing', NULL)) AS reason
                 FROM staged)
           WHERE reason IS NOT NULL""",
    )
    sql["chk_sequence"] = _all("sequence")
    sql["chk_docs_pattern"] = _all("docs_pattern")
    sql["chk_plan_changes"] = _all("plan_changes")
    sql["docs_events"] = _with(
        ["staged"],
        """SELECT client_id, event_date AS docs_submitted_date, plan, region, marketing_channel,
                  sales_rep_id, source_system
           FROM staged WHERE event_type = 'docs_submitted'""",
    )
    sql["event_distribution"] = _all("distribution")
    days = """, days AS (
        SELECT * FROM staged
        WHERE event_date >= TIMESTAMP '2024-01-15' AND event_date < TIMESTAMP '2024-03-01')"""
    distribution = _CTES["distribution"].replace("FROM staged", "FROM days")
    first_dates = _CTES["funnel"].replace("FROM staged WHERE event_rank = 1", "FROM days")
    sql["daily_distribution"] = _with(["staged"], f"{days} {distribution}")
    sql["daily_stage_duration_stats"] = _with(
        ["staged"],
        f"""{days}, funnel AS ({first_dates}), durations AS ({_CTES["durations"]})
            SELECT stage, count(*) AS clients, min(days) AS min_days,
                   quantile_cont(days, 0.25) AS q1_days, quantile_cont(days, 0.5) AS median_days,
                   quantile_cont(days, 0.75) AS q3_days, max(days) AS max_days
            FROM durations GROUP BY stage""",
    )
    sql["inconsistencies"] = _all("findings")
    sql["inconsistency_counts"] = _with(
        ["findings"],
        "SELECT inconsistency_type, count(*) AS cases FROM findings GROUP BY inconsistency_type",
    )
    sql["client_event_details"] = _all("details")

    # Data-quality report.
    sql["unknown_reason_counts"] = _with(
        ["unknown_values"],
        "SELECT description, count(*) AS records FROM unknown_values GROUP BY description",
    )
    sql["violation_points"] = _with(
        ["sequence"],
        """SELECT client_id, violation_type, 'Applied' AS event, first_applied_date AS event_date
           FROM sequence WHERE first_applied_date IS NOT NULL
           UNION ALL SELECT client_id, violation_type, 'Signed', first_signed_date
           FROM sequence WHERE first_signed_date IS NOT NULL""",
    )
    sql["docs_pattern_counts"] = _with(
        ["docs_pattern"],
        "SELECT description, count(*) AS clients FROM docs_pattern GROUP BY description",
    )
    sql["application_spread"] = _with(
        ["multiple_applications"],
        "SELECT client_id, application_count, date_range_days FROM multiple_applications",
    )
    sql["event_type_counts"] = _with(
        ["distribution"], "SELECT event_type, event_count, unique_clients FROM distribution"
    )
    unknown = _scenario("inconsistency_type = 'unknown_values'")
    sequence = _scenario("inconsistency_type = 'sequence_violation'")
    has_docs = _scenario("description = 'Has docs submission event'")
    without_docs = _scenario("description = 'Applied and signed without docs submission'")
    multiple = _scenario("inconsistency_type = 'Q1_multiple_applications'")
    sql["scenario_summary"] = _with(
        ["findings"],
        f"""SELECT 'Scenario 1: Unknown Values' AS scenario, {unknown} AS cases,
                   'Records with missing/unknown field values' AS description
            UNION ALL SELECT 'Scenario 2: Date Sequence Violations', {sequence},
                   'Events in wrong chronological order'
            UNION ALL SELECT 'Scenario 3a: Has Document Submission', {has_docs},
                   'Clients who submitted documents'
            UNION ALL SELECT 'Scenario 3b: Missing Document Submission', {without_docs},
                   'Clients signed without docs submission'
            UNION ALL SELECT 'Scenario 4: Multiple Applications', {multiple},
                   'Clients with multiple application events'""",
    )
    sql["scenario_insights"] = _with(
        ["findings", "staged"],
        f"""SELECT {unknown} AS unknown_records, {sequence} AS sequence_clients,
                   {has_docs} AS docs_clients, {without_docs} AS signed_without_docs_clients,
                   {multiple} AS multiple_application_clients, docs_events, applied_events,
                   CASE WHEN applied_events > 0 THEN docs_events / applied_events ELSE 0.0 END
                       AS docs_rate
            FROM (SELECT count(*) FILTER (event_type = 'docs_submitted') AS docs_events,
                         count(*) FILTER (event_type = 'applied') AS applied_events FROM staged)""",
    )
    sql["problem_events"] = _with(
        ["unknown_values", "sequence", "multiple_applications", "docs_pattern"],
        """SELECT CAST(client_id AS VARCHAR) AS client_id, 'Unknown Values' AS issue_type,
                  event_type AS event_details, strftime(event_date, '%Y-%m-%d') AS date_info,
                  plan AS additional_info, CAST(sales_rep_id AS VARCHAR) AS sales_rep, description
           FROM unknown_values
           UNION ALL
           SELECT CAST(client_id AS VARCHAR), 'Sequence Violation',
                  CASE violation_type WHEN 'signed_before_applied' THEN 'Signed Before Applied'
                       WHEN 'docs_submitted_before_applied' THEN 'Docs Submitted Before Applied'
                       WHEN 'rejected_before_applied' THEN 'Rejected Before Applied'
                       ELSE 'Churned Before Signed' END,
                  'Applied: ' || coalesce(strftime(first_applied_date, '%Y-%m-%d'), '-')
                      || ', Signed: ' || coalesce(strftime(first_signed_date, '%Y-%m-%d'), '-'),
                  '-', '-', description
           FROM sequence
           UNION ALL
           SELECT CAST(client_id AS VARCHAR), 'Multiple Applications',
                  application_count || ' applications', strftime(relevant_date, '%Y-%m-%d'),
                  date_range_days || ' days', '-', description
           FROM multiple_applications
           UNION ALL
           SELECT CAST(client_id AS VARCHAR), 'Document Pattern',
                  'Applied: ' || applied_count || ', Docs: ' || docs_count
                      || ', Signed: ' || signed_count,
                  'Applied: ' || coalesce(strftime(first_applied, '%Y-%m-%d'), '-'),
                  'Signed: ' || coalesce(strftime(first_signed, '%Y-%m-%d'), '-'), '-', description
           FROM docs_pattern""",
    )
    sql["question_counts"] = _with(
        ["findings"],
        """SELECT CASE inconsistency_type
                  WHEN 'Q1_multiple_applications' THEN 'Q1: Multiple applied events'
                  WHEN 'Q2_signed_without_applied' THEN 'Q2: Signed without applying'
                  WHEN 'Q3_churned_without_signed' THEN 'Q3: Churned without signing'
                  WHEN 'Q6_long_inactive_unsigned' THEN 'Q6: Long inactive unsigned'
                  ELSE 'Unknown: ' || inconsistency_type END AS business_question,
                  count(*) AS cases
           FROM findings GROUP BY 1""",
    )
    sql["severity_counts"] = _with(
        ["findings"],
        """SELECT CASE inconsistency_type WHEN 'Q1_multiple_applications' THEN 'Medium'
                  WHEN 'Q6_long_inactive_unsigned' THEN 'Low' ELSE 'High' END AS severity,
                  count(*) AS cases
           FROM findings WHERE inconsistency_type LIKE 'Q%' GROUP BY 1""",
    )
    sql["affected_monthly"] = _with(
        ["details"],
        """SELECT strftime(event_date, '%Y-%m') AS month, count(*) AS events
           FROM details GROUP BY 1""",
    )
    sql["affected_sample"] = _with(
        ["details"],
        """SELECT CAST(client_id AS VARCHAR) AS client_id, event_type,
                  strftime(event_date, '%Y-%m-%d') AS event_date
           FROM details ORDER BY details.client_id, details.event_date, record_id LIMIT 10""",
    )
    return sql
