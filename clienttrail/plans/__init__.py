from clienttrail.plans.jobs import (
    run_churn,
    run_churn_report,
    run_client_layers,
    run_daily_parts,
    run_daily_report,
    run_funnel,
    run_funnel_report,
    run_inconsistencies,
    run_inconsistencies_report,
    run_parse,
    run_rank,
    run_staging,
)

__all__ = [
    "run_churn",
    "run_churn_report",
    "run_client_layers",
    "run_daily_parts",
    "run_daily_report",
    "run_funnel",
    "run_funnel_report",
    "run_inconsistencies",
    "run_inconsistencies_report",
    "run_parse",
    "run_rank",
    "run_staging",
]
