"""Customer-lifecycle analytics on Spark: staging, funnel, churn and quality checks."""
