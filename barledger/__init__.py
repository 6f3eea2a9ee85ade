"""Daily market tables on Spark: audit, admission, coverage, reconciliation and analysis."""
