"""Status-flow analytics on Spark: intervals, cycles, outcomes and reconciliation of change logs."""
