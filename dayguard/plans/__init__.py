"""End-to-end plans (feature job, labels, preparation, models, evaluation)
and the DuckDB oracle statements used by the correctness check."""
