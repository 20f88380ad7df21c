from dayguard.functions.columns import (
    valid_customer, days_between, ts_in_days, hash_unit, hash_unit_sql, safe_ratio,
)

__all__ = ["valid_customer", "days_between", "ts_in_days", "hash_unit",
           "hash_unit_sql", "safe_ratio"]
