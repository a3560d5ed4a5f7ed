"""Query plans: each registered key is a Spark builder (spark, sf_dir) -> DataFrame plus,
where SQL can express it, the equivalent DuckDB SQL over the driver's tables."""

from ledgerline.plans.registry import oracle_sql, queries  # noqa: F401
