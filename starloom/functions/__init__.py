"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from starloom.functions.scalar import (
    age_years,
    age_band,
    concat_nullsafe,
    hash_int,
    hash_random,
    money,
    net_amount,
    pct_round,
    round_ratio,
    avg_round,
    to_double_money,
    year_month,
)

__all__ = [
    "age_band",
    "age_years",
    "concat_nullsafe",
    "hash_int",
    "hash_random",
    "money",
    "net_amount",
    "pct_round",
    "round_ratio",
    "avg_round",
    "to_double_money",
    "year_month",
]
