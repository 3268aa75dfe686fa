"""Column-level helpers (pure ``pyspark.sql.functions`` expressions)."""

from encore.functions.columns import (
    hash_order_key, split_rule, damped_mean, weighted_popularity, ideal_dcg, rounded,
)

__all__ = ["hash_order_key", "split_rule", "damped_mean", "weighted_popularity", "ideal_dcg", "rounded"]
