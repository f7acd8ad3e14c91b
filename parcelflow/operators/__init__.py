"""Relational building blocks shared by the models."""

from parcelflow.operators.relational import (  # noqa: F401
    add_unknown_member, anti_join, first_per_key, hot_keys,
    latest_per_key, median_by, median_in_buckets, median_of, salted_lookup_join, top_k, unpivot,
    value_histogram,
)
