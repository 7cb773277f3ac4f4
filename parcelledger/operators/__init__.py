"""Relational building blocks shared by the report pipelines."""

from parcelledger.operators.aggregate import concat_notes, sum_when
from parcelledger.operators.dedup import earliest_by, latest_by, pick_first
from parcelledger.operators.filters import on_days, recent, recent_months, since
from parcelledger.operators.hot_groups import ranked_with_totals, running_sums
from parcelledger.operators.lookups import decode, fallback, lookup, tier_lookup
from parcelledger.operators.quality import (
    differing_buckets,
    duplicate_keys,
    find_differences,
    observe_unreadable,
    reconcile,
    unreadable_values,
)
from parcelledger.operators.upsert import merge_upsert, merged_rows

__all__ = [
    "concat_notes",
    "decode",
    "differing_buckets",
    "duplicate_keys",
    "earliest_by",
    "fallback",
    "find_differences",
    "latest_by",
    "lookup",
    "merge_upsert",
    "merged_rows",
    "observe_unreadable",
    "on_days",
    "pick_first",
    "ranked_with_totals",
    "recent",
    "recent_months",
    "reconcile",
    "running_sums",
    "since",
    "sum_when",
    "tier_lookup",
    "unreadable_values",
]
