"""Relational building blocks shared by the products."""

from usagelens.operators.counting import KEYS, RECORDS, first_by, per_key_counts, per_name_counts
from usagelens.operators.lookups import dedupe_catalogue, lookup
from usagelens.operators.ranking import merge_ranks, top_and_least, top_k

__all__ = [
    "KEYS", "RECORDS", "first_by", "per_key_counts", "per_name_counts",
    "dedupe_catalogue", "lookup",
    "merge_ranks", "top_and_least", "top_k",
]
