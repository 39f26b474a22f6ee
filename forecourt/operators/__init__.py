from forecourt.operators.clean import (
    clean,
    gold_valid,
    silver_valid,
    staging,
    staging_sql,
    with_log_price,
)
from forecourt.operators.dedup import latest_per_key
from forecourt.operators.profile import price_profile
from forecourt.operators.quality import ChecksFailed, checks, enforce, failing_rows
from forecourt.operators.select import exact_medians
from forecourt.operators.sketch import distinct_estimates, distinct_sketches
from forecourt.operators.upsert import upsert
from forecourt.operators.validate import accepted, classify, produce_metrics, quarantine

__all__ = [
    "ChecksFailed",
    "accepted",
    "checks",
    "classify",
    "clean",
    "distinct_estimates",
    "distinct_sketches",
    "enforce",
    "exact_medians",
    "failing_rows",
    "gold_valid",
    "latest_per_key",
    "price_profile",
    "produce_metrics",
    "quarantine",
    "silver_valid",
    "staging",
    "staging_sql",
    "upsert",
    "with_log_price",
]
