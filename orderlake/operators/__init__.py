"""Reusable DataFrame operators (keys and columns are parameters)."""

from orderlake.operators.dedup import (  # noqa: F401
    exact_dedup, keep_one_per_key, last_write_wins)
from orderlake.operators.hierarchy import resolve_top_category  # noqa: F401
from orderlake.operators.joins import broadcast_if_small  # noqa: F401
from orderlake.operators.quality import (  # noqa: F401
    QualityGateError, check_nulls, check_row_count, classify_orders, null_profile,
    quarantine_counts, tag_quarantine)
from orderlake.operators.timeseries import (  # noqa: F401
    calendar_spine, date_bounds, fill_daily_rates, forward_fill, latest_value_per_series)
