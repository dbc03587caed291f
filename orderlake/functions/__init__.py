"""Column-level helpers: pure ``pyspark.sql.functions`` expressions.

Everything here returns a ``Column`` so Catalyst keeps it inside whole-stage
codegen; nothing calls Python per row.
"""

from orderlake.functions.calendar import (  # noqa: F401
    date_key, day_name, is_weekend, month_name)
from orderlake.functions.money import (  # noqa: F401
    line_revenue, money, money_avg, price_at_rate, round_money)
from orderlake.functions.parsing import (  # noqa: F401
    parse_iso_date, parse_us_date, parse_us_timestamp, to_bigint, to_double_num,
    to_whole_int, yes_no_flag)
from orderlake.functions.text import clean_lower, clean_upper, has_lower_case, is_blank  # noqa: F401
