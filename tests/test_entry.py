"""The driver contract: entry, queries, oracle_sql."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SURVEY_KEYS = """agg_avg_revenue agg_collect_set agg_count_distinct agg_date_bounds
agg_latest_rate agg_sum_qty agg_sum_revenue audit_records calendar_spine case_activity_flag
cast_typed_orders category_rollup category_totals clean_orders currency_case_note
customer_tenure date_key dim_customer dim_date dim_product distinct_dates earliest_per_key
exact_dedup fact_orders filter_blank_key filter_fractional_qty fx_fill_flag fx_forward_fill
having_multi_line join_fx_by_date join_orders_products join_product_category last_write_wins
latest_per_key layer_row_counts metric_category_sales metric_customer_value
metric_daily_active metric_order_audit metric_top_products null_profile order_items
parse_iso_date parse_us_date parse_us_timestamp quarantine_counts quarantine_rows revenue_usd
row_counts scalar_string_clean scan_csv scan_json scan_table silver_customer silver_orders
silver_product""".split()
# Second ways of an operator in that list.
MORE_KEYS = {"scan_json_array"}


def _entry_module():
    spec = importlib.util.spec_from_file_location("__spark_entry__",
                                                  os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_keys_cover_the_inventory():
    mod = _entry_module()
    q, sql = mod.queries(), mod.oracle_sql()
    assert len(SURVEY_KEYS) == 56
    assert set(SURVEY_KEYS) <= set(q)
    assert set(SURVEY_KEYS) <= set(sql) <= set(q)
    assert MORE_KEYS <= set(sql)
    # what else is registered belongs to the corpus operators, which can be left out
    assert all(k == "pipeline" or k.startswith("op")
               for k in set(q) - set(SURVEY_KEYS) - MORE_KEYS)


def test_entry_runs_with_a_stable_schema(spark):
    df = _entry_module().entry(spark)
    assert [f.name for f in df.schema.fields] == ["order_date", "region", "active_users"]
    assert df.count() > 0
