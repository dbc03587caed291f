
import datetime as dt

from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.functions import parse_us_timestamp
from orderlake.operators import quality
from orderlake.plans import bronze, silver
from orderlake.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_h12_unknown_product_lines_drop_out(spark):
    orders = spark.createDataFrame(
        [("A-1", 1, 10, dt.date(2020, 1, 1), 2, "paid"), ("A-1", 1, 99, dt.date(2020, 1, 1), 1, "paid")],
        "order_id string, cust_id long, prod_id long, order_date date, quantity int, status string"
    ).withColumn("order_timestamp", F.col("order_date").cast("timestamp_ntz"))
    products = spark.createDataFrame(
        [(10, 1, "toffee", 2.5, "USD", "candy", "Sweet")],
        "prod_id long, cat_id int, prod_name string, price double, currency string, "
        "category_name string, top_category string")
    fx = spark.createDataFrame([(dt.date(2020, 1, 1), "USD", 1.0, K.FILL_ACTUAL)],
                               "rate_date date, currency string, rate_to_usd double, "
                               "_fx_fill_method string")
    items = silver.order_items(orders, products, fx)
    assert [(r.prod_id, float(r.revenue_usd)) for r in items.collect()] == [(10, 5.0)]
    missing = orders.join(products, "prod_id", "left_anti").count()
    assert missing == 1                                   # reportable with an anti join


def test_h13_every_status_is_kept_and_normalised(spark):
    raw = spark.createDataFrame(
        [("A-1", "1", "1/1/2020 0:00", "2", "1", " Shipped"),
         ("A-2", "1", "1/1/2020 0:00", "2", "1", "PAID"),
         ("A-3", "1", "1/1/2020 0:00", "2", "1", "created "),
         ("A-4", "1", "1/1/2020 0:00", "2", "1", "cancelled")],
        "order_id string, cust_id string, order_date_raw string, prod_id string, "
        "quantity_raw string, status string")
    got = sorted(r.status for r in silver.orders(raw).collect())
    assert got == ["cancelled", "created", "paid", "shipped"]


def test_h19_wall_clock_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("3/10/2019 0:30",)], "t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        seen = []
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            seen.append(df.select(parse_us_timestamp("t").alias("ts")).first().ts)
        assert seen == [dt.datetime(2019, 3, 10, 0, 30)] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_h20_currency_note_compares_untrimmed_values(spark):
    raw = spark.createDataFrame([("1", "Yen"), ("2", " YEN"), ("3", "USD")],
                                "prod_id string, currency string")
    notes = {r.prod_id: r._currency_note for r in bronze.flag_currency_case(raw).collect()}
    assert notes == {"1": K.CURRENCY_NOTE, "2": None, "3": None}


def test_conservation_on_the_fixture(spark):
    raw = fixtures.raw_orders(spark, SF)
    c = bronze.classified_orders(raw)
    r = quality.conservation(c).first()
    clean = bronze.clean_orders(c).count()
    assert r.raw_rows == 6102 and r.quarantined_rows == 192 and r.unclassified_rows == 0
    assert r.clean_rows - clean == 103                     # exact copies collapsed
    assert clean + r.quarantined_rows + (r.clean_rows - clean) == r.raw_rows
