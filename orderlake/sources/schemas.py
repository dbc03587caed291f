"""Declared schemas of the five source files (no inference, all nullable).

Order and names are fixed: the CSV reader maps columns by position, so a
header ``order date`` lands in ``order_date_raw``.
"""

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


CUSTOMER_SCHEMA = _strings("cust_id", "created_at", "country", "region", "type",
                           "zip", "active")
ORDERS_SCHEMA = _strings("order_id", "cust_id", "order_date_raw", "prod_id",
                         "quantity_raw", "status")
PRODUCT_SCHEMA = _strings("prod_id", "cat_id", "prod_name", "price", "currency")
CATEGORY_SCHEMA = _strings("cat_id", "child", "parent")
FX_SCHEMA = StructType([
    StructField("date", StringType(), True),
    StructField("currency", StringType(), True),
    StructField("conversion", DoubleType(), True),
])
# FX rows with an explicit write sequence, used when the feed carries one.
FX_SEQ_SCHEMA = StructType(FX_SCHEMA.fields + [StructField("seq", LongType(), True)])
