"""The five source files of a feed folder, read under their declared schemas.

    customer.csv  orders.csv  product.csv  prod_cat_tree.csv  currency_conversion.json

Every frame carries ``_source_file`` (the file each row came from).  The FX
file is a JSON array, read in splits; its rows are numbered at the scan and ordered
by file and block, so "last written row wins" holds for repeated (date, currency)
entries of one file or of several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.quality import CORRUPT
from orderlake.sources.readers import (
    read_csv_source, read_json_array, read_json_source, with_write_order)
from orderlake.sources.schemas import (
    CATEGORY_SCHEMA, CUSTOMER_SCHEMA, FX_SCHEMA, ORDERS_SCHEMA, PRODUCT_SCHEMA)

FILES = {
    "customers": ("customer.csv", CUSTOMER_SCHEMA),
    "orders": ("orders.csv", ORDERS_SCHEMA),
    "products": ("product.csv", PRODUCT_SCHEMA),
    "categories": ("prod_cat_tree.csv", CATEGORY_SCHEMA),
}
FX_FILE = "currency_conversion.json"


def _with_file(df: DataFrame) -> DataFrame:
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def read_feeds(spark: SparkSession, folder: str, fx_multi_line: bool = True,
               fx_split: bool = True) -> dict[str, DataFrame]:
    """The five feeds.  CSV lines that do not have the declared columns keep their
    text in ``quality.CORRUPT`` and are quarantined.

    ``fx_multi_line=False`` reads the FX file as JSON Lines; ``fx_split=False`` reads
    an array that ``read_json_array`` refuses (braces in texts) as one document.
    """
    folder = folder.rstrip("/")
    feeds = {name: _with_file(read_csv_source(
                 spark, f"{folder}/{fname}", schema, corrupt_column=CORRUPT))
             for name, (fname, schema) in FILES.items()}
    path = f"{folder}/{FX_FILE}"
    fx = read_json_array(spark, path, FX_SCHEMA) if fx_multi_line and fx_split \
        else read_json_source(spark, path, FX_SCHEMA, multi_line=fx_multi_line)
    feeds["fx_rates"] = with_write_order(_with_file(fx), "seq")
    return feeds
