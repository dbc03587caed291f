"""Readers for the source files and the driver test tables."""

from orderlake.sources.readers import (  # noqa: F401
    read_csv_source, read_json_array, read_json_source, read_table, with_sequence, with_write_order)
from orderlake.sources.schemas import (  # noqa: F401
    CATEGORY_SCHEMA, CUSTOMER_SCHEMA, FX_SCHEMA, ORDERS_SCHEMA, PRODUCT_SCHEMA)
from orderlake.sources.files import read_feeds  # noqa: F401,E402
