"""Names, labels and formats shared by the operators.

Fixed values: these must equal the source pipeline's values for results to
match; they are listed here once, in natural order.
"""

# --- fixed values: quarantine codes and messages -------------------------
NULL_CUST_ID = "NULL_CUST_ID"
INVALID_QTY = "INVALID_QTY"
ERROR_MESSAGES = {
    NULL_CUST_ID: (
        "No customer ID. Order cannot be linked to any customer, "
        "region, or segment. Excluded from all business metrics."),
    INVALID_QTY: (
        "Quantity is fractional (0.1). Rounding up or down would "
        "fabricate revenue. Excluded from all revenue metrics."),
}
# opt-in code for rows whose quantity is missing or unparseable (off by default)
MISSING_QTY = "MISSING_QTY"
MISSING_QTY_MESSAGE = "Quantity is missing or not a number."
# lines of a file feed that do not fit the declared columns
MALFORMED = "MALFORMED_LINE"
MALFORMED_MESSAGE = "The line does not have the declared columns."

# --- fixed values: product currency note ---------------------------------
CURRENCY_NOTE = "Mixed case. Normalised to uppercase in transform stage"

# --- fixed values: FX fill provenance labels ------------------------------
FILL_ACTUAL = "actual"
FILL_FORWARD = "forward_filled"
FILL_NONE = "no_rate_available"

# --- fixed values: metric labels ------------------------------------------
MULTI_LINE_FLAG = "multi_line_order"
STATUS_ACTIVE = "active"
STATUS_INACTIVE = "inactive"
HEADLINE_CATEGORY = "sweet"
TOP_N_PRODUCTS = 3
CATEGORY_ROOT_MARKER = "all"

# --- fixed values: text formats of the sources ----------------------------
US_DATE = "M/d/yyyy"
US_TIMESTAMP = "M/d/yyyy H:mm"
ISO_DATE = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
MONTH_NAME_FORMAT = "MMMM"
DAY_NAME_FORMAT = "EEEE"

# --- fixed values: layer labels of audit records that differ from the layer name
AUDIT_LAYERS = {"error_tables": "ERROR"}

# --- pipeline identity ------------------------------------------------------
PIPELINE_NAME = "ecommerce_etl"
PIPELINE_VERSION = "1.0.0"

# --- money types (exact decimal arithmetic) ---------------------------------
# Digits kept after the point.  Seven significant digits of a rate stay down to
# 1e-8; amounts beyond MONEY_TYPE become NULL and reach the null gates.
PRICE_SCALE = 6
RATE_SCALE = 14
MONEY_SCALE = 4
MONEY_TYPE = "decimal(24,4)"
