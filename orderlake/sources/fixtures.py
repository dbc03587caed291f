"""Source-shaped frames derived from the driver's test tables.

The pipeline expects five raw feeds (customers, orders, products, category
tree, FX rates) as text.  These functions derive them from the TPC-H-like
tables under ``sf_dir`` with plain Spark expressions, injecting the defects
the cleaning stage must handle: missing and blank customer ids, fractional
quantities, exact duplicate rows, mixed-case currency codes, duplicate FX
writes and a one-year FX gap.  Every frame grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.joins import deal_by_size
from orderlake.session import input_bytes
from orderlake.sources.literals import literal_frame
from orderlake.sources.schemas import CATEGORY_SCHEMA

# Fixed values of the test fixture: product types mapped to leaf categories
# (cat_id, child, parent), and the two roots whose parent marker is "all".
LEAF_CATEGORIES = [
    ("1", "ECONOMY", "Sweet"),
    ("2", "LARGE", "Sweet"),
    ("3", "MEDIUM", "Sweet"),
    ("4", "PROMO", "salt"),
    ("5", "SMALL", "salt"),
    ("6", "STANDARD", "salt"),
]
ROOT_CATEGORIES = [
    ("7", "Sweet", "all"),
    ("8", "salt", "all"),
]


# Columns the feeds read from each driver table, with their stored types.
# A declared read schema spares Spark a schema-inference job per read (it
# opens a file footer on an executor) and states the contract the feeds rely
# on: a table whose column types differ fails at the scan, not later.
SOURCE_COLUMNS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
              "o_orderdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_retailprice DOUBLE",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; declared columns only when ``name`` has a contract."""
    reader = spark.read
    if name in SOURCE_COLUMNS:
        reader = reader.schema(SOURCE_COLUMNS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the files behind the orders feed."""
    return input_bytes(spark, [f"{sf_dir.rstrip('/')}/{name}.parquet"
                               for name in ("lineitem", "orders")])


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per order line, as the orders CSV would hold it.

    Orders with key % 97 = 0 lose their customer id, % 97 = 1 get a blank one;
    key % 89 = 0 get quantity ``0.1``, key % 7 = 0 write whole quantities as
    ``2.0``; key % 131 = 7 name an unknown product; lines of orders with
    key % 53 = 0 are delivered twice.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    k = F.col("o_orderkey")
    # Order-level text is formatted once per order, before the join, not
    # once per line.
    od = table(spark, sf_dir, "orders").select(
        k,
        F.concat(F.lit("A-"), k.cast("string")).alias("order_id"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 97 == 1, F.lit(" "))
         .otherwise(F.col("o_custkey").cast("string")).alias("cust_id"),
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("order_date_raw"),
        F.when(F.col("o_orderstatus") == "F", F.lit(" Shipped"))
         .when(F.col("o_orderstatus") == "O", F.lit("PAID"))
         .otherwise(F.lit("created ")).alias("status"))
    li, od = deal_by_size(li, od, "l_orderkey", "o_orderkey", order_bytes(spark, sf_dir))
    lines = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    whole = F.col("l_quantity").cast("bigint").cast("string")
    copies = F.explode(F.sequence(F.lit(1), F.when(k % 53 == 0, 2).otherwise(1)))
    return (lines
            .select("*", copies.alias("_copy"))
            .select(
                "order_id", "cust_id", "order_date_raw",
                F.when(k % 131 == 7, F.lit("999999999"))
                 .otherwise(F.col("l_partkey").cast("string")).alias("prod_id"),
                F.when(k % 89 == 0, F.lit("0.1"))
                 .when(k % 7 == 0, F.concat(whole, F.lit(".0")))
                 .otherwise(whole).alias("quantity_raw"),
                "status"))


def raw_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX feed: one rate per order (its date, a currency chosen by key).

    Orders of 1999 are left out, which leaves a one-year gap; several orders
    per day and currency give repeated writes, the highest ``seq`` is last.
    ``Yen`` also comes as ``YEN `` (one currency after clean-up), and ``Idr`` is
    worth less than 1e-6 of a dollar.
    """
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    return (od.filter(F.year("o_orderdate") != 1999)
              .select(
                  F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                  F.when(k % 10 == 9, "Idr").when(k % 3 == 0, "USD")
                   .when(k % 3 == 2, "Pound").when(k % 11 == 3, "YEN ")
                   .otherwise("Yen").alias("currency"),
                  F.when(k % 10 == 9, (1 + k % 7) * F.lit(3.95123e-8))
                   .otherwise(F.lit(0.5) + (k % 1000) / 1000).alias("conversion"),
                  k.alias("seq")))


def _leaf_frame(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, LEAF_CATEGORIES, CATEGORY_SCHEMA)


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category edges for the product types that occur in ``part``."""
    used = table(spark, sf_dir, "part").select("p_type").distinct()
    leaves = _leaf_frame(spark).join(used, F.col("child") == F.col("p_type"), "left_semi")
    roots = literal_frame(spark, ROOT_CATEGORIES, CATEGORY_SCHEMA)
    used_roots = roots.join(leaves.select(F.col("parent").alias("_p")),
                            F.col("child") == F.col("_p"), "left_semi")
    return leaves.unionByName(used_roots)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product feed: price as text, currency by key (``Yen`` in mixed case); keys
    % 101 = 5 cost 150 million."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_retailprice")
    k = F.col("p_partkey")
    leaf = F.broadcast(_leaf_frame(spark).select("cat_id", "child"))  # 6 fixed rows
    return (part.join(leaf, part.p_type == leaf.child, "left")
                .select(
                    k.cast("string").alias("prod_id"),
                    F.col("cat_id"),
                    F.col("p_name").alias("prod_name"),
                    F.when(k % 101 == 5, "150000000.00")
                     .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
                     .alias("price"),
                    F.when(k % 10 == 9, "IDR").when(k % 3 == 0, "USD").when(k % 3 == 1, "Yen")
                     .otherwise("POUND").alias("currency")))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer feed with region names, segment as type and a y/n flag: three
    snapshots per customer, whose dates sort differently as text."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    j = F.col("_snapshot")
    created = F.date_add(F.lit("1994-01-01").cast("date"), ((k * 37 + j * 211) % 1000).cast("int"))
    c = c.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("_snapshot"))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey)
             .select(
                 k.cast("string").alias("cust_id"),
                 F.date_format(created, "M/d/yyyy").alias("created_at"),
                 F.col("n_name").alias("country"),
                 F.col("r_name").alias("region"),
                 F.col("c_mktsegment").alias("type"),
                 F.lpad(((k * 7 + j) % 100000).cast("string"), 5, "0").alias("zip"),
                 F.when(F.col("c_acctbal") >= 0, "y")
                  .when(F.col("c_acctbal") > -500, "n").alias("active")))


def customer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated snapshots per key: the event stream, keyed by user."""
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw feeds, by name."""
    return {
        "customers": raw_customers(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "categories": raw_categories(spark, sf_dir),
        "fx_rates": raw_fx(spark, sf_dir),
    }
