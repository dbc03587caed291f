"""End-to-end run: feeds -> bronze -> silver -> gold -> metrics.

Each layer is written once and the next layer reads the written tables, so
every table is computed by exactly one job, row counts and null gates come
from the write job itself, and a failure or lost executor only recomputes
from the last written layer.

Tables are published: written beside the present one, gated, then switched, so a
run that stops leaves the tables of the run before readable.  The raw orders are
scanned once: one job writes clean and quarantined rows, in a folder for each class,
and both tables point into it.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
import uuid
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import constants as K
from orderlake.operators import broadcast_if_small, check_row_count, quality
from orderlake.operators.dedup import COPIES
from orderlake.operators.quality import check_nulls_counts
from orderlake.plans import bronze, gold, metrics, silver
from orderlake.session import work_root
from orderlake.sinks import AuditLog, TableStore, layer_row_counts
from orderlake.sinks.tables import BROKEN_LINES_DDL, BRONZE_DDL, ERROR_TABLE_DDL

# Tables and their labels (fixed values: they appear in the run summary).
LAYOUT = {
    "bronze": [("customer", "customers"), ("orders", "orders"), ("product", "products"),
               ("cat_tree", "categories"), ("fx_rates", "fx rates")],
    "silver": [("customer", "customers"), ("orders", "orders"), ("product", "products"),
               ("fx_rates", "fx rates"), ("order_items", "order items")],
    "gold": [("dim_customer", "customer dimension"), ("dim_product", "product dimension"),
             ("dim_date", "date dimension"), ("fact_orders", "orders fact")],
    "error_tables": [("err_orders", "quarantined orders")],
    "audit": [("pipeline_run_log", "pipeline run log")],
}


# Layers whose tables are declared up front (typed DDL with comments); the
# others take the schema of the frame written to them.
DECLARED_LAYERS = ("bronze", "error_tables")


def run_timestamp(now: dt.datetime | None = None) -> Column:
    """One timestamp literal for every table of a run (UTC, naive)."""
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(now).cast("timestamp")


@dataclass
class RunResult:
    run_id: str
    counts: dict = field(default_factory=dict)
    gates: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)     # wall time of each table write
    orders: dict = field(default_factory=dict)      # raw, clean, duplicate, ... order rows
    lost_lines: dict = field(default_factory=dict)  # order lines without a product, by cause


def run(spark: SparkSession, feeds: dict[str, DataFrame], store: TableStore | None = None,
        run_ts: Column | None = None, source_file: str = "raw_orders",
        null_gate_mode: str = "raise", as_of: str | None = None,
        flag_missing_qty: bool = False, customer_buckets: int | None = None,
        parallelism: int = 4) -> RunResult:
    """Run every layer; return counts, gate results and the metric frames.

    Each table is written as soon as the tables it reads are written, up to
    ``parallelism`` writes at a time (concurrent Spark jobs share the
    executors).  A table never waits for unrelated tables of its layer: the
    FX calendar is filled while the order lines are still being cleaned.
    ``null_gate_mode='report'`` records NULL counts without stopping; with
    ``'raise'`` a failing gate stops the run before any table that reads the
    gated one is built, and no further write starts.

    ``customer_buckets=n`` (off by default) buckets the fact and the customer
    dimension on ``cust_key`` alike, so the customer-keyed metrics read the
    fact without shuffling it; size it so one bucket of the fact is
    ~0.5-1 GB.  Use it only when no customer holds a large share of the
    orders: a bucket is read by one task, so a heavy customer would become
    one huge task, while the default shuffled plans combine its rows
    map-side and AQE splits skewed join partitions.
    """
    store = store or TableStore(spark, f"{work_root(spark)}/tables")
    by_customer = (["cust_key"], customer_buckets) if customer_buckets else None
    run_ts = run_ts if run_ts is not None else run_timestamp()
    res = RunResult(run_id=str(uuid.uuid4()))
    audit = AuditLog(res.run_id)
    for layer in LAYOUT:
        store.ensure_schema(layer)
    for table, (ddl, note) in BRONZE_DDL.items():
        store.create_table("bronze", table, ddl, note)
    store.create_table("error_tables", "err_orders", ERROR_TABLE_DDL, "quarantined order rows")
    writes = _Writes(parallelism)
    logger, logged = ThreadPoolExecutor(max_workers=1), []     # audit appends, beside the writes
    rd = store.read

    def done(layer: str, table: str, n: int, started: float) -> int:
        res.counts[f"{layer}.{table}"] = n
        res.seconds[f"{layer}.{table}"] = round(time.perf_counter() - started, 3)
        audit.record(layer, store.name(layer, table), n)
        logged.append(logger.submit(audit.flush, store))
        return n

    def put(layer: str, table: str, build, needs=(), stamp=True, bucket_by=None,
            gate=(), label=None, min_rows=None, check=None) -> None:
        """Write ``build()`` once every table in ``needs`` is written.

        ``gate`` columns have their NULLs counted by the write job itself (no
        second scan); the gate, the ``min_rows`` check and ``check(rows, written)``
        are applied to the written rows before the table is switched to them, and
        so before any table reading this one starts.
        """
        label = label or table

        def write():
            started = time.perf_counter()
            df = build()
            if stamp:
                df = df.withColumn("_updated_at", run_ts)

            def gates(n: int, nulls: dict[str, int], written: DataFrame) -> None:
                if gate:
                    res.gates[label] = nulls
                    if null_gate_mode == "raise":
                        check_nulls_counts(nulls, label)
                if min_rows is not None:
                    check_row_count(n, min_rows, label)
                if check is not None:
                    check(n, written)

            n, _ = store.publish(df, layer, table, gates, bucket_by, gate,
                                 keep_definition=layer in DECLARED_LAYERS)
            return done(layer, table, n, started)
        writes.add(f"{layer}.{table}", write, needs)

    # Each row keeps where it came from and when it was ingested; file feeds
    # carry their path in ``_source_file`` already (sources.read_feeds).
    def lineage(df: DataFrame, feed: str) -> DataFrame:
        if "_source_file" not in df.columns:
            df = df.withColumn("_source_file", F.lit(feed))
        return df.withColumn("_ingested_at", run_ts)

    def conserved_lines(n: int, _: DataFrame) -> None:
        """The product join keeps or drops a line and never multiplies it."""
        lost = res.counts["silver.orders"] - n
        if lost < 0:
            raise quality.QualityGateError(f"order items: {-lost} more lines than orders have: "
                                           "a product or a rate is there more than once")
        res.lost_lines["unknown_product"] = lost

    def write_split() -> None:
        """Both order tables from one scan of the feed, counted in the written files."""
        started = time.perf_counter()
        path = store.new_version("bronze", "orders")
        folders = {c: f"{path}/_class={c}" for c in quality.CLASSES}
        try:
            b.split.write.partitionBy("_class").parquet(path)
            written = spark.read.schema(b.split.schema).parquet(path)
            res.orders.update(quality.split_counts(written, COPIES))
            quality.check_conserved(res.orders, "orders", null_gate_mode)
            for folder in folders.values():
                store.ensure_folder(folder)
            rows = {"bronze.orders": (quality.CLASSES[0], res.orders["clean_rows"]
                                      - res.orders["duplicate_rows"]),
                    "error_tables.err_orders": (quality.CLASSES[1],
                                                res.orders["quarantined_rows"])}
            for key, (kind, n) in rows.items():
                layer, table = key.split(".")
                if store.fmt == "parquet":
                    store.point(layer, table, folders[kind])
                else:                       # another format: copied from the split
                    part = spark.read.schema(b.split.schema).parquet(folders[kind])
                    store.publish(part.select(*rd(layer, table).columns), layer, table,
                                  keep_definition=True)
                done(layer, table, n, started)
        except BaseException:
            if "bronze.orders" not in res.counts:           # no table names the folder yet
                store.drop_version(path)
            raise
        store.prune("bronze", "orders", path)

    try:
        # ---- bronze: raw text after dedup and quarantine ---------------
        b = bronze.build(feeds, source_file, run_ts, flag_missing_qty)
        put("bronze", "customer", lambda: lineage(b.customers, "customers"), stamp=False)
        writes.add("bronze.orders", write_split)
        put("bronze", "product", lambda: lineage(b.products, "products"), stamp=False)
        put("bronze", "cat_tree", lambda: lineage(b.categories, "categories"), stamp=False)
        put("bronze", "fx_rates", lambda: lineage(b.fx_rates, "fx_rates"), stamp=False)
        writes.add("error_tables.err_orders", lambda: None, ["bronze.orders"])
        if b.broken is not None:                # file feeds: lines that no table can hold
            store.create_table("error_tables", "err_lines", BROKEN_LINES_DDL,
                               "lines without the declared columns")
            put("error_tables", "err_lines", lambda: lineage(b.broken, "files"), stamp=False)

        # ---- silver: typed and enriched, from the written bronze tables -
        put("silver", "customer", lambda: silver.customers(rd("bronze", "customer")),
            needs=["bronze.customer"], gate=["cust_id", "created_at", "is_active"],
            label="customers")
        put("silver", "orders", lambda: silver.orders(rd("bronze", "orders")),
            needs=["bronze.orders"],
            gate=["order_id", "cust_id", "order_timestamp", "quantity"], label="orders")
        put("silver", "product",
            lambda: silver.products(rd("bronze", "product"), rd("bronze", "cat_tree"),
                                    res.counts["bronze.cat_tree"]),
            needs=["bronze.product", "bronze.cat_tree"],
            gate=["prod_id", "price", "currency", "top_category"], label="products")
        put("silver", "fx_rates", lambda: silver.fx_rates(rd("bronze", "fx_rates")),
            needs=["bronze.fx_rates"], check=lambda _, written: quality.check_unique(
                written, ["rate_date", "currency"], "fx rates"))
        put("silver", "order_items",
            lambda: silver.order_items(rd("silver", "orders"), rd("silver", "product"),
                                       rd("silver", "fx_rates"), res.counts["silver.fx_rates"],
                                       res.counts["silver.product"]),
            needs=["silver.orders", "silver.product", "silver.fx_rates"],
            gate=["revenue_usd"], label="order items", check=conserved_lines)

        # ---- gold: star schema ------------------------------------------
        labels = dict(LAYOUT["gold"])
        put("gold", "dim_customer", lambda: gold.dim_customer(rd("silver", "customer")),
            needs=["silver.customer"], bucket_by=by_customer,
            label=labels["dim_customer"], min_rows=1)
        put("gold", "dim_product",
            lambda: gold.dim_product(rd("silver", "product"), rd("silver", "fx_rates"),
                                    res.counts["silver.fx_rates"]),
            needs=["silver.product", "silver.fx_rates"],
            label=labels["dim_product"], min_rows=1)
        put("gold", "dim_date", lambda: gold.dim_date(rd("silver", "order_items")),
            needs=["silver.order_items"], label=labels["dim_date"], min_rows=1)
        # The fact waits for every dimension: an empty one stops the run first.
        put("gold", "fact_orders",
            lambda: gold.fact_orders(rd("silver", "order_items"), rd("gold", "dim_date"),
                                     res.counts["gold.dim_date"]),
            needs=["silver.order_items", "gold.dim_customer", "gold.dim_product",
                   "gold.dim_date"],
            bucket_by=by_customer,
            gate=["order_id", "cust_key", "prod_key", "date_key", "revenue_usd"],
            label=labels["fact_orders"], min_rows=1)
        writes.wait()
        # counts in declaration order (writes finish in any order)
        res.counts = {k: res.counts[k] for k in writes.futures if k in res.counts}
        res.seconds = {k: res.seconds[k] for k in writes.futures if k in res.seconds}
    except Exception as exc:
        audit.record("RUN", K.PIPELINE_NAME, 0, "FAILED", f"{type(exc).__name__}: {exc}")
        raise
    finally:
        writes.close()
        logger.shutdown(wait=True)
        audit.flush(store)
    for done in logged:
        done.result()                             # an append that failed
    res.metrics = metric_frames(store, as_of, counts=res.counts)
    return res


class _RunStopped(RuntimeError):
    """A write that was not started because an earlier one failed."""


class _Writes:
    """Table writes, each started once the writes it depends on succeeded.

    Every write has its own thread, which first waits for its dependencies
    (outside the limit) and then takes one of ``parallelism`` slots for the
    Spark job.  After the first failure no new write starts; ``wait`` then
    re-raises that failure.
    """

    def __init__(self, parallelism: int):
        self.pool = ThreadPoolExecutor(max_workers=32)
        self.slots = threading.BoundedSemaphore(max(1, parallelism))
        self.stop = threading.Event()
        self.futures: dict[str, Future] = {}

    def add(self, key: str, write, needs=()) -> None:
        deps = [self.futures[n] for n in needs]   # declared before use

        def task():
            for d in deps:
                d.result()                        # a failed dependency fails this write
            with self.slots:
                if self.stop.is_set():
                    raise _RunStopped(key)
                try:
                    return write()
                except BaseException:
                    self.stop.set()
                    raise
        self.futures[key] = self.pool.submit(task)

    def wait(self) -> None:
        """Wait for every write; raise the first real failure (in declaration
        order), not the writes it prevented."""
        error = None
        for f in self.futures.values():
            exc = f.exception()
            if exc is not None and not isinstance(exc, _RunStopped) and error is None:
                error = exc
        if error is not None:
            raise error

    def close(self) -> None:
        self.stop.set()                           # nothing new after an error
        self.pool.shutdown(wait=True)


def metric_frames(store: TableStore, as_of: str | None = None,
                  ordered: bool = False, counts: dict | None = None) -> dict[str, DataFrame]:
    """The metrics, lazily, over the written gold and error tables
    (``ordered=True``: in the presentation order of the original queries).

    ``counts`` (the row counts of a run, ``RunResult.counts``) lets the
    dimensions be broadcast on their measured size; without them the
    optimizer and AQE decide from file sizes and run-time statistics.
    """
    rd = store.read
    counts = counts or {}

    def dim(table: str) -> DataFrame:
        return broadcast_if_small(rd("gold", table), counts.get(f"gold.{table}"))
    fact, dates = rd("gold", "fact_orders"), dim("dim_date")
    cust, prod = dim("dim_customer"), dim("dim_product")
    sales = metrics.category_sales(fact, dates, prod)
    return {
        "daily_active": metrics.daily_active_customers(fact, dates, cust, ordered),
        "category_sales": metrics.category_sales(fact, dates, prod, ordered=ordered),
        "category_totals": metrics.category_totals(sales),
        "top_products": metrics.top_products_by_region(fact, cust, prod, ordered=ordered),
        "customer_value": metrics.customer_value(fact, cust, ordered=ordered),
        "customer_tenure": metrics.customer_value(fact, cust, dates, as_of, ordered),
        "order_audit": metrics.order_audit(fact, rd("error_tables", "err_orders"), ordered),
    }


def summary(store: TableStore) -> DataFrame:
    """Row count of every table of the layout (missing tables: NULL)."""
    return layer_row_counts(store, LAYOUT)
