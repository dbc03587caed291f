"""Table sinks.

* Every write is one Spark job; its row count comes from an ``Observation``
  attached to that job, never from a second pass over the data.
* Later stages read the written table, which also cuts the lineage: a lost
  executor recomputes from the last written layer, not from the sources.
* ``TableStore.publish`` writes into a fresh folder, applies the gates to what is
  written there, and only then points the table at it.  A failed gate or a killed
  write leaves the table as it was.
* Tables live in per-layer databases whose files sit under one shared root
  (``session.work_root`` by default, i.e. ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from orderlake import constants as K
from orderlake.sources.literals import literal_frame

AUDIT_SCHEMA = StructType([
    StructField("run_id", StringType(), True),
    StructField("pipeline", StringType(), True),
    StructField("version", StringType(), True),
    StructField("layer", StringType(), True),
    StructField("table_name", StringType(), True),
    StructField("row_count", LongType(), True),
    StructField("status", StringType(), True),
    StructField("notes", StringType(), True),
    StructField("logged_at", StringType(), True),
])

# Typed DDL of the tables whose schema is fixed up front: the bronze tables
# (raw text as received plus lineage), the quarantine table and the audit log.
_LINEAGE_DDL = """,
    _source_file STRING COMMENT 'feed or file the row came from',
    _ingested_at TIMESTAMP COMMENT 'run timestamp of the ingest'
"""
BRONZE_DDL = {
    "customer": ("""
    cust_id STRING COMMENT 'customer id as received',
    created_at STRING COMMENT 'creation date text, M/d/yyyy',
    country STRING COMMENT 'country',
    region STRING COMMENT 'region name',
    type STRING COMMENT 'customer segment',
    zip STRING COMMENT 'postal code, text so leading zeros stay',
    active STRING COMMENT 'y / n flag as received'""" + _LINEAGE_DDL,
                 "newest snapshot per customer"),
    "orders": ("""
    order_id STRING COMMENT 'order id',
    cust_id STRING COMMENT 'customer id as received',
    order_date_raw STRING COMMENT 'order time text, M/d/yyyy H:mm',
    prod_id STRING COMMENT 'product id as received',
    quantity_raw STRING COMMENT 'quantity text as received',
    status STRING COMMENT 'status as received'""" + _LINEAGE_DDL,
               "order lines without exact copies and without quarantined rows"),
    "product": ("""
    prod_id STRING COMMENT 'product id as received',
    cat_id STRING COMMENT 'category id as received',
    prod_name STRING COMMENT 'product name',
    price STRING COMMENT 'price text in the product currency',
    currency STRING COMMENT 'currency code as received (any case)',
    _currency_note STRING COMMENT 'set when the code is not upper case'""" + _LINEAGE_DDL,
                "products as received"),
    "cat_tree": ("""
    cat_id STRING COMMENT 'category id',
    child STRING COMMENT 'category name',
    parent STRING COMMENT 'parent category name; all marks a root'""" + _LINEAGE_DDL,
                 "category edges as received"),
    "fx_rates": ("""
    date STRING COMMENT 'rate date text, yyyy-MM-dd',
    currency STRING COMMENT 'currency code as received',
    conversion DOUBLE COMMENT 'rate to USD',
    seq BIGINT COMMENT 'write sequence of the feed; the highest wins'""" + _LINEAGE_DDL,
                 "last written rate per date and currency"),
}

BROKEN_LINES_DDL = """
    feed STRING COMMENT 'feed the line is from',
    first_field STRING COMMENT 'first column, as far as it was read',
    line STRING COMMENT 'the line as received',
    _error_code STRING COMMENT 'quarantine reason code',
    _source_file STRING COMMENT 'file the line came from',
    _ingested_at TIMESTAMP COMMENT 'run timestamp'
"""
ERROR_TABLE_DDL = """
    order_id STRING COMMENT 'order id as received',
    cust_id STRING COMMENT 'customer id as received',
    order_date_raw STRING COMMENT 'order date text as received',
    prod_id STRING COMMENT 'product id as received',
    quantity_raw STRING COMMENT 'quantity text as received',
    status STRING COMMENT 'status as received',
    _error_code STRING COMMENT 'quarantine reason code',
    _error_message STRING COMMENT 'quarantine reason',
    _source_file STRING COMMENT 'feed the row came from',
    _ingested_at TIMESTAMP COMMENT 'run timestamp'
"""
AUDIT_TABLE_DDL = """
    run_id STRING COMMENT 'one id per pipeline run',
    pipeline STRING, version STRING,
    layer STRING COMMENT 'BRONZE, SILVER, GOLD, ERROR',
    table_name STRING, row_count BIGINT COMMENT 'rows written',
    status STRING COMMENT 'SUCCESS or FAILED', notes STRING,
    logged_at STRING COMMENT 'UTC, yyyy-MM-dd HH:mm:ss'
"""


def write_table(df: DataFrame, table: str, location: str | None = None,
                fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None,
                bucket_by: tuple[Sequence[str], int] | None = None) -> int:
    """Write ``df`` as ``table`` and return the number of rows written.

    Overwrite is idempotent: re-running a stage replaces its output.
    ``bucket_by=(columns, n)`` hash-buckets the table; tables bucketed the same
    way on a join or grouping key are joined and grouped without a shuffle.
    The rows are first hash-partitioned into ``n`` parts with the same hash,
    so every write task produces exactly one bucket file.  Only for keys
    without heavy hitters: a bucketed scan reads a bucket in one task, so a
    key holding a large share of the rows would become one huge task.
    """
    rows, _ = write_observed(df, table, location, fmt, mode, partition_by, bucket_by)
    return rows


def write_observed(df: DataFrame, table: str, location: str | None = None,
                   fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: Sequence[str] | None = None,
                   bucket_by: tuple[Sequence[str], int] | None = None,
                   null_columns: Sequence[str] = ()) -> tuple[int, dict[str, int]]:
    """Like ``write_table``, and also count NULLs of ``null_columns`` in the
    same job: (rows written, {column: nulls})."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"null_{i}")
                for i, c in enumerate(null_columns)]
    if bucket_by:
        cols, n = list(bucket_by[0]), int(bucket_by[1])
        df = df.repartition(n, *cols)
    writer = df.observe(obs, *metrics).write.format(fmt).mode(mode)
    if bucket_by:
        writer = writer.bucketBy(n, cols[0], *cols[1:])
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", True)      # columns may change between runs
    if location:
        writer = writer.option("path", location)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return _observed(obs, null_columns)


def _observed(obs: Observation, null_columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Row and NULL counts; a count the write did not deliver raises (KeyError)."""
    got = obs.get
    return int(got["rows"]), {c: int(got[f"null_{i}"]) for i, c in enumerate(null_columns)}


def as_declared(df: DataFrame, table: str) -> DataFrame:
    """The columns of an existing table, by name, cast to its declared types."""
    target = df.sparkSession.table(table).schema
    missing = [f.name for f in target.fields if f.name not in df.columns]
    extra = [c for c in df.columns if c not in target.names]
    if missing or extra:
        raise ValueError(f"{table}: frame lacks declared columns {missing}, "
                         f"has undeclared columns {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def insert_observed(df: DataFrame, table: str, mode: str = "overwrite",
                    null_columns: Sequence[str] = ()) -> tuple[int, dict[str, int]]:
    """Insert into an existing table (columns matched by name, cast to the
    declared types), observing the row count and NULL counts."""
    df = as_declared(df, table)
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"null_{i}")
                for i, c in enumerate(null_columns)]
    df.observe(obs, *metrics).write.insertInto(table, overwrite=(mode == "overwrite"))
    return _observed(obs, null_columns)


@dataclass
class TableStore:
    """Per-layer databases under one root folder."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    prefix: str = ""
    created: set = field(default_factory=set)

    def db(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.db(layer)}.{table}"

    def location(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def ensure_schema(self, layer: str) -> None:
        if layer not in self.created:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db(layer)} "
                           f"LOCATION '{self.root}/{layer}'")
            found = self.spark.catalog.getDatabase(self.db(layer)).locationUri
            self._same_place(self.db(layer), found, f"{self.root}/{layer}")
            self.created.add(layer)

    def _same_place(self, name: str, found: str, expected: str) -> None:
        """A name registered for another folder would send this store's rows there."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()

        def full(p: str) -> str:
            path = jvm.org.apache.hadoop.fs.Path(p)
            return path.getFileSystem(conf).makeQualified(path).toString().rstrip("/")

        if full(found) != full(expected) and not full(found).startswith(full(expected) + "/"):
            raise ValueError(f"{name} is registered at {found}, not at {expected}: "
                             "use another prefix or the registered root")

    def create_table(self, layer: str, table: str, ddl: str, comment: str = "") -> None:
        """``CREATE TABLE IF NOT EXISTS`` with column comments."""
        self.ensure_schema(layer)
        note = comment.replace("'", "''")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(layer, table)} ({ddl}) "
            f"USING {self.fmt} LOCATION '{self.location(layer, table)}' "
            f"COMMENT '{note}'")
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}")
        found = about.where("col_name = 'Location'").first()
        if found is not None:
            # a published table stands in a folder of its own somewhere below the root
            self._same_place(self.name(layer, table), found["data_type"], self.root)

    def write(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite",
              partition_by: Sequence[str] | None = None,
              bucket_by: tuple[Sequence[str], int] | None = None) -> int:
        return self.write_observed(df, layer, table, mode, partition_by, bucket_by)[0]

    def write_observed(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite",
                       partition_by: Sequence[str] | None = None,
                       bucket_by: tuple[Sequence[str], int] | None = None,
                       null_columns: Sequence[str] = (),
                       keep_definition: bool = False) -> tuple[int, dict[str, int]]:
        """Write and observe.  ``keep_definition=True`` writes into the
        existing (DDL-declared) table by column name, keeping its declared
        types and comments, instead of replacing the table."""
        self.ensure_schema(layer)
        name = self.name(layer, table)
        if keep_definition and self.exists(layer, table):
            return insert_observed(df, name, mode, null_columns)
        return write_observed(df, name, self.location(layer, table),
                              self.fmt, mode, partition_by, bucket_by, null_columns)

    # ---- staged publish ---------------------------------------------------
    def new_version(self, layer: str, table: str) -> str:
        """A fresh folder for the next contents of a table; names sort by time."""
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        return f"{self.location(layer, table)}/v-{now}-{uuid.uuid4().hex[:8]}"

    def publish(self, df: DataFrame, layer: str, table: str,
                gate: Callable[[int, dict[str, int], DataFrame], None] | None = None,
                bucket_by: tuple[Sequence[str], int] | None = None,
                null_columns: Sequence[str] = (),
                keep_definition: bool = False) -> tuple[int, dict[str, int]]:
        """Write ``df`` beside the table, gate it, then switch the table to it.

        ``gate(rows, nulls, written)`` gets the observed counts and a frame over the
        written rows; if it raises, the new folder is deleted and the table still
        holds its earlier rows.  A writer that dies leaves at most a folder that no
        table names.  The version before the new one stays, for readers that are at it;
        older ones are deleted.  One writer a table at a time.

        The switch is one catalog change where the columns stay the same; a table
        whose columns change, or a bucketed one, is dropped (its files stay) and
        registered anew.  Delta tables have versions of their own: they are
        overwritten in one commit, and the gate runs on what it made.
        """
        self.ensure_schema(layer)
        name, declared = self.name(layer, table), keep_definition and self.exists(layer, table)
        if self.fmt == "delta":
            rows, nulls = self.write_observed(df, layer, table, bucket_by=bucket_by,
                                              null_columns=null_columns,
                                              keep_definition=keep_definition)
            if gate:
                gate(rows, nulls, self.read(layer, table))
            return rows, nulls
        if declared:
            df = as_declared(df, name)
        path = self.new_version(layer, table)
        staged = f"{name}__{uuid.uuid4().hex[:8]}"
        try:
            rows, nulls = write_observed(df, staged, path, self.fmt, "overwrite", None, bucket_by,
                                         null_columns)
            if gate:
                gate(rows, nulls, self.spark.table(staged))
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {staged}")
            self.drop_version(path)
            raise
        if bucket_by or not self._same_columns(name, staged):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")         # its files stay
            self.spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        else:
            self.spark.sql(f"DROP TABLE {staged}")
            self.point(layer, table, path)
        self.prune(layer, table, path)
        return rows, nulls

    def _same_columns(self, name: str, staged: str) -> bool:
        """Whether ``name`` is a table of the same columns without buckets."""
        catalog = self.spark.catalog
        if not catalog.tableExists(name):
            return False
        about = [[(c.name, c.dataType) for c in catalog.listColumns(t)] for t in (name, staged)]
        return about[0] == about[1] and not any(c.isBucket for c in catalog.listColumns(name))

    def point(self, layer: str, table: str, path: str) -> None:
        """Let an existing table read the files in ``path`` from now on."""
        name = self.name(layer, table)
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(name)

    def _fs(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop_version(self, path: str) -> None:
        at, fs = self._fs(path)
        fs.delete(at, True)

    def ensure_folder(self, path: str) -> None:
        at, fs = self._fs(path)
        fs.mkdirs(at)

    def versions(self, layer: str, table: str) -> list[str]:
        """The version folders of a table, oldest first."""
        at, fs = self._fs(self.location(layer, table))
        if not fs.exists(at):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(at)]
        return [f"{self.location(layer, table)}/{n}" for n in sorted(names) if n.startswith("v-")]

    def prune(self, layer: str, table: str, current: str) -> None:
        """Delete the versions older than the one before ``current``."""
        older = [v for v in self.versions(layer, table) if v < current]
        for path in older[:-1]:
            self.drop_version(path)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))


@dataclass
class AuditLog:
    """Audit records of one run.  ``flush`` appends what has been recorded since
    the last flush; the run flushes after each table write, so a driver that
    dies loses none of the writes before.

    ``clock`` gives the log time as text (default: now, UTC).
    """

    run_id: str
    records: list = field(default_factory=list)
    clock: Callable[[], str] = lambda: dt.datetime.now(dt.timezone.utc).strftime(
        "%Y-%m-%d %H:%M:%S")
    lock: Lock = field(default_factory=Lock)

    def record(self, layer: str, table: str, rows: int, status: str = "SUCCESS",
               notes: str = "") -> None:
        now = self.clock()
        layer = K.AUDIT_LAYERS.get(layer.lower(), layer.upper())
        self.records.append((self.run_id, K.PIPELINE_NAME, K.PIPELINE_VERSION, layer,
                             table, int(rows), status, notes, now))

    def frame(self, spark: SparkSession) -> DataFrame:
        return literal_frame(spark, self.records, AUDIT_SCHEMA)

    def flush(self, store: TableStore, layer: str = "audit",
              table: str = "pipeline_run_log") -> int:
        with self.lock:                  # one append to the table at a time
            if not self.records:
                return 0
            ready = AuditLog(self.run_id, list(self.records))
            if (layer, table) not in store.created:          # once a store
                store.create_table(layer, table, AUDIT_TABLE_DDL, "one row per table write")
                store.created.add((layer, table))
            n = write_table(ready.frame(store.spark), store.name(layer, table),
                            store.location(layer, table), store.fmt, "append")
            del self.records[:len(ready.records)]
            return n


def counts_frame(spark: SparkSession,
                 entries: Sequence[tuple[dict[str, str], DataFrame | None]]) -> DataFrame:
    """One row per entry, in entry order: its label columns and the row count
    of its frame (NULL when the frame is missing, 0 when it is empty).

    All frames feed ONE aggregate: each contributes only its entry number, so
    no data column is read (a Parquet table answers from its footers), rows
    are counted per input partition, and a single small exchange combines the
    counts.  Both sides of the final join have one row per entry at most.
    """
    names = list(entries[0][0])
    schema = StructType([StructField("_entry", LongType(), False),
                         *[StructField(n, StringType(), True) for n in names],
                         StructField("_present", BooleanType(), False)])
    labels = literal_frame(spark, [(i, *[lab[n] for n in names], df is not None)
                                   for i, (lab, df) in enumerate(entries)], schema)
    present = [(i, df) for i, (_, df) in enumerate(entries) if df is not None]
    if present:
        tagged = present[0][1].select(F.lit(present[0][0]).cast("bigint").alias("_entry"))
        for i, df in present[1:]:
            tagged = tagged.union(df.select(F.lit(i).cast("bigint").alias("_entry")))
        counted = tagged.groupBy("_entry").agg(F.count(F.lit(1)).alias("_n"))
        labels = labels.join(F.broadcast(counted), "_entry", "left")
        n = F.when(F.col("_present"), F.coalesce(F.col("_n"), F.lit(0)))
    else:
        n = F.lit(None)
    return labels.select(*names, n.cast("bigint").alias("row_count"))


def layer_row_counts(store: TableStore,
                     layout: dict[str, Iterable[tuple[str, str]]]) -> DataFrame:
    """Current row count of each table, as one frame (layer, table_name, label,
    row_count).  A missing table is reported with a NULL count."""
    return counts_frame(store.spark, [
        ({"layer": layer, "table_name": store.name(layer, table), "label": label},
         store.read(layer, table) if store.exists(layer, table) else None)
        for layer, tables in layout.items() for table, label in tables])
