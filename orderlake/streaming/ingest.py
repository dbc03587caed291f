"""Streaming ingest of order files: classify, quarantine, keep clean rows.

Each micro-batch overwrites the partition folder of its batch id and then
registers it, so a batch replayed after a failure, the first one included,
replaces its own output instead of appending it twice.  Exact duplicates are
collapsed within a batch; a reader that wants them collapsed across batches
applies ``exact_dedup`` to the data columns of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlake.operators import dedup, quality
from orderlake.sinks import TableStore
from orderlake.sources.schemas import ORDERS_SCHEMA


def classify_stream(stream: DataFrame, flag_missing_qty: bool = False) -> DataFrame:
    return quality.classify_orders(stream, "cust_id", "quantity_raw",
                                   flag_missing_qty=flag_missing_qty)


def _write_batch(store: TableStore, df: DataFrame, layer: str, table: str,
                 batch_id: int) -> None:
    """Replace this batch's partition folder of ``layer.table`` and register it.

    Overwriting exactly ``_batch_id=<id>`` makes a replayed batch idempotent.
    """
    store.ensure_schema(layer)
    name, loc = store.name(layer, table), store.location(layer, table)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    store.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {store.fmt} "
                    f"PARTITIONED BY (_batch_id) LOCATION '{loc}'")
    part = f"{loc}/_batch_id={batch_id}"
    df.drop("_batch_id").write.format(store.fmt).mode("overwrite").save(part)
    store.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (_batch_id={batch_id}) "
                    f"LOCATION '{part}'")


def ingest_batches(store: TableStore, source_file: str, clean_table: str = "orders_stream",
                   error_table: str = "err_orders_stream"):
    """A ``foreachBatch`` function writing clean and quarantined rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        classified = classify_stream(batch).withColumn("_batch_id", F.lit(batch_id))
        classified.persist()
        try:
            clean = dedup.exact_dedup(quality.clean_rows(classified))
            errors = quality.tag_quarantine(classified, source_file,
                                            F.current_timestamp())
            for df, layer, table in ((clean, "bronze", clean_table),
                                     (errors, "error_tables", error_table)):
                _write_batch(store, df, layer, table, batch_id)
        finally:
            classified.unpersist()

    return write


def start_order_ingest(spark: SparkSession, path: str, store: TableStore,
                       checkpoint: str, available_now: bool = True,
                       max_files_per_trigger: int = 100) -> StreamingQuery:
    """Stream order CSV files from ``path`` into the bronze and error tables."""
    stream = (spark.readStream.format("csv").option("header", True)
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .schema(ORDERS_SCHEMA).load(path))
    writer = (stream.writeStream.foreachBatch(ingest_batches(store, path))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
