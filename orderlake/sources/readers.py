"""Scans of source files and tables.

* CSV: header row skipped, declared schema applied by position (the header
  names are not used), every value kept as text.
* JSON: JSON Lines by default (splittable, one task per block).  A JSON array of
  flat records is split as well by ``read_json_array``; any other document needs
  ``multi_line=True`` and is read by one task per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv_source(spark: SparkSession, path: str, schema: StructType,
                    keep_blanks: bool = True,
                    corrupt_column: str | None = None) -> DataFrame:
    """CSV feed under a declared schema.

    ``corrupt_column`` adds a text column that receives the whole line of a
    malformed record (wrong number of fields) instead of dropping it; the
    record's other columns hold what could be read.  Such rows can then be quarantined.
    Lines are then parsed whole whatever columns a query reads: a parser that skips
    columns does not see that there are too few or too many.
    """
    if corrupt_column:
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
    reader = (spark.read.format("csv")
              .option("header", True)
              .option("enforceSchema", True)
              .option("mode", "PERMISSIVE"))
    if corrupt_column:
        reader = (reader.option("columnNameOfCorruptRecord", corrupt_column)
                        .option("columnPruning", False))
    if keep_blanks:
        # Leading/trailing blanks are data here (' Shipped', ' ').
        reader = (reader.option("ignoreLeadingWhiteSpace", False)
                        .option("ignoreTrailingWhiteSpace", False))
    return reader.schema(schema).load(path)


def read_json_source(spark: SparkSession, path: str, schema: StructType,
                     multi_line: bool = False) -> DataFrame:
    return (spark.read.format("json")
            .option("multiLine", multi_line)
            .option("mode", "PERMISSIVE")
            .schema(schema)
            .load(path))


#: Between two records, before the first and behind the last of an array.
_OPENS, _CLOSES = r"^\uFEFF?\s*[\[,]\s*(?=\{)", r"^\uFEFF?\s*\[?\s*\]?\s*$"
_PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".xz")


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A JSON array of flat records, read by as many tasks as it has blocks.

    The files are read as text that ends records at ``}``, which Spark splits like
    lines, and every record is parsed for itself.  A seam that is none (a brace in a
    text, a nested record), a broken record and a file that does not end its array
    are errors, never other rows; ``read_json_source(multi_line=True)`` reads valid
    documents of such kinds.  Compressed files are read that way, as no split is possible.
    """
    text = spark.read.option("lineSep", "}").text(path)
    files = text.inputFiles()
    if any(f.lower().endswith(_PACKED) for f in files):
        return read_json_source(spark, path, schema, multi_line=True)
    for f in files:
        end = _last_bytes(spark, f, 256).rstrip()
        if end and not end.endswith(b"]"):
            raise ValueError(f"{f} is no whole JSON array: it does not end with a bracket")
    whole = "_broken_record"
    types = StructType([*schema.fields, StructField(whole, StringType(), True)])
    record = F.concat(F.regexp_replace("value", _OPENS, ""), F.lit("}"))
    parsed = F.from_json(record, types, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": whole})
    broken = F.raise_error(F.concat(F.lit("no flat record of a JSON array: "), "value"))
    return (text.where(~F.col("value").rlike(_CLOSES))
            .withColumn("_record", F.when(F.col("value").rlike(_OPENS), parsed))
            .withColumn("_record", F.when(
                F.col("_record").isNotNull() & F.col(f"_record.{whole}").isNull(),
                F.col("_record")).otherwise(broken.cast(types)))
            .select(*[F.col("_record")[n].alias(n) for n in schema.names]))


def _last_bytes(spark: SparkSession, file: str, n: int) -> bytes:
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(path)
    try:
        stream.seek(max(0, fs.getFileStatus(path).getLen() - n))
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table (or temp view) by name."""
    return spark.table(name)


def with_sequence(df: DataFrame, name: str = "_seq") -> DataFrame:
    """Number rows in scan order, before any shuffle.

    ``monotonically_increasing_id`` encodes (split, position) so later rows of
    one file get larger ids; it is only meaningful when applied right at the
    scan.  Feeds that carry their own write sequence should use that instead.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


#: Columns that put the rows of all files of a feed in the order they were written.
WRITE_ORDER = ("_file_time", "_file_path", "_file_block")


def with_write_order(df: DataFrame, name: str = "_seq") -> DataFrame:
    """``with_sequence``, and what orders rows across files: a file that was changed
    later is written later (equal times: by path), then the place of the block in its
    file, then the row.  Compare ``WRITE_ORDER`` and then ``name``."""
    return with_sequence(df.select(
        "*", F.col("_metadata.file_modification_time").alias("_file_time"),
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_block_start").alias("_file_block")), name)
