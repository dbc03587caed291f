"""Keep-one-row-per-key operators.

All of them are aggregations, not windows: Spark combines rows map-side
(partial aggregation) before the shuffle, so a key holding a third of the
table is reduced to one row per input partition before it moves.

What an aggregate keeps decides how it runs: fixed-width values (counts, file
numbers) are combined in a hash table, as in ``distinct_rows``; the structs of
``keep_one_per_key`` hold text, for which Spark sorts each task's input by key
(spilling, never a whole hot group: each map task has reduced its share first).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderlake.operators.joins import broadcast_if_small
from orderlake.sources.literals import literal_frame

COPIES = "_copies"


def keep_one_per_key(df: DataFrame, keys: Sequence[str],
                     order: Column | str | Sequence[Column | str] | None = None,
                     descending: bool = True) -> DataFrame:
    """One row per ``keys``: the greatest (or least) by ``order``.

    Ties on ``order`` are broken by the remaining columns in their column
    order, so the result never depends on row order or partitioning.
    NULL order values lose under ``descending`` (like ``DESC NULLS LAST``)
    and win otherwise (like ``ASC NULLS FIRST``), as in a ``row_number``
    window with Spark's default null ordering.

    Written as ``max``/``min`` over a struct (order values, then the other
    columns): a partial aggregate, safe under key skew.
    """
    keys = list(keys)
    if order is None:
        order = []
    elif isinstance(order, (str, Column)):
        order = [order]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in keys]
    if not rest:                       # every column is a key: plain distinct
        return df.dropDuplicates(keys)
    packed = F.struct(*[o.alias(f"_ord{i}") for i, o in enumerate(order_cols)],
                      *[F.col(c) for c in rest])
    pick = F.max(packed) if descending else F.min(packed)
    return (df.groupBy(*keys)
              .agg(pick.alias("_pick"))
              .select(*[F.col(c) for c in keys], *[F.col(f"_pick.{c}") for c in rest])
              .select(*df.columns))


def exact_dedup(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Collapse rows equal on every column (or on ``subset``, keeping the
    least row by the other columns so the choice is deterministic)."""
    if subset is None or set(subset) == set(df.columns):
        return df.dropDuplicates()
    return keep_one_per_key(df, subset, descending=False)


def file_numbers(df: DataFrame, file_col: str) -> DataFrame | None:
    """(``file_col``, _file): the files that ``df`` reads, as ``_metadata.file_path``
    names them, numbered in the order of their paths; None if it reads none.  A
    listing, no data is read."""
    # a path without a host has one slash there and three in the listing
    paths = sorted({re.sub("^([^:/]+):///", r"\1:/", p) for p in df.inputFiles()})
    if not paths:
        return None
    schema = StructType([StructField(file_col, StringType(), False),
                         StructField("_file", LongType(), False)])
    frame = literal_frame(df.sparkSession, [(p, i) for i, p in enumerate(paths)], schema)
    return broadcast_if_small(frame, 1 + sum(map(len, paths)) // 16)


def distinct_rows(df: DataFrame, columns: Sequence[str], apart: Column | None = None,
                  file_col: str | None = None) -> DataFrame:
    """Rows equal on ``columns`` once, with their number in ``_copies``.

    Rows for which ``apart`` holds are all kept: they are combined inside a map task
    and file only, and laid out again behind the shuffle.  ``file_col`` (the path of
    the row's file) is kept too, the least of equal rows: the aggregate carries the
    file's number, so it is a hash aggregate over fixed-width values, and the path is
    attached afterwards; a path that is none of the files read is an error.  Without
    files to list, the least text is aggregated.
    """
    columns = list(columns)
    keys = [F.col(c) for c in columns]
    kept = F.lit(False) if apart is None else apart
    numbers = file_numbers(df, file_col) if file_col else None
    if numbers is not None:
        unknown = F.raise_error(F.concat(F.lit(f"{file_col} is no file that is read: "),
                                         F.coalesce(file_col, F.lit("null"))))
        df = df.join(numbers, file_col, "left").withColumn(
            "_file", F.coalesce("_file", unknown.cast("long")))
        lineage = F.min("_file").alias("_file")
        of_file = F.col("_file")
    else:
        lineage = F.min(file_col).alias(file_col) if file_col else None
        of_file = F.col(file_col) if file_col else F.lit(None)
    grouped = df.groupBy(
        *keys, kept.alias("_apart"),
        F.when(kept, F.spark_partition_id()).alias("_part"),
        F.when(kept, of_file).alias("_of_file")).agg(
            F.count(F.lit(1)).alias(COPIES), *([lineage] if lineage is not None else []))
    if apart is not None:
        # a task's copies at most: the rows that stay apart are laid out again
        again = F.explode(F.when(F.col("_apart"), F.sequence(F.lit(1).cast("long"), F.col(COPIES)))
                          .otherwise(F.array(F.lit(0).cast("long"))))
        grouped = grouped.withColumn("_copy", again).withColumn(
            COPIES, F.when(F.col("_apart"), F.lit(1).cast("long")).otherwise(F.col(COPIES)))
    if numbers is not None:
        grouped = grouped.join(numbers, "_file", "left")
    return grouped.select(*columns, *([file_col] if file_col else []), COPIES)


def last_write_wins(df: DataFrame, keys: Sequence[str],
                    seq_col: str | Sequence[str]) -> DataFrame:
    """Per key, the row written last according to ``seq_col`` (one column, or several
    that are compared in order).

    ``seq_col`` must be a write sequence carried by the feed or assigned at
    the scan (``sources.with_sequence``, ``sources.with_write_order``); it is not
    recomputed here.
    """
    return keep_one_per_key(df, keys, order=seq_col, descending=True)
