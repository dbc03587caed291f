"""Join-side sizing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import input_bytes

# Largest side we broadcast: bytes of its files, times what columnar files grow
# to as rows in memory.
BROADCAST_MAX_BYTES = 128 << 20
EXPANSION = 4
# Bytes of columnar files whose rows one task of a large join sorts and passes on, and
# the most tasks: what a map and a reduce side keep of each other grows with both.
TASK_BYTES = 8 << 20
MAX_TASKS = 100_000


def broadcast_if_small(df: DataFrame, rows: int | None,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only when the side's size is known and small.

    ``rows`` must be a measured count (e.g. observed when the table was
    written); None leaves the side to the optimizer.  The size is that of the
    files the side reads, from file-system metadata, and at least eight bytes a
    value; a side that reads no files is sized by its values alone.  Larger
    sides keep a shuffled join with AQE's skew splitting.
    """
    if rows is None:
        return df
    folders = sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})
    size = max(8 * rows * len(df.columns),
               EXPANSION * input_bytes(df.sparkSession, folders))
    return F.broadcast(df) if size <= max_bytes else df


def deal_by_size(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                 n_bytes: int, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Both sides of an inner join on keys of one type, dealt by key over as many tasks
    as their files' ``n_bytes`` need.

    A task's sorted runs and the hash table of an aggregate behind the join then hold
    as many rows whatever the input size.  Left alone, AQE puts shuffle partitions
    together until there are as few tasks as cores.  Sides that the cores take in one
    go stay with the optimizer, which may broadcast one of them; beyond that the keys
    must be spread, as AQE splits no partition that was asked for.
    """
    n = tasks_for(left.sparkSession, n_bytes, task_bytes)
    if n is None:
        return left, right
    return left.repartition(n, left_key), right.repartition(n, right_key)


def tasks_for(spark: SparkSession, n_bytes: int, task_bytes: int = TASK_BYTES) -> int | None:
    """As many tasks as ``n_bytes`` of columnar files need; None if the cores take them
    in one go."""
    n = min(-(-n_bytes // task_bytes), MAX_TASKS)
    return None if n <= spark.sparkContext.defaultParallelism else n
