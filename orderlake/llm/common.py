"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.session import scratch_path

# ASCII white space as the contracts define it; Python's bytes.split() and
# bytes.lower() use exactly this class and A-Z.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Shuffle width of the session: how many parts a hot group is dealt into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared work folder and read it back.

    Cuts lineage: later jobs reread the files, from any executor, instead of
    recomputing the plan above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame | None) -> None:
    """Delete the files of a frame made by ``materialize`` that nothing reads any more."""
    if df is None:
        return
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | StructType) -> DataFrame:
    """``mapInArrow`` over batches of at most ``BATCH_ROWS`` rows, which is what a
    worker and the JVM beside it hold of the texts at a time."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes

        yield from fn(batches)
        try:        # an idle worker gives back what its task has freed
            pa.default_memory_pool().release_unused()
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass

    return df.mapInArrow(run, schema)


def worker_state(owner: str) -> dict:
    """What a Python worker keeps from one task of ``owner`` to the next.  One owner's
    things at a time: workers outlive a stage, what it learned is of no use to others."""
    import sys

    if getattr(sys, "_orderlake_owner", None) != owner:
        sys._orderlake_owner, sys._orderlake_state = owner, {}
    return sys._orderlake_state


class WordCache(dict):
    """word -> value for the words met lately.  When ``limit`` words are in, they
    become the older half; a word used again moves back, the rest is forgotten."""

    def __init__(self, value: Callable | None = None, limit: int = 100_000):
        super().__init__()
        self.value, self.limit, self.old = value, limit, {}

    def __missing__(self, word):
        found = self.old.get(word)
        if found is None:
            if self.value is None:
                raise KeyError(word)
            found = self.value(word)
        self[word] = found
        return found

    def unknown(self, words: Iterable) -> list:
        """The words that must be learned.  Older ones move back."""
        if len(self) >= self.limit:
            self.age()
        out, old = [], self.old
        for w in words:
            if w not in self:
                if (found := old.get(w)) is None:
                    out.append(w)
                else:
                    self[w] = found
        return out

    def age(self) -> None:
        """Forget the older half."""
        self.old = dict(self)
        self.clear()


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes (None for null)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def rank_in_group(df: DataFrame, group: list[str], order: Column, ties: list[str],
                  out: str = "rank") -> DataFrame:
    """0-based position of every row in its group, in the order of the 64-bit
    hash ``order`` (ties by the columns ``ties``), without a task that holds a
    whole group.

    The hash's top bits deal a group into slices; rows are numbered inside a
    slice and a running sum over the (group, slice) counts adds what precedes
    it.  The slice count follows the session's shuffle width, so a group with
    a third of all rows is spread over all tasks.
    """
    n = width(df.sparkSession)
    # 63 bits, so that slices and the order inside them agree for any slice count
    sliced = (df.withColumn("_rk_h", F.shiftrightunsigned(order, 1))
              .withColumn("_rk_s", F.floor(F.shiftright("_rk_h", 32)
                                           * F.lit(n) / F.lit(float(1 << 31))).cast("int")))
    counts = sliced.groupBy(*group, "_rk_s").agg(F.count(F.lit(1)).alias("_rk_n"))
    before = Window.partitionBy(*group).orderBy("_rk_s").rowsBetween(
        Window.unboundedPreceding, -1)
    base = counts.select(*[F.col(c).alias(f"_rk_{i}") for i, c in enumerate(group)],
                         F.col("_rk_s").alias("_rk_t"),
                         F.coalesce(F.sum("_rk_n").over(before), F.lit(0)).alias("_rk_base"))
    inside = Window.partitionBy(*group, "_rk_s").orderBy("_rk_h", *ties)
    numbered = sliced.withColumn("_rk_i", F.row_number().over(inside) - 1)
    on = [F.col(c).eqNullSafe(F.col(f"_rk_{i}")) for i, c in enumerate(group)]
    on.append(F.col("_rk_s") == F.col("_rk_t"))
    joined = numbered.join(base, on)
    return joined.withColumn(out, F.col("_rk_base") + F.col("_rk_i")).select(
        *df.columns, out)
