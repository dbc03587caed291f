"""Mixing sources to target weights with whole documents.

Each source gets a target number of words from its weight, at most ``cap``
times what it holds; what a capped source cannot use is shared again by
weight among the others (water filling).  A source takes every document
``floor(target / size)`` times and fills the remaining budget with a subset:

* its documents are counted by exact length;
* a common share of every length is taken, so the subset looks like the source;
* the rest is a bounded-knapsack dynamic program over the remaining counts.  It
  first looks at the last ``WINDOW`` words only, after single documents, longest
  first; if that misses the budget, at all that is left, and then with 1, 2, 4, ...
  documents of every length given back, until it hits, nothing is left to give
  back (the result is then as near below the budget as the lengths allow), or the
  table would have more than ``TABLE_WORDS`` entries, in units of the lengths'
  common divisor;
* how many documents of each length to take is then fixed, and a seeded hash
  order says which.

Only (source, length, count) rows reach the fitting task of a source.  The
driver sees one row per source.

Defined results: a null text has size 0; documents of size 0 are taken as
often as their source is taken whole; a null source comes last; rows with null
or repeated ids count each by itself; texts of any length count whole; equal
sizes are chosen by the seeded hash, equal hashes by id; extra columns do no harm;
an empty table gives an empty result.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WORD, materialize, rank_in_group

WINDOW = 1 << 16            # budget that the dynamic program looks at first
TABLE_WORDS = 1 << 24       # entries of its largest table, some 10 bytes each
BROADCAST_SOURCES = 50_000  # more sources than this are joined by a shuffle
PLAN = pa.schema([("_mx_source", pa.string()), ("source_size", pa.int64()), ("target", pa.float64()),
                  ("_mx_whole", pa.int64()), ("_mx_budget", pa.int64())])


def targets(sizes: list[int], weights: list[int], cap: int = 3) -> list[float]:
    """Water filling: the total shared by weight, no source above ``cap`` times its size."""
    target = [0.0] * len(sizes)
    total = sum(sizes)
    open_ = set(range(len(sizes)))
    left = total
    while open_ and left > 0:
        share = Fraction(left, sum(weights[i] for i in open_))
        full = {i for i in open_ if share * weights[i] > cap * sizes[i]}
        if not full:
            for i in open_:
                target[i] = float(share * weights[i])
            break
        for i in full:
            target[i] = float(cap * sizes[i])
            left -= cap * sizes[i]
        open_ -= full
    return target


def knapsack(lengths: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """How many of ``free`` documents of each length come nearest to ``budget`` from below."""
    # reach[s] says that s words can be made; item[s] is the first item (length index,
    # copies) that made s, for the way back
    reach = np.zeros(budget + 1, bool)
    reach[0] = True
    item = np.full(budget + 1, -1, np.int32)
    items: list[tuple[int, int]] = []
    for i in np.argsort(lengths):
        n = int(lengths[i])
        left = min(int(free[i]), budget // n)
        copies = 1
        while left > 0 and not reach[budget]:
            k = min(copies, left)
            w = k * n
            at = np.flatnonzero(reach[:-w] & ~reach[w:]) + w
            item[at] = len(items)
            reach[at] = True
            items.append((int(i), k))
            left -= k
            copies *= 2
        if reach[budget]:
            break
    take = np.zeros(len(lengths), np.int64)
    s = int(np.flatnonzero(reach)[-1])
    while s:
        i, k = items[item[s]]
        take[i] += k
        s -= k * int(lengths[i])
    return take


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the words come to
    ``budget`` or as near below it as possible."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    unit = int(np.gcd.reduce(lengths))
    lengths, budget, total = lengths // unit, budget // unit, total // unit
    share = np.array([int(c) * budget // total for c in counts], np.int64)

    def words(take: np.ndarray) -> int:
        return int((lengths * take).sum())

    def fill(take: np.ndarray) -> np.ndarray:
        return take + knapsack(lengths, counts - take, budget - words(take))

    take, rest = share.copy(), budget - words(share)
    for i in np.argsort(-lengths):            # thins the budget, longest first
        k = min(int(counts[i] - take[i]), (rest - WINDOW // 2) // int(lengths[i]))
        if rest > WINDOW and k > 0:
            take[i] += k
            rest -= k * int(lengths[i])
    best = fill(take) if rest <= TABLE_WORDS else take
    back = 0
    while words(best) < budget:
        take = share - np.minimum(share, back)
        if budget - words(take) > TABLE_WORDS:
            break
        best = max(best, fill(take), key=words)
        if back >= share.max():
            break
        back = max(1, 2 * back)
    return best


def mix_sources(docs: DataFrame, seed: int = 7, cap: int = 3, weights: tuple[int, ...] = (1, 2, 3),
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken, and the columns ``keep``.

    ``weights`` repeat over the sources in code-point order, null last.
    ``copies`` (0 to ``cap``) is how often the mix takes the document.
    """
    # UTF-8 bytes order like code points, so a plain sort is the contract's order
    sized = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_mx_h"),
        *[c.alias(n) for n, c in (keep or {}).items()]), "mix-sizes")
    by_source = sorted(((r["source"], int(r["n"])) for r in
                        sized.groupBy("source").agg(F.sum("size").alias("n")).collect()),
                       key=lambda x: (x[0] is None, (x[0] or "").encode()))
    names, sizes = [x[0] for x in by_source], [x[1] for x in by_source]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], cap)
    spark = docs.sparkSession
    rows = [(s, n, float(t), *map(int, divmod(round(t), n) if n else (0, 0)))
            for s, n, t in zip(names, sizes, goal)]
    # as an Arrow table the JVM reads it; a list would start other Python workers
    plan = spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(PLAN), PLAN.types)],
        schema=PLAN))

    if len(names) <= BROADCAST_SOURCES:       # counted just now, some 50 bytes each
        plan = F.broadcast(plan)

    def on_source(df: DataFrame) -> DataFrame:
        return df.join(plan, df["source"].eqNullSafe(plan["_mx_source"])).drop("_mx_source")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        k = fit_budget(rows["size"].to_numpy(), rows["n"].to_numpy(), int(rows["_mx_budget"].iloc[0]))
        return pd.DataFrame({"_mx_src": rows["source"], "_mx_size": rows["size"], "_mx_k": k})

    lengths = on_source(sized.where("size > 0").groupBy("source", "size")
                        .agg(F.count(F.lit(1)).alias("n")))
    chosen = lengths.groupBy("source").applyInPandas(
        fit, "_mx_src string, _mx_size long, _mx_k long")
    ranked = rank_in_group(sized, ["source", "size"], F.col("_mx_h"), ["doc_id"], "_mx_rank")
    whole = on_source(ranked)
    out = whole.join(chosen, whole["source"].eqNullSafe(chosen["_mx_src"])
                     & (whole["size"] == chosen["_mx_size"]), "left")
    copies = F.col("_mx_whole") + F.coalesce(
        (F.col("_mx_rank") < F.col("_mx_k")).cast("long"), F.lit(0))
    return out.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"), *(keep or {}))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with all of its
    columns.  Rows that are equal in every column are taken as one row with the
    sum of their copies; texts are shuffled once, for the join of the copies."""
    inner = [f"_in_{i}" for i in range(len(docs.columns))]
    name = dict(zip(docs.columns, inner))
    row = F.concat_ws(":", F.xxhash64(*inner).cast("string"), F.md5(name[text_col]))
    keyed = docs.toDF(*inner).withColumn("_mx_row", row)
    mix = mix_sources(keyed, id_col=name[id_col], text_col=name[text_col],
                      source_col=name[source_col], keep={"_mx_taken": F.col("_mx_row")}, **options)
    often = mix.groupBy("_mx_taken").agg(F.sum("copies").cast("int").alias("_mx_n")) \
        .where("_mx_n > 0")
    once = keyed.join(often, F.col("_mx_row") == F.col("_mx_taken")).dropDuplicates(["_mx_row"])
    return once.withColumn("_mx_copy", F.explode(F.sequence(F.lit(1), "_mx_n"))) \
        .select(*[F.col(i).alias(c) for c, i in name.items()])
