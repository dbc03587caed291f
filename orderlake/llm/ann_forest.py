"""Nearest neighbours by inner product with a forest of hash prefixes.

Maximum inner product becomes nearest distance by one more coordinate, the
square root of what a vector's norm lacks to the largest norm (0 for queries);
the mean is taken off both.  A tree hashes a vector to a long string of signs of
orthogonal random projections (64, or as many as there are coordinates), and keeps
its rows sorted by that string.

A query descends in every tree to the rows that share the longest prefix with
its own string, wherever that ends, and then ascends in all trees together, one
bit at a time, until the rows found are at least ``share`` of the block (and
``least``).  A level is always taken whole.  The rows found are scored on the
original vectors in double precision.

Rows and queries are dealt into blocks of bounded size; a task holds one block
of each and the forest over its rows.  Block numbers come from a hash of id and
vector, so reruns agree, and copies of a vector are spread like any other rows.

The strings prune less the more diffuse the data: on vectors whose twentieth
neighbour is at a cosine of 0.43 close to half of the rows must be seen for a recall
well above 0.9, which is what the default ``share`` is set to.

Defined results: vectors that are null, empty, zero, not finite somewhere, or
not as long as most, and rows with a null id take no part; rows that repeat an id
and a vector count once; of several vectors under one id, the smallest is its
query and none is a neighbour of it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import materialize

TREES, BITS = 40, 64
SHARE, LEAST = 0.5, 500
BLOCK_ROWS, BLOCK_QUERIES = 8_000, 2_000
#: Queries of a block that descend together.
TOGETHER = 250
SEED = 17


class Forest:
    """Sorted arrays of sign strings, one per tree, over the rows of a block."""

    def __init__(self, rows: np.ndarray, norm: float, mean: np.ndarray, trees: int = TREES,
                 bits: int = BITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        width = rows.shape[1] + 1
        bits = min(bits, width, 64)
        self.bits, self.norm, self.mean = bits, norm, mean
        self.planes = [np.linalg.qr(rng.normal(size=(width, bits)))[0] for _ in range(trees)]
        lack = np.sqrt(np.maximum(norm ** 2 - np.einsum("ij,ij->i", rows, rows), 0))
        points = np.column_stack([rows, lack]) - mean
        self.order, self.sorted = [], []
        for plane in self.planes:
            code = self._strings(points, plane)
            order = np.argsort(code, kind="stable")
            self.order.append(order)
            self.sorted.append(code[order])
        self.n = len(rows)

    def _strings(self, points: np.ndarray, plane: np.ndarray) -> np.ndarray:
        """Sign strings as 64-bit numbers, the first sign on top."""
        signs = np.packbits(points @ plane > 0, axis=1)
        full = np.zeros((len(points), 8), np.uint8)
        full[:, :signs.shape[1]] = signs
        return full.view(">u8").ravel().astype(np.uint64)

    def _longest(self, t: int, code: np.ndarray) -> np.ndarray:
        """Length of the longest prefix that each string shares with one of tree ``t``:
        the neighbours of its place share most."""
        at = np.searchsorted(self.sorted[t], code)
        out = np.zeros(len(code), np.int64)
        for near in (at - 1, at):
            other = self.sorted[t][np.clip(near, 0, self.n - 1)] ^ code
            high, low = other >> np.uint64(32), other & np.uint64(0xFFFFFFFF)
            length = np.where(high > 0, 32 + np.frexp(high.astype(float))[1],
                              np.frexp(low.astype(float))[1])
            out = np.maximum(out, 64 - length)
        return np.minimum(out, self.bits)

    def found(self, queries: np.ndarray, want: int) -> list[np.ndarray]:
        """Row numbers for each query, after the synchronous ascent to ``want`` rows."""
        out = []
        for i in range(0, len(queries), TOGETHER):
            out.extend(self._found(queries[i:i + TOGETHER], min(want, self.n)))
        return out

    def _found(self, queries: np.ndarray, want: int) -> list[np.ndarray]:
        points = np.column_stack([queries, np.zeros(len(queries))]) - self.mean
        codes = [self._strings(points, plane) for plane in self.planes]
        longest = np.max([self._longest(t, c) for t, c in enumerate(codes)], axis=0)
        lo = np.empty((len(codes), longest.max() + 1, len(queries)), np.int64)
        hi = np.empty_like(lo)
        for level in range(lo.shape[1]):                # rows that share the first bits
            rest = np.uint64((1 << (64 - level)) - 1)
            for t, code in enumerate(codes):
                lo[t, level] = np.searchsorted(self.sorted[t], code & ~rest)
                hi[t, level] = np.searchsorted(self.sorted[t], code | rest, side="right")
        many = (hi - lo).sum(axis=0)                    # as if all were different
        out = []
        seen = np.zeros(self.n, bool)
        for q in range(len(queries)):
            seen[:] = False
            for level in range(longest[q], -1, -1):
                if many[level, q] < want and level:
                    continue
                for t, order in enumerate(self.order):
                    seen[order[lo[t, level, q]:hi[t, level, q]]] = True
                if np.count_nonzero(seen) >= want:
                    break
            out.append(np.flatnonzero(seen))
        return out


def _top(rows: pd.DataFrame, queries: pd.DataFrame, k: int, norm: float, mean: np.ndarray,
         share: float, least: int) -> pd.DataFrame:
    out: tuple[list, list, list] = ([], [], [])
    if len(rows) and len(queries):
        ids = rows["vec_id"].to_numpy()
        data = np.stack(rows["vec"].to_numpy()).astype(float)
        asked = np.stack(queries["vec"].to_numpy()).astype(float)
        forest = Forest(data, norm, mean)
        want = max(least, int(np.ceil(share * len(rows))))
        for q, vec, at in zip(queries["vec_id"].to_numpy(), asked, forest.found(asked, want)):
            at = at[ids[at] != q]
            if len(at) > 4 * k:                         # a first look, with room for rounding
                score = data[at] @ vec
                room = 1e-9 * np.abs(score).max()
                at = at[score >= np.partition(score, len(at) - k)[len(at) - k] - room]
            score = (data[at] * vec).sum(axis=1)        # equal for equal rows, wherever they stand
            best = np.lexsort((ids[at], -score))[:k]
            out[0].append(np.full(len(best), q))
            out[1].append(ids[at][best])
            out[2].append(score[best])
    a, b, c = (np.concatenate(x) if x else np.empty(0, np.int64) for x in out)
    return pd.DataFrame({"query_id": a, "vec_id": b, "score": c.astype(float)})


def nearest(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of every query row, in order."""
    good = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vec_col).cast("array<double>").alias("vec")) \
        .where(F.col("vec_id").isNotNull() & F.coalesce(
            F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vec", lambda x: x != 0), F.lit(False)))
    rows = materialize(good.dropDuplicates(), "ann-rows")
    shape = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "d").limit(1).collect()
    spark = vectors.sparkSession
    if not shape:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = shape[0]["d"], shape[0]["n"]
    rows = rows.where(F.size("vec") == d)
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    norm = float(rows.agg(F.max(square)).first()[0]) ** 0.5
    lack = F.sqrt(F.greatest(F.lit(norm ** 2) - square, F.lit(0.0)))
    mean = np.array(rows.agg(*[F.avg(F.col("vec")[i]) for i in range(d)], F.avg(lack)).first())
    mean = np.round(mean, 9)                            # sums differ by the order of rows

    blocks, asked = -(-n // BLOCK_ROWS), rows.where(is_query(F.col("vec_id"))) \
        .groupBy("vec_id").agg(F.min("vec").alias("vec"))
    asked = materialize(asked, "ann-queries")
    groups = max(1, -(-asked.count() // BLOCK_QUERIES))

    def deal(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        number = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(parts)).cast("int")
        return df.withColumn(own, number).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = deal(rows, "block", blocks, "part", groups)
    right = deal(asked, "part", groups, "block", blocks)
    near = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(
        lambda a, b: _top(a, b, k, norm, mean, share, least),
        "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
