"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard.

A document's set is its distinct five-word shingles.  One permutation places
the shingles, a second one, shifted circularly by k, gives signature
coordinate k: for a shingle at place p the coordinates are a contiguous slice
of the second permutation, so a signature is a running minimum over slices.
Bands of coordinates make candidate buckets.

Within a bucket not all pairs are made.  Documents with equal sets are one
node.  The member of a bucket that shares most buckets with others, which is the
original in a group of copies, is compared with all of the bucket on full sets,
and what is linked becomes a component.  Buckets that still hold several
components are settled around the largest: their other members are compared
with all of it and with each other, in blocks of bounded size, inside tasks that
emit only links that join components.  So every two documents that share a
bucket are in one component or have been compared, no bucket is capped, and the
pairs that are made grow with the documents.

With 36 bands of 5 coordinates a pair at the threshold shares no band with a
chance of 6e-5, at a similarity of 0.8 with 6e-7.  All that share one and whose sizes
allow the threshold are compared on full sets of 64-bit hashes.

Defined results: a text without words has an empty set and links with nothing;
a document's class is the smallest id reachable; null ids take part but never
name a class unless all ids of the class are null (class null, kept); rows
that repeat an id and a text are one node.  Texts of any length have their whole set;
an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WordCache, discard, map_batches, materialize, utf8, worker_state

SHINGLE = 5
BANDS, ROWS = 36, 5
COORDINATES = BANDS * ROWS
UNIVERSE_BITS = 22
SEED = 20240229
BLOCK = 600_000            # shingles on either side of a comparison in blocks, on average


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _word_hashes() -> WordCache:
    """Hashes of the words met lately, kept by the worker."""
    from xxhash import xxh3_64_intdigest

    cache = worker_state("minhash").setdefault("word hashes", WordCache(xxh3_64_intdigest))
    if len(cache) > cache.limit:
        cache.age()
    return cache


def shingle_set(text: bytes | None, words_of: dict) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a UTF-8 text, A-Z lower-cased."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(words_of.__getitem__, words)), np.uint64)
    n = len(h)
    if n < SHINGLE:
        key = h[:1] + np.uint64(n)          # the whole sequence, apart from full shingles
        for i in range(1, n):
            key = _mix(key) + h[i:i + 1]
        return _mix(key + np.uint64(n))
    key = h[:n - SHINGLE + 1].copy()
    for i in range(1, SHINGLE):
        key *= np.uint64(0x9E3779B97F4A7C15)
        key += h[i:n - SHINGLE + 1 + i]
    key = _mix(key)
    key.sort()
    return key[np.concatenate(([True], key[1:] != key[:-1]))]


def _permutation() -> np.ndarray:
    """The second permutation, extended so that every slice is contiguous."""
    state = worker_state("minhash")
    if "pi" not in state:
        pi = np.random.default_rng(SEED).permutation(1 << UNIVERSE_BITS).astype(np.int32)
        state["pi"] = np.lib.stride_tricks.sliding_window_view(
            np.concatenate((pi, pi[:COORDINATES - 1])), COORDINATES)
    return state["pi"]


def signature(shingles: np.ndarray) -> np.ndarray:
    """All ``COORDINATES`` from two permutations: place, then shifted minima."""
    slices = _permutation()
    place = (_mix(shingles ^ np.uint64(SEED)) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)
    out = None
    for i in range(0, len(place), 256):
        low = slices[place[i:i + 256]].min(axis=0)
        out = low if out is None else np.minimum(out, low)
    return out


def _bands(signatures: np.ndarray) -> np.ndarray:
    rows = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for i in range(ROWS):
        key = _mix(key + rows[:, :, i])
    return key.astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, key_col: str | None) -> DataFrame:
    """doc_id, key, n_shingles, digest (of the set; null if empty), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            words = _word_hashes()
            sets = [shingle_set(t, words) for t in utf8(batch.column(1))]
            some = [s for s in sets if len(s)]
            sigs = np.stack([signature(s) for s in some]) if some \
                else np.empty((0, COORDINATES), np.int32)
            at = iter(range(len(some)))
            where = [next(at) if len(s) else None for s in sets]
            bands = _bands(sigs)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                          for s in sets], pa.binary()),
                pa.array([None if i is None else bands[i] for i in where], pa.list_(pa.int64()))],
                names=["doc_id", "key", "n_shingles", "digest", "bands"])

    key = F.lit(None).cast("string") if key_col is None else F.col(key_col)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col),
                       key.alias("key"))
    return map_batches(slim, run, "doc_id long, key string, n_shingles long, digest binary, "
                                  "bands array<long>")


def _sets(docs: DataFrame, text_col: str) -> DataFrame:
    """digest and full set (every 64-bit shingle hash, sorted) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            words = _word_hashes()
            found = {}
            for text in utf8(batch.column(0)):
                s = shingle_set(text, words)
                if len(s):
                    raw = s.tobytes()
                    found[xxhash.xxh3_128_digest(raw)] = raw
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())],
                names=["digest", "shingles"])

    return map_batches(docs.select(text_col), run, "digest binary, shingles binary")


def _hashes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def _linked(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    def side(name: str, df: DataFrame, *columns: str) -> DataFrame:
        return df.select(F.col("digest").alias(name),
                         *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            good = []
            for x, y in zip(at["shingles_a"].to_pylist(), at["shingles_b"].to_pylist()):
                both = len(np.intersect1d(_hashes(x), _hashes(y), assume_unique=True))
                good.append(100 * both >= percent * ((len(x) + len(y)) // 8 - both))
            yield pa.RecordBatch.from_arrays([at["a"], at["b"]], names=["a", "b"]) \
                .filter(pa.array(good, pa.bool_()))

    # sets of too different sizes can't reach the threshold
    sized = pairs.join(side("a", nodes, "n"), "a").join(side("b", nodes, "n"), "b") \
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    whole = sized.join(side("a", sets, "shingles"), "a").join(side("b", sets, "shingles"), "b")
    return map_batches(whole.select("a", "b", "shingles_a", "shingles_b"), check,
                       "a binary, b binary")


def _rest(members: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame,
          percent: int) -> DataFrame:
    """Links (a, b) between what shares a bucket but no component yet.

    A bucket that holds several components is settled around the largest of
    them: all of its other members are compared with every node of that
    component and with each other, in blocks.  A task holds two blocks of sets,
    each of some ``BLOCK`` shingles however long the texts (or one longer set),
    counts exact intersections through an inverted index, and emits links that join
    components, never all of them.
    """
    size = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sized = roots.join(size, "root").withColumnRenamed("node", "digest")
    known = members.select("band", "digest").join(sized, "digest", "left").select(
        "band", "digest", F.coalesce("root", "digest").alias("root"),
        F.coalesce("size", F.lit(1)).alias("size"))
    main = known.groupBy("band").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.max(F.struct("size", "root")).alias("top")) \
        .where("lo <> hi").select("band", F.col("top.root").alias("main"))
    loose = materialize(known.join(main, "band").where("root <> main")
                        .select("main", "digest", "root").distinct(), "mh-loose")
    mains = loose.select("main").distinct()
    own = mains.join(roots.withColumnRenamed("root", "main"), "main").select(
        "main", F.col("node").alias("digest"), F.col("main").alias("root"))
    alone = mains.join(roots.select(F.col("root").alias("main")).distinct(), "main", "left_anti") \
        .select("main", F.col("main").alias("digest"), F.col("main").alias("root"))
    every = loose.withColumn("asks", F.lit(True)).union(
        own.union(alone).withColumn("asks", F.lit(False)))
    counts = every.join(nodes.select("digest", "n"), "digest").groupBy("main").agg(
        F.ceil(F.sum(F.when(F.col("asks"), F.col("n"))) / BLOCK).cast("int").alias("askers"),
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("others"))
    placed = every.join(counts, "main").withColumn("h", F.xxhash64("digest"))

    def deal(side: bool, own_: str, all_: str) -> DataFrame:
        mine = F.pmod("h", F.col(own_)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(all_) - 1))
        i, j = (mine, theirs) if side else (theirs, mine)
        rows = placed.where("asks") if side else placed
        return rows.select("main", "digest", "root", F.lit(side).alias("asks"),
                           i.alias("i"), j.alias("j"))

    dealt = deal(True, "askers", "others").union(deal(False, "others", "askers"))
    return dealt.join(sets, "digest").groupBy("main", "i", "j").applyInPandas(
        lambda rows: _settle(rows, percent), "a binary, b binary")


def _settle(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the asking rows and the others that join components."""
    mine, others = rows[rows["asks"]], rows[~rows["asks"]]
    sets = [_hashes(x) for x in others["shingles"]]
    length = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(sets)), length)[order]
    digest, root = others["digest"].tolist(), others["root"].tolist()
    joined: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while x in joined:
            x = joined[x]
        return x

    a, b = [], []
    for d, r, raw in zip(mine["digest"], mine["root"], mine["shingles"]):
        x = _hashes(raw)
        lo, n = np.searchsorted(flat, x), np.searchsorted(flat, x, "right")
        n = n - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        for k in np.flatnonzero(100 * both >= percent * (len(x) + length - both)):
            p, q = find(r), find(root[k])
            if p != q:
                joined[p] = q
                a.append(d)
                b.append(digest[k])
    return pd.DataFrame({"a": a, "b": b}, dtype=object)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node reachable, by neighbour minima and pointer
    jumping until nothing changes.  Every step is a join and a grouped minimum."""
    both = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                       .union(edges.select(F.col(b), F.col(a))).distinct(), "cc-edges")
    roots = materialize(both.groupBy("u").agg(F.min("v").alias("v")).select(
        F.col("u").alias("node"), F.least("u", "v").alias("root")), "cc-roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("v"), "root"), "v") \
            .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        low = roots.join(near, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("low"))
        jump = roots.select(F.col("node").alias("low"), F.col("root").alias("jump"))
        new = materialize(low.join(jump, "low").select(
            "node", F.least("low", "jump").alias("root"), "was"), "cc-roots")
        changed = new.where("root <> was").limit(1).count()
        discard(roots)
        roots = new.select("node", "root")
        if not changed:
            discard(both)
            return roots


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id",
                    text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """doc_id, key (the column ``key_col``), n_shingles, digest, root (the class),
    component_id, kept: one row per document."""
    prints = materialize(fingerprints(docs, id_col, text_col, key_col), "mh-prints")
    full = prints.where("digest is not null")
    nodes = materialize(full.groupBy("digest").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands")), "mh-nodes")
    spread = nodes.select("digest", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sharing = materialize(spread.join(shared, "band"), "mh-members")
    score = sharing.groupBy("digest").agg(F.sum("size").alias("score"))
    whole, nodes = nodes, nodes.drop("bands")
    sets = materialize(
        _sets(docs, text_col).join(score.select("digest"), "digest", "left_semi")
        .groupBy("digest").agg(F.first("shingles").alias("shingles")), "mh-sets")
    members = materialize(sharing.join(score, "digest").select(
        "band", "digest", F.col("score").alias("score")), "mh-scored")

    # one pivot a bucket, found by a plain maximum, against its members
    top = members.groupBy("band").agg(F.max(F.struct("score", "digest")).alias("top")) \
        .select("band", F.col("top.digest").alias("pivot"))
    pairs = members.join(top, "band").where("digest <> pivot").select(
        F.least("digest", "pivot").alias("a"), F.greatest("digest", "pivot").alias("b")).distinct()
    edges = materialize(_linked(pairs, nodes, sets, percent), "mh-links")
    roots = components(edges)
    more = materialize(_rest(members, roots, nodes, sets, percent), "mh-more")
    if more.limit(1).count():
        discard(roots)
        roots = components(edges.union(more))

    ends = nodes.join(roots.withColumnRenamed("node", "digest"), "digest", "left") \
        .select("digest", "doc", F.coalesce("root", "digest").alias("root"))
    low = ends.groupBy("root").agg(F.min("doc").alias("component_id"))
    classes = materialize(ends.join(low, "root").select("digest", "root", "component_id"),
                          "mh-classes")
    for done in (whole, sharing, members, sets, edges, more, roots):
        discard(done)
    out = prints.select("doc_id", "key", "n_shingles", "digest").join(classes, "digest", "left")
    out = out.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id"))
                         .otherwise(F.col("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                             F.col("component_id").isNull()))


def keep_one(docs: DataFrame, percent: int = 75, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One document of each class, all of its columns.  Documents without words
    stay; of rows that repeat an id and a text, one stays."""
    keyed = docs.withColumn("_mh_key", F.concat_ws(
        ":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(F.col(text_col))))
    slim = keyed.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), "_mh_key")
    out = near_duplicates(slim, percent, key_col="_mh_key")
    keep = out.where("kept and digest is not null").groupBy("root") \
        .agg(F.min("key").alias("_mh_keep")).select("_mh_keep").distinct()
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = keyed.where(words).join(keep, F.col("_mh_key") == F.col("_mh_keep"), "left_semi") \
        .dropDuplicates(["_mh_key"])
    return first.unionByName(keyed.where(~words)).drop("_mh_key")
