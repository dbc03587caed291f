import numpy as np
from pyspark.sql import functions as F

from orderlake.llm import ann_forest, queries


def brute(rows, k=20):
    out = {}
    data = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    for i, v in rows:
        if i % 20 == 0:
            s = data @ np.array(v, float)
            keep = ids != i
            best = np.lexsort((ids[keep], -s[keep]))[:k]
            out[i] = [(int(a), float(b)) for a, b in zip(ids[keep][best], s[keep][best])]
    return out


def test_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(rows), {}
    for r in queries.op7_ann_forest(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    vec, hits = dict(rows), 0
    for q, found in got.items():
        assert [x[0] for x in found] == list(range(1, 21))
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        for _, i, s in found:
            assert abs(s - np.dot(np.array(vec[q], float), np.array(vec[i], float))) < 1e-12
        hits += len({x[1] for x in found} & {i for i, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_several_blocks_and_unequal_norms(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 12))
    rows = [(i, (centres[i % 8] * rng.uniform(0.2, 3) + rng.normal(0, 0.3, 12)).tolist())
            for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    before = ann_forest.BLOCK_ROWS, ann_forest.BLOCK_QUERIES
    ann_forest.BLOCK_ROWS, ann_forest.BLOCK_QUERIES = 300, 25
    try:
        got = ann_forest.nearest(df, lambda i: i % 20 == 0, least=50).collect()
    finally:
        ann_forest.BLOCK_ROWS, ann_forest.BLOCK_QUERIES = before
    want = brute(rows)
    hits = sum(r["vec_id"] in {i for i, _ in want[r["query_id"]]} for r in got)
    assert len(got) == 20 * len(want) and hits >= 0.9 * len(got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [1.0, None]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [-1.0, 2.0]),
            (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows],
                               "vec_id long, embedding array<double>, rank string, score double")
    got = [tuple(r) for r in ann_forest.nearest(df, lambda i: i % 20 == 0)
           .orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 1.0), (0, 2, 8, 1.0), (0, 3, 20, 0.0), (0, 4, 9, -1.0),
                   (20, 1, 9, 2.0), (20, 2, 0, 0.0), (20, 3, 7, 0.0), (20, 4, 8, 0.0)]
    for none in (df.limit(0), df.where("embedding is null")):
        assert ann_forest.nearest(none, lambda i: i % 20 == 0).count() == 0


def test_forest_takes_whole_levels():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, 6))
    rows[100:300] = rows[0]                       # copies: all or none of them
    forest = ann_forest.Forest(rows, 9.0, np.zeros(7))
    for found in forest.found(rows[:5], 30):
        assert len(found) >= 30
        assert not 0 < len(set(found) & set(range(100, 300))) < 200


def test_descent_finds_the_longest_prefixes():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 70))
    asked = np.vstack([rows[:20], rng.normal(size=(20, 70))])
    forest = ann_forest.Forest(rows, 12.0, np.zeros(71), trees=5)
    assert forest.bits == 64
    near = np.column_stack([asked, np.zeros(len(asked))])
    for t, plane in enumerate(forest.planes):
        text = [f"{x:064b}" for x in forest._strings(near, plane).tolist()]
        kept = [f"{x:064b}" for x in forest.sorted[t].tolist()]
        assert kept == sorted(kept)
        want = [max(next((i for i in range(64) if a[i] != b[i]), 64) for b in kept) for a in text]
        assert forest._longest(t, forest._strings(near, plane)).tolist() == want
    for q, got in zip(range(40), forest.found(asked, 1)):      # no ascent: the deepest level only
        best, rows_at = -1, set()
        for t, plane in enumerate(forest.planes):
            a = f"{forest._strings(near[q:q + 1], plane)[0]:064b}"
            for place, x in zip(forest.order[t], forest.sorted[t].tolist()):
                same = next((i for i in range(64) if a[i] != f"{x:064b}"[i]), 64)
                if same > best:
                    best, rows_at = same, set()
                if same == best:
                    rows_at.add(int(place))
        assert set(got.tolist()) == rows_at


def test_reruns_and_partitions_agree(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=10).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    before = ann_forest.BLOCK_ROWS
    ann_forest.BLOCK_ROWS = 250
    try:
        runs = [sorted(map(tuple, ann_forest.nearest(x, lambda i: i % 20 == 0, least=30).collect()))
                for x in (df, df.repartition(7), df.orderBy(F.desc("vec_id")))]
    finally:
        ann_forest.BLOCK_ROWS = before
    assert runs[0] == runs[1] == runs[2]


def test_copies_tie_exactly(spark):
    rng = np.random.default_rng(6)
    vec = rng.normal(size=64)
    rows = [(i, (vec if i % 3 else rng.normal(size=64)).tolist()) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_forest.nearest(df, lambda i: i == 20).orderBy("rank").collect()
    copies = [i for i in range(700) if i % 3 and i != 20][:20]
    assert [r["vec_id"] for r in got] == copies and len({r["score"] for r in got}) == 1
