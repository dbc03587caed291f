import zlib

import numpy as np

from helpers import odd_documents, prose
from orderlake.llm import queries, toxicity


def auc(score, y):
    order = np.argsort(np.argsort(score))
    ones = y.sum()
    return (order[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.op6_toxicity(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    y, s = [], []
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        out = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert got[r["doc_id"]]["held_out"] == out
        if out:
            y.append(r["toxic"])
            s.append(got[r["doc_id"]]["score"])
    y, s = np.array(y), np.array(s)
    assert auc(s, y) > 0.93          # some 330 toxic examples to learn from
    assert ((s >= 0.5) & (y == 1)).sum() >= 0.55 * y.sum()
    assert ((s >= 0.5) & (y == 0)).sum() <= 0.03 * (y == 0).sum()


def test_unseen_misspelling_scores_like_the_word():
    rng = np.random.default_rng(0)
    texts = [prose(i, 60) for i in range(300)]
    y = rng.integers(0, 2, 300)
    texts = [t + " horrible horrible" if v else t for t, v in zip(texts, y)]
    model = toxicity.train(texts, y)
    values = model.words(["horrible", "horrrible", "horribl", "w1f", "!!"])
    assert values[0] > values[3] + 1 and values[1] > values[3] + 1 and values[2] > values[3] + 1
    assert np.isnan(values[4])


def test_odd_documents(spark):
    docs = odd_documents(spark).drop("digest")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (8, 0), (None, 1), (5, 0), (13, None)],
                                   "doc_id long, toxic int")
    for known in (labels, labels.where("toxic = 1"), labels.limit(0)):
        model = toxicity.fit(docs, known)
        out = toxicity.score(docs, model).collect()
        assert len(out) == docs.count()
        assert all(0 <= r["_tx_score"] <= 1 for r in out)
    assert toxicity.score(docs.limit(0), model).count() == 0
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", toxicity.held_out().alias("h")).collect()}
    assert held[None] is True
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items() if i is not None)
