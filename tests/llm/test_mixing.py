import itertools

import numpy as np

from helpers import WORD, odd_documents
from orderlake.llm import mixing, queries


def water(sizes, weights, cap=3):
    """The contract's rounds, step by step."""
    target = [0.0] * len(sizes)
    free, left = set(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / total > cap * sizes[i] + 1e-9}
        if not over:
            for i in free:
                target[i] = left * weights[i] / total
            break
        for i in over:
            target[i] = float(cap * sizes[i])
        left -= sum(cap * sizes[i] for i in over)
        free -= over
    return target


def test_targets():
    for sizes in ([10, 10, 10], [1, 100, 100], [0, 5, 1, 1000], [7], [0, 0], [3, 1, 4, 1, 5, 9, 2]):
        weights = [(1, 2, 3)[i % 3] for i in range(len(sizes))]
        assert np.allclose(mixing.targets(sizes, weights), water(sizes, weights))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.op8_source_mixing(spark, sf).collect()}
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in docs}
    sources = sorted({d["source"] for d in docs})
    total = [sum(size[d["doc_id"]] for d in docs if d["source"] == s) for s in sources]
    want = dict(zip(sources, water(total, [(1, 2, 3)[i % 3] for i in range(len(sources))])))
    taken = dict.fromkeys(sources, 0)
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert r["size"] == size[d["doc_id"]]
        assert r["source_size"] == dict(zip(sources, total))[d["source"]]
        assert abs(r["target"] - want[d["source"]]) < 1e-6
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
        taken[d["source"]] += r["taken"]
    for s in sources:
        assert abs(taken[s] - want[s]) <= 1
    again = {r["doc_id"]: r["taken"] for r in queries.op8_source_mixing(spark, sf).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}


def test_budget_against_all_subsets():
    rng = np.random.default_rng(0)
    for _ in range(40):
        lengths = np.unique(rng.integers(1, 30, 4))
        counts = rng.integers(1, 4, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 3))
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert int((lengths * take).sum()) == nearest(lengths, counts, budget)


def nearest(lengths, counts, budget):
    """The largest sum of any subset that is no more than the budget."""
    return max(s for c in itertools.product(*[range(b + 1) for b in counts])
               if (s := int((lengths * c).sum())) <= budget)


def test_long_texts_only():
    lengths, counts = np.array([700_001, 700_003, 900_007]), np.array([5, 5, 5])
    for budget in (5_000_000, 699_999, 700_002, 3_123_456, 9_999_999, 11_500_054):
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take <= counts).all()
        assert int((lengths * take).sum()) == nearest(lengths, counts, budget)
    # a common divisor is divided out: 10^12 words are a table of some hundred entries
    lengths, counts = np.array([3, 5, 7]) * 10 ** 10, np.array([9, 9, 9])
    take = mixing.fit_budget(lengths, counts, 10 ** 12 + 12345)
    assert int((lengths * take).sum()) == 10 ** 12
    # counts and budgets whose product is beyond 64 bits
    take = mixing.fit_budget(np.array([1000, 3001]), np.array([10 ** 10, 10 ** 10]), 2 * 10 ** 13 + 7)
    assert 0 <= 2 * 10 ** 13 + 7 - int((np.array([1000, 3001]) * take).sum()) < 1000


def test_large_budgets_are_met():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(20, 20000, 3000))
    counts = rng.integers(1, 40, len(lengths))
    total = int((lengths * counts).sum())
    for share in (0.1, 0.37, 0.9):
        take = mixing.fit_budget(lengths, counts, int(total * share))
        assert int((lengths * take).sum()) == int(total * share)
        assert (take <= counts).all()


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
    total = {s: sum(r["size"] for r in rows) for s, rows in by.items()}
    order = sorted(by, key=lambda s: (s is None, s or ""))
    want = water([total[s] for s in order], [(1, 2, 3)[i % 3] for i in range(len(order))])
    for s, t in zip(order, want):
        assert all(abs(r["target"] - t) < 1e-6 and r["source_size"] == total[s] for r in by[s])
        assert all(0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in by[s])
        assert sum(r["taken"] for r in by[s]) <= t + 1
    assert mixing.mix_sources(odd_documents(spark, empty=True)).count() == 0


def test_the_plan_of_the_sources_starts_no_other_python_workers(spark):
    docs = spark.createDataFrame([(i, "a b c " * (i + 1), s) for i, s in enumerate(["x", None, "é", "x"])],
                                 "doc_id long, text string, source string")
    plan = mixing.mix_sources(docs)._jdf.queryExecution().optimizedPlan().toString()
    # a list of rows would be an RDD that workers of another kind unpickle
    assert not [x for x in plan.splitlines() if "ExistingRDD" in x or "LogicalRDD" in x]


def test_a_worker_keeps_the_things_of_one_operator():
    from orderlake.llm.common import worker_state

    worker_state("one")["cache"] = 1
    assert worker_state("one") == {"cache": 1}
    assert worker_state("other") == {} and worker_state("one") == {}
