import numpy as np

from helpers import classes, key, odd_documents, prose
from orderlake.llm import minhash, queries


def rows_of(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=key)


def test_whole_table_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "text").collect()]
    got = queries.op4_minhash_dedup(spark, sf)
    assert rows_of(got) == sorted(classes(docs), key=key)
    assert got.where("kept <> (doc_id = component_id)").count() == 0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = minhash.near_duplicates(docs)
    want = classes([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows_of(got) == sorted(want, key=key)
    assert minhash.near_duplicates(odd_documents(spark, empty=True)).count() == 0


def test_variants_that_link_only_through_their_original(spark):
    """Each variant is near the original, hardly any two variants are near each other."""
    words = prose(3, 300, 5000).split()
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        own = list(words)
        for at in rng.choice(295, 7, replace=False):
            own[at] = f"z{i}x{at}"
        rows.append((100 + i, " ".join(own)))
    rows.append((900, " ".join(words)))
    rows += [(1000 + i, prose(50 + i, 100, 5000)) for i in range(20)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == sorted(classes(rows), key=key)


def test_groups_without_a_centre_are_settled_in_blocks(spark):
    """Variants with different numbers of edits: some link to many, some to one,
    some to none; other texts share only a passage."""
    rng = np.random.default_rng(7)
    rows = []
    for g in range(3):
        words = prose(60 + g, 140, 5000).split()
        for i in range(50):
            own = list(words)
            for at in rng.choice(135, rng.integers(1, 9), replace=False):
                own[at] = f"v{g}x{i}x{at}"
            rows.append((1000 * g + i, " ".join(own)))
    passage = prose(90, 60, 5000)
    rows += [(5000 + i, f"{prose(700 + i, 60, 5000)} {passage}") for i in range(40)]
    before = minhash.BLOCK
    minhash.BLOCK = 500          # shingles
    try:
        got = rows_of(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    finally:
        minhash.BLOCK = before
    want = sorted(classes(rows), key=key)
    assert got == want
    assert 1 < len({c for d, _, c in want if d < 1000}) < 50      # a real mixture


def test_one_of_each_class_stays_with_all_columns(spark):
    docs = odd_documents(spark)
    got = minhash.keep_one(docs)
    assert got.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in got.collect()]
    bare = [t for t in texts if (t[1] or "").strip()]
    assert all(d == low for d, _, low in classes([(k, t) for k, (_, t) in enumerate(bare)]))
    assert sum(not (t[1] or "").strip() for t in texts) == 3
    assert (1, [t for i, t in texts if i == 1][0]) in texts and 3 not in [i for i, _ in texts]


def test_signature_is_the_shifted_minimum():
    shingles = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 50).astype(np.uint64))
    pi = np.random.default_rng(minhash.SEED).permutation(1 << minhash.UNIVERSE_BITS)
    place = minhash._mix(shingles ^ np.uint64(minhash.SEED)) >> np.uint64(64 - minhash.UNIVERSE_BITS)
    got = minhash.signature(shingles)
    for k in (0, 1, 77, minhash.COORDINATES - 1):
        assert got[k] == min(pi[(int(p) + k) % len(pi)] for p in place)
