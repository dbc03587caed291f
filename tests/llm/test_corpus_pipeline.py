import corpus_pipeline
from helpers import WORD, classes, key, odd_documents
from orderlake.llm import quality
from orderlake.llm.common import materialize
from test_line_dedup import brute as brute_lines
from test_mixing import water
from test_packing import brute_pieces, check_places
from test_quality_rules import brute as brute_measures


def test_every_stage_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            out = materialize(out, "stage")
        after = out.collect()
        if name == "quality_rules":
            ids = {r["doc_id"] for r in after}
            measured = quality.measure(docs)
            judged = quality.judge(measured, quality.weigh(measured)).collect()
            assert ids == {r["doc_id"] for r in judged if r["_ql_kept"]}
            assert not any(brute_measures(r["text"])[-1] for r in after)
        elif name == "line_dedup":
            text = {r["doc_id"]: r["text"] for r in after}
            for row in brute_lines([(r["doc_id"], r["text"]) for r in before]):
                if len(row) == 3:
                    want = "\n".join(x for i, x in enumerate(row[2].split("\n")) if i not in row[1])
                    assert text.get(row[0], "").split() == want.split()
                else:
                    assert row[0] not in text
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "minhash_near_dedup":
            want = {d for d, _, c in classes([(r["doc_id"], r["text"]) for r in before]) if d == c}
            assert {r["doc_id"] for r in after} == want and len(after) == len(want)
        elif name == "source_mix":
            size = {r["doc_id"]: len(WORD.findall(r["text"])) for r in before}
            source = {r["doc_id"]: r["source"] for r in before}
            names = sorted(set(source.values()))
            total = [sum(n for d, n in size.items() if source[d] == s) for s in names]
            for s, t in zip(names, water(total, [(1, 2, 3)[i % 3] for i in range(len(names))])):
                taken = sum(size[r["doc_id"]] for r in after if r["source"] == s)
                assert abs(taken - t) <= max(size[d] for d in size if source[d] == s)
        else:
            want = brute_pieces([(r["doc_id"], r["text"]) for r in before], 4096)
            assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                           for r in after), key=key) == want
            check_places(after, 4096)
        docs, before = out, after


def test_stages_take_odd_documents(spark):
    for empty in (False, True):
        docs = odd_documents(spark, empty)
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, docs, "unused"), "stage")
            assert empty is (out.count() == 0) or not empty
            if name != "best_fit_packing":
                assert out.columns == docs.columns


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0
