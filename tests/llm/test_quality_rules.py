from collections import Counter

import numpy as np

from helpers import WORD, odd_documents, prose
from orderlake.llm import quality, queries


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op3_quality_rules(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert tuple(got[d["doc_id"]][c] for c in COLUMNS) == brute(d["text"])
    assert not any(r["kept"] and r["base_failed"] for r in got.values())


def test_verdicts_agree_with_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op3_quality_rules(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    c = Counter((r["quality"], r["kept"]) for r in got.where("not base_failed")
                .join(labels, "doc_id").select("quality", "kept").collect())
    assert c[1, True] >= 0.98 * (c[1, True] + c[1, False])
    assert c[0, False] >= 0.95 * (c[0, False] + c[0, True])


def test_odd_texts():
    repeat = "a b c d e f g h " * 3
    for text in (None, "", " \n", repeat, repeat + prose(1, 40), "x\nx\n x\n\nx", "é|ü & <b>",
                 "one" * 9, prose(4, 3000, 3), "a b c d e f g h i a b c d e f g h", "\x1c a\x85b"):
        got = quality.measures_of(text.encode() if text is not None else None)
        assert got[:5] == brute(text)[:5], text


def test_odd_documents(spark):
    docs = odd_documents(spark)
    measured = quality.measure(docs)
    assert measured.columns[:len(docs.columns)] == docs.columns
    out = quality.judge(measured, quality.weigh(measured)).collect()
    assert len(out) == docs.count()
    for r in out:
        assert (r["_ql_n_words"], r["_ql_n_repeat_words"]) == (brute(r["text"])[0], brute(r["text"])[4])
        assert r["_ql_kept"] in (True, False) and 0 <= r["_ql_p_good"] <= 1
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert quality.keep_good(odd_documents(spark, empty=True)).count() == 0


def test_em_tells_reliable_rules_from_noise():
    # rule 0 and 1 agree on bad documents; rule 2 cries bad at random, also on good ones
    patterns = [((-1, -1, 0, 0), 100), ((-1, 0, 0, 0), 40), ((0, -1, 0, 0), 40),
                ((0, 0, 0, 1), 900), ((0, 0, -1, 1), 300), ((-1, -1, -1, 0), 30)]
    prior, ratio = quality.estimate(patterns, 4)
    good = {p: prior + sum(ratio[k, v + 1] for k, v in enumerate(p)) > 0 for p, _ in patterns}
    assert good[(0, 0, -1, 1)] and good[(0, 0, 0, 1)]
    assert not good[(-1, -1, 0, 0)] and not good[(-1, 0, 0, 0)] and not good[(0, -1, 0, 0)]


def test_posterior_overrules_a_bad_rule(spark, tmp_path):
    """A forum where three clean texts in ten are full of exclamation marks: that rule's
    lone vote loses its weight, while junk that several rules see still goes."""
    def text(i):
        words = prose(i, 80, 5000).split()
        if i % 5 == 0:                                   # junk
            return " ".join(w + "%%%" if k % 2 else w + "|" for k, w in enumerate(words)), 0
        clean = [w + "." if k % 9 == 8 else w for k, w in enumerate(words)]
        if i % 10 in (1, 2, 3):
            clean = [w + "!" if k % 4 == 3 else w for k, w in enumerate(clean)]
        return " ".join(clean), 1

    rows = [(i, *text(i)) for i in range(2000)]
    spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"]: r["kept"] for r in queries.op3_quality_rules(spark, str(tmp_path)).collect()}
    truth = {i: bool(q) for i, _, q in rows}
    measured = quality.measure(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    votes = quality.judge(measured, quality.weigh(measured)).collect()
    names = [c for c in votes[0].asDict() if c.startswith("_ql_vote_")]
    all_pass = {r["doc_id"]: not r["_ql_base_failed"] and all(r[n] >= 0 for n in names)
                for r in votes}
    lone = [r["doc_id"] for r in votes if [n for n in names if r[n] < 0] == ["_ql_vote_bangs"]]
    assert len(lone) > 500 and all(kept[i] for i in lone) and not any(all_pass[i] for i in lone)
    right = [sum(v[i] == truth[i] for i in truth) for v in (kept, all_pass)]
    assert right[0] == 2000 and right[1] < 1500


def test_the_belief_has_a_fixed_size():
    # the third rule votes bad on half of the good documents and 60 % of the bad ones:
    # what is believed beforehand shows in a small corpus and not in a large one
    def off(times):
        patterns = [((-1, -1, 1), 80 * times), ((-1, -1, -1), 120 * times),
                    ((1, 1, 1), 1000 * times), ((1, 1, -1), 1000 * times)]
        return abs(quality.estimate(patterns, 3)[1][2, 0] - np.log(0.5 / 0.6))
    assert off(100) < 0.01 < off(1)
