from collections import Counter

from helpers import odd_documents, prose
from orderlake.llm import line_dedup as ld


def words(text):
    return len(text.split())


def brute(rows, least=ld.MIN_WORDS):
    """Lines left of every row: each text against every earlier distinct text."""
    first = {}
    for doc, text in rows:
        if text and (text not in first or (first[text] is None, first[text]) > (doc is None, doc or 0)):
            first[text] = doc
    import hashlib
    order = sorted(first, key=lambda t: (first[t] is None, first[t] or 0,
                                         hashlib.md5(t.encode()).hexdigest()))
    gone = {}
    lines = {t: [x.strip(" \t\r\f\v") for x in t.split("\n") if x.strip(" \t\r\f\v")] for t in order}
    for k, t in enumerate(order):
        out = set()
        for e in order[:k]:
            if set(lines[e]) & set(lines[t]):
                for a, b in ld.common_blocks(lines[e], lines[t], [words(x) for x in lines[t]], least):
                    out.update(range(a, b))
        gone[t] = out
    result = []
    for doc, text in rows:
        if not text:
            result.append((doc, text))
        elif first[text] != doc and words(text) >= least:
            result.append((doc, ""))
        else:
            full = [i for i, x in enumerate(text.split("\n")) if x.strip(" \t\r\f\v")]
            drop = {full[i] for i in gone[text]}
            result.append((doc, drop, text))
    return result


def test_patience_matches_are_increasing_and_equal():
    cases = [("abcdef", "abxdef"), ("aabbcc", "abcabc"), ("", "a"), ("xaybzc", "paqbrc"),
             ("abcabc", "abc"), ("mnopq", "qponm")]
    for a, b in cases:
        got = ld.patience(list(a), list(b))
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    assert len(ld.patience(list("abcdef"), list("abxdef"))) == 5
    assert len(ld.patience(list("xaybzc"), list("paqbrc"))) == 3


def test_blocks_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in ld.dedup_lines(docs).collect()}
    differ = []
    for row in brute(rows):
        kept = got[row[0]]["_ld_text"]
        if len(row) == 2:
            assert kept == row[1]
            continue
        doc, drop, text = row
        want = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
        if kept != want:
            differ.append(doc)
            # a pair finds its first holders; what else differs is never a lost block alone
            assert len(kept) >= len(want)
    assert len(differ) <= 0.01 * len(rows)


def test_passages_go_from_all_but_the_first_holder(spark):
    passage, short = prose(77, 60), prose(78, 12)
    several = [prose(80 + i, 20) for i in range(4)]
    rows = [(i, f"{prose(200 + i, 40)}\n{short}\n{passage}\n{prose(300 + i, 30)}") for i in range(80)]
    rows += [(100 + i, "\n".join([prose(400 + i, 25), *several, short])) for i in range(80)]
    got = {r["doc_id"]: r for r in ld.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string"), rare=5).collect()}
    assert got[0]["_ld_text"] == rows[0][1] and got[100]["_ld_text"] == rows[80][1]
    for i in range(1, 80):
        assert passage not in got[i]["_ld_text"] and prose(200 + i, 40) in got[i]["_ld_text"]
        assert not any(x in got[100 + i]["_ld_text"] for x in several)
        assert got[i]["_ld_words"] == 72 and got[100 + i]["_ld_words"] == 92


def test_clean_documents_stay(spark):
    short = prose(5, 13)
    rows = [(i, f"{prose(500 + i, 60)}\n{short}\n{prose(600 + i, 30)}") for i in range(30)]
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["_ld_text"]) for r in got) == rows


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = ld.dedup_lines(docs)
    assert got.columns == [*docs.columns, *ld.ADDED]
    rows = Counter((r["doc_id"], r["_ld_text"], r["_ld_copy_of"]) for r in got.collect())
    assert sum(rows.values()) == docs.count()
    assert rows[(5, None, None)] == 1 and rows[(6, "", None)] == 1
    assert rows[(3, "", 1)] == 2 and rows[(None, "", 1)] == 1          # whole copies of 1
    assert rows[(10, "one two three", None)] == 1                      # too short
    assert rows[(14, prose(15, 30), None)] == 1
    clean = ld.clean_lines(docs)
    assert clean.columns == docs.columns
    assert clean.count() == docs.count() - 3
    assert ld.dedup_lines(odd_documents(spark, empty=True)).count() == 0


def shared_runs(a, b, sizes, least):
    """Lines of ``b`` in any run of ``least`` words that ``a`` holds, and the breaks inside runs."""
    lines, breaks = set(), set()
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if sum(sizes[j:j + n]) >= least:
                lines.update(range(j, j + n))
                breaks.update(range(j + 1, j + n))
    return lines, breaks


def test_blocks_are_all_shared_runs():
    import random
    rng = random.Random(11)
    size = {h: rng.choice((1, 5, 12, 30, 60)) for h in range(12)}
    for _ in range(3000):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(14))] for _ in range(2))
        if rng.random() < 0.6:
            x, y = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
            b[y:y] = a[x:x + 6] * rng.randrange(1, 3)
        sizes = [size[h] for h in b]
        got = ld.common_blocks(a, b, sizes, 50)
        assert ({j for x, y in got for j in range(x, y)},
                {j for x, y in got for j in range(x + 1, y)}) == shared_runs(a, b, sizes, 50)


def test_repeated_and_moved_passages_go(spark):
    f = [f"{prose(700 + i, 30)} f{i}" for i in range(20)]
    p, q, r, s, t = ("\n".join(prose(800 + 10 * k + i, 20) for i in range(3)) for k in range(5))
    texts = [[f[0], p, f[1], p, f[2]], [f[3], p, f[4]],                 # the earlier holds it twice
             [f[5], q, f[6]], [f[7], q, f[8], q, f[9]],                 # the later does
             [f[10], r, f[11], s, f[12]], [f[13], s, f[14], r, f[15]],  # another order
             [f[16], t, f[17]], [f[18], t, "tail line", f[19]], ["tail line", t, "tail line"]]
    rows = [(i, "\n".join(x)) for i, x in enumerate(texts)]
    rows += [(50 + i, f"{prose(900 + i, 20)}\ntail line") for i in range(40)]     # a frequent line
    got = {x["doc_id"]: x["_ld_text"] for x in ld.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].split("\n") for i in (1, 3, 5)] == [[f[3], f[4]], f[7:10], f[13:16]]
    assert got[7].split("\n") == [f[18], "tail line", f[19]]
    assert got[8] == "tail line"                        # with the passage of 7, not of its first holder
    assert all(got[i] == rows[i][1] for i in (0, 2, 4, 6))


def test_every_block_goes(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in ld.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, *rest in brute(rows):
        if len(rest) == 1:
            assert got[doc]["_ld_text"] == rest[0]
        else:
            assert got[doc]["_ld_text"] == "\n".join(
                x for i, x in enumerate(rest[1].split("\n")) if i not in rest[0])
