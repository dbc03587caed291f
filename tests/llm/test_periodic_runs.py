import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from helpers import WORD, odd_documents, prose
from orderlake.llm import periodic_runs, queries


def brute(words, min_words=24, repeats=3):
    """(start, length, period) of all runs, by looking at every period."""
    out, n = [], len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_words, repeats * q) and j > i:
                stretch = words[i:j + q]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def digest_row(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs).encode()).hexdigest())


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256")


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS)
           for r in queries.op13_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    short = [d for d in docs if len(d["text"] or "") < 8000]
    assert len(short) > 150
    for d in short:
        assert got[d["doc_id"]] == digest_row(d["doc_id"], d["text"]), d["doc_id"]
    assert sum(r[0] > 0 for r in got.values()) >= len(got) // 20


@pytest.mark.parametrize("min_words, repeats", [(24, 3), (5, 3), (1, 3), (12, 4), (30, 5)])
def test_runs_are_those_of_all_periods(min_words, repeats):
    rng = random.Random(min_words * 10 + repeats)
    found = 0
    for _ in range(300):
        words = []
        while len(words) < rng.choice((0, 1, 30, 90, 200)):
            block = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.randint(1, 14))]
            words += block * rng.randint(1, 7)
        got = [(s, e - s, q) for s, e, q in periodic_runs.find_runs(
            np.array(words, np.int64), min_words, repeats).tolist()]
        assert got == brute(words, min_words, repeats)
        found += len(got)
    assert found > 100


def test_long_and_deep_texts():
    n = 200_000
    assert periodic_runs.find_runs(np.arange(n) % 60_000).tolist() == [[0, n, 60_000]]
    assert periodic_runs.find_runs(np.zeros(n, np.int64)).tolist() == [[0, n, 1]]
    assert not len(periodic_runs.find_runs(np.arange(n)))
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    got = periodic_runs.find_runs(np.array(b[:1500]))
    assert [(s, e - s, q) for s, e, q in got.tolist()] == brute(b[:1500])


def test_odd_documents(spark):
    docs = odd_documents(spark).unionByName(spark.createDataFrame(
        [(50, "a b " * 30 + "c", None, None, None, None, None, None, None, None),
         (51, (prose(3, 9) + "\n") * 4 + prose(4, 5), None, None, None, None, None, None, None,
          None)], odd_documents(spark, True).schema))
    out = periodic_runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "runs", "best", "collapsed"]
    rows = out.collect()
    assert len(rows) == docs.count()
    want = sorted((str(d["doc_id"]), " ".join(re.split(r"[ \t-\r]+", (d["text"] or "").strip(" \t\n"))))
                  for d in docs.collect() if d["doc_id"] not in (50, 51))
    assert sorted((str(r["doc_id"]), r["collapsed"]) for r in rows
                  if r["doc_id"] not in (50, 51)) == want
    by_id = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in by_id[50]["runs"]] == [(0, 60, 2)]
    assert by_id[50]["collapsed"] == "a b c"
    assert [tuple(x) for x in by_id[51]["runs"]] == [(0, 36, 9)]
    assert by_id[6]["runs"] == [] and by_id[6]["best"] is None and by_id[5]["collapsed"] == ""
    assert periodic_runs.periodic_runs(odd_documents(spark, True)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(9, np.int64), 24, 2)
