import re

import pytest

from helpers import odd_documents, prose
from orderlake.llm import licenses, queries

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return TOKEN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    words = words_of(text)
    return len(words), sorted(
        (i, label) for phrase, label in licenses.BASE for i in range(len(words))
        if words[i:i + len(phrase.split())] == phrase.split())


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op12_license_scan(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    added = 0
    for d in docs:
        r, (n, places) = got[d["doc_id"]], base(d["text"])
        starts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None),
                                                     max(starts, default=None))
        labels = sorted({x for _, x in places})
        assert r["base_labels"] == ",".join(labels)
        every = set(r["labels"].split(",")) - {""}
        assert set(labels) <= every and r["labels"] == ",".join(sorted(every))
        assert (r["score"] == 1.0) if places else 0 <= r["score"] <= 1
        assert bool(every) == (r["score"] > 0)
        gnu = "gnu general public license version 3" in " ".join(words_of(d["text"]))
        assert ("gpl-3" in every) == gnu
        if not re.search("licen[sc]e|cc by", d["text"] or "", re.I):
            assert not every                               # clean documents stay clean
        added += bool(every - set(labels))
    assert added


@pytest.fixture(scope="module")
def index():
    common = {w.encode(): 500 for w in "the of and to in is a for with this or any by".split()}
    return licenses.Index(common, 1000)


def found(index, text):
    words = licenses.words_of(text.encode())
    return index.finds(words, licenses.base_places(b" %s " % b" ".join(words)))


def test_every_template_is_found_in_a_long_text(index):
    for label, _, texts in licenses.TEMPLATES:
        for text in texts:
            words = len(words_of(text))
            got = found(index, f"{prose(5, 3000)} {text.upper()} {prose(6, 3000)}")
            assert (3000, 3000 + words, label) in [f[:3] for f in got], text


def test_a_changed_text_is_found_and_key_phrases_decide(index):
    text = licenses.TEMPLATES[1][2][0]
    words = text.split()
    del words[40:44]
    words[60:60] = ["or", "parts", "thereof"]
    (start, end, label, share), = found(index, f"{prose(1, 90)} {' '.join(words)} {prose(2, 90)}")
    assert (start, label) == (90, "mit") and 0.75 <= share < 1
    assert not found(index, text.replace("free of charge", "for a fee"))
    assert not found(index, " ".join(sorted(words)))
    assert not found(index, prose(1, 90) + " public license gnu version 3 released terms")


def test_a_special_label_replaces_the_general_one(index):
    (f,) = found(index, "This work is licensed under the GNU General Public License, version 3.")
    assert f[2] == "gpl-3"
    (f,) = found(index, "It is licensed under the GNU General Public License as it stands")
    assert f[2] == "gpl"
    assert {f[2] for f in found(index, "Licensed under CC BY-NC 4.0.")} == {"cc-by-nc"}
    two = "licensed under the GNU General Public License " + prose(1, 40) + \
        " This work is licensed under the GNU General Public License, version 2"
    assert [f[2] for f in found(index, two)] == ["gpl", "gpl-2"]


def test_all_finds_of_a_text_that_repeats_a_notice(index):
    notice = "released under the BSD License " + prose(3, 30)
    got = found(index, notice * 50)
    assert len(got) == 50 and {f[2] for f in got} == {"bsd"}


def test_the_shortest_posting_lists_lose_no_find():
    text = "licensed under the GNU General Public License"
    for frequency in ({}, {w.encode(): 99 for w in words_of(text)},
                      {b"gnu": 100, b"general": 100, b"public": 90}):
        index = licenses.Index(frequency, 100)
        assert "gpl" in {f[2] for f in found(index, f"{prose(1, 20)} {text} {prose(2, 20)}")}


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = licenses.scan_licenses(docs).collect()
    assert len(rows) == docs.count()
    want = sorted((str(d["doc_id"]), base(d["text"])[0]) for d in docs.collect())
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in rows) == want
    assert all(r["score"] == 0 and not r["base"] and not r["found"] for r in rows)
    assert licenses.scan_licenses(odd_documents(spark, True)).count() == 0
    odd = "under the MİT license under the mit-license É under THE MIT license."
    assert base(odd)[1] == licenses.base_places(
        b" %s " % b" ".join(licenses.words_of(odd.encode()))) != []


def test_frequencies_count_every_document(spark):
    docs = spark.createDataFrame([("mit License " * 3,), ("license",), (None,), ("x",)],
                                 "text string")
    assert licenses.frequencies(docs) == ({b"mit": 1, b"license": 2}, 4)
