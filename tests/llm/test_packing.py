import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from helpers import key, odd_documents
from orderlake.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_pieces(rows, capacity):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    out = []
    for doc, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            out.append((doc, piece, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=key)


def check_places(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_and_places_match_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op2_best_fit_packing(spark, sf).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "text").collect()]
    want = brute_pieces(docs, 4096)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                   for r in got), key=key) == want
    used = check_places(got, 4096)
    total = sum(w[3] for w in want)
    assert used <= -(-total // 4096) + 1


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = packing.best_fit_pack(packing.tokenized_pieces(docs, PATH, 512), 512).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                   for r in got), key=key) == brute_pieces(
        [(r["doc_id"], r["text"]) for r in docs.collect()], 512)
    check_places(got, 512)


def test_empty_table(spark):
    pieces = packing.tokenized_pieces(odd_documents(spark, empty=True), PATH)
    assert packing.best_fit_pack(pieces).count() == 0


def test_special_strings_and_long_vocabularies():
    enc = packing.WordEncoder(PATH)
    texts = ["<|endoftext|> a", "it's O'Neil's 3.14,15. x.. y,, Ω.", None, "ΣΑΣ İstanbul ß ﬁ",
             "á é. 　wide space", "  two  spaces\r\n\ttab "]
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    want = [np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
            for t in texts]
    assert list(enc.encode(texts)) == want
    enc.words.limit = 3
    assert list(enc.encode(texts * 3)) == want * 3


def test_plan_is_complete_and_near_the_bound():
    rng = np.random.default_rng(1)
    for capacity in (10, 100, 4096):
        for spread in (capacity, capacity // 2, capacity // 3 + 1):
            sizes, counts = np.unique(rng.integers(1, spread + 1, 3000), return_counts=True)
            hist = dict(zip(sizes.tolist(), counts.tolist()))
            plan = packing.pack_plan(hist, capacity)
            bins, ranks = {}, {}
            for n, first, items, count, seq, offset in plan:
                for i in range(items * count):
                    bins.setdefault(seq + i // items, []).append((offset + i % items * n, n))
                    ranks.setdefault(n, []).append(first + i)
            assert {n: sorted(r) for n, r in ranks.items()} == {
                n: list(range(c)) for n, c in hist.items()}
            for parts in bins.values():
                at = 0
                for offset, n in sorted(parts):
                    assert offset == at
                    at += n
                assert at <= capacity
                assert sum(3 * n > capacity for _, n in parts) <= 2
            large = sum(c for n, c in hist.items() if 2 * n > capacity)
            assert len(bins) <= 1.06 * max(large, -(-sum(n * c for n, c in hist.items()) // capacity)) + 1


def test_added_tokens_are_those_of_a_plain_call(spark):
    tok = Tokenizer.from_file(PATH)
    texts = ["one doc.<|endoftext|>next doc", "<|ENDOFTEXT|> a", "<|startoftext|><|endoftext|>",
             "ΑΣ<|endoftext|>Σ.", "e<|endoftext|>\u0301a <|endof text|>", "<|endoftext|>'s x,\n<|", "",
             "A.<|<|startoftext|>|> İ<|endoftext|>", "x.. y,<|endoftext|> \n<|endoftext|>.", None]
    rows = []
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        rows.append((i, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    assert rows[0][3] == 7
    got = packing.tokenized_pieces(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"), PATH)
    assert sorted(map(tuple, got.collect())) == rows
    enc = packing.WordEncoder(PATH, True)
    enc.words.limit = 3
    assert [len(x) // 4 + 1 for x in enc.encode(texts * 2)] == [r[3] for r in rows] * 2


def test_every_ascii_character_around_marks():
    rng = random.Random(6)
    chars = [chr(i) for i in range(128)] + list(".,.,.,  \x1c\x1d\x1e\x1fab_é\x85\xa0")
    texts = ["".join(rng.choices(chars, k=rng.randint(1, 14))) for _ in range(8000)]
    texts += [f"a{chr(i)}{mark} b" for i in range(128) for mark in ".,"]
    plain = Tokenizer.from_file(PATH)
    for text, got in zip(texts, packing.WordEncoder(PATH, True).encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == plain.encode(
            text, add_special_tokens=False).ids, text
