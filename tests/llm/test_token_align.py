import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from helpers import odd_documents
from orderlake.llm import queries, token_align

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tool():
    return token_align.Aligner(A, B)


@pytest.fixture(scope="module")
def plain():
    """Groups of a whole text by the two tokenizers' plain calls and the set of common ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = token_align.byte_of()
    names = {i: t for t, i in a.get_vocab().items()}

    def groups(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(byte[c] for c in names[i]) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in zip(ids_b, map(b.id_to_piece, ids_b))]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            return []
        out, i, j = [], 0, 0
        ends_a, ends_b = (np.cumsum([len(x) for x in r]).tolist() for r in (raw_a, raw_b))
        of_a, of_b = ({e: i for i, e in enumerate(x)} for x in (ends_a, ends_b))
        for end in sorted(of_a.keys() & of_b.keys()):
            to_i, to_j = of_a[end] + 1, of_b[end] + 1
            out.append((ids_a[i:to_i], ids_b[j:to_j]))
            i, j = to_i, to_j
        return out

    return groups


def as_text(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def test_align_divides_at_every_shared_end():
    rng = random.Random(4)
    for _ in range(500):
        n = rng.randint(1, 60)
        x, y = (sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n}) for _ in "ab")
        shared = sorted(set(x) & set(y))
        want, i, j = [], 0, 0
        for end in shared:
            want.append([i, x.index(end) + 1, j, y.index(end) + 1])
            i, j = want[-1][1], want[-1][3]
        assert token_align.align(np.array(x), np.array(y)).tolist() == want
    assert token_align.align(np.array([], int), np.array([], int)).tolist() == []


def test_words_give_the_tokens_of_whole_texts(tool, plain):
    rng = random.Random(7)
    chars = [chr(i) for i in range(128)] + list("  \n\n\t ") * 6 + list(
        "\xe9\xc9\xdfΣ中文\U0001f642　\xa0​▁﻿\x85 ́") + [
        "<|endoftext|>", "<s>", "<0x0A>", " the", " word", "  ", "\n\n", "'s", "'ll", "123", "..."]
    texts = ["".join(rng.choices(chars, k=rng.randint(1, 40))) for _ in range(3000)]
    texts += ["".join(rng.choices("ab \n\t\x1c !1'", k=rng.randint(1, 12))) for _ in range(3000)]
    texts += ["a" * 3000, "\n" * 300, " " * 999, "中文" * 800, "x" * 250 + " y", " ", "\n"]
    some = 0
    for at in range(0, len(texts), 100):
        bags, found = tool.words(texts[at:at + 100])
        for text, bag in zip(texts[at:at + 100], bags):
            whole = all(found[k] for k in bag)
            got = "".join(found[k][0] for k in bag)[:-1] if whole else ""
            assert got == as_text(plain(text)), text
            some += whole
    assert some > 5000


def brute(plain, docs):
    groups = [plain(t) for _, t in docs]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    held = Counter(p for one in links for p in set(one))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    return [(i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(one),
             sum(held[p] == most[p[0]] for p in one), sum(held[p] for p in one),
             hashlib.sha256(as_text(g).encode()).hexdigest() if g else "")
            for (i, _), g, one in zip(docs, groups, links)]


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_whole_table(spark, plain):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_token_alignment(spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]
    assert order(got.collect()) == order(brute(plain, docs))


def test_odd_documents_and_many_blocks(spark, plain):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        extra = spark.createDataFrame([(90, "a ▁b"), (91, "x " * 400), (92, "z" * 5000)],
                                      "doc_id long, text string")
        docs = odd_documents(spark).unionByName(extra, True).repartition(3)
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert order(token_align.align_documents(docs, A, B).collect()) == order(brute(plain, rows))
        groups = token_align.aligned_groups(docs, A, B).collect()
        assert sorted(r["groups"] or "" for r in groups) == sorted(
            as_text(plain(t)) for _, t in rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert token_align.align_documents(odd_documents(spark, True), A, B).count() == 0


def test_large_groups_are_counted_by_id(tool, plain, monkeypatch):
    text = "中\U0001f642x" * 50 + "aaaa bbbb" * 40
    whole = dict(zip(["k"], tool.learn([text.replace(" ", "")])))["k"]
    monkeypatch.setattr(token_align, "PLAIN", 0)
    counted = next(tool.learn([text.replace(" ", "")]))
    pairs = Counter(np.frombuffer(whole[1], np.int64).tolist())
    by_id = Counter()
    for p, n in zip(np.frombuffer(counted[1], np.int64).tolist(),
                    np.frombuffer(counted[2], np.int64).tolist()):
        by_id[p] += n
    assert pairs == by_id and whole[0] == counted[0]


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 1 << 31, n) for n in (0, 1, 7, 500, 0, 30)]
    got = token_align.unpack(token_align.pack(*arrays))
    assert [got[n].tolist() for n in token_align.PACKED] == [a.tolist() for a in arrays]
