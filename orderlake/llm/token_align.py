"""Alignment of two tokenizers' tokens over the same texts.

Tokenizer A is a byte-level BPE (``tokenizers``), B a piece model with byte fallback
(``sentencepiece``) that puts a blank before the text, as A is given one.  Both then
cut the same bytes.  Where a token of A and one of B end together is a shared cut.

Divide and conquer: an interval that ends at a shared cut is divided at another one
near its middle, found by bisecting B's ends for A's ends from the middle outwards,
and both halves are treated alike.  An interval without such a cut is a group: its
tokens are all linked with each other.

White space before which something stands is always a shared cut (that no piece of B
crosses it is verified when the model is loaded; A's pattern never does).  So texts
are first cut there, and what lies between, a word mostly, is tokenized and aligned
once while it stays in a bounded cache.

Counts of linked id pairs, in documents, are made in three steps: a task writes
blocks of documents (a batch each) with their distinct words and a block's pairs, each
with the number of the block's documents that hold it; these are added up by pair; each block
gets the sums of its own pairs back.  So a pair that all documents hold is one row a
block, and documents move once, as word numbers.

Defined results: texts that are null, empty, or not the same bytes in both
tokenizers (such as those with U+2581, which B takes for a blank) have no tokens:
zeros and an empty digest; strings of special tokens are plain text; null and repeated
ids (each row is a document) and extra columns do no harm; an empty table gives an
empty result; texts of any length are taken whole; pairs that tie for an A id's highest count are all best.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import WordCache, map_batches, materialize, worker_state

CUT = re.compile(r"(?<=\S)(?=[ \n])")       # shared cuts that every text has
ODD = re.compile(r"\s[ \n]")
B_BITS = 20                                 # of a pair number: A's id above, B's below
LONG = 200                                  # words beyond this many characters aren't kept
BULK = 15_000                               # new words that are tokenized together
PLAIN = 4096                                # links of a group that are written one by one


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Groups, rows (first a, end a, first b, end b), between the shared ends of two
    ascending rows of ends, whose last ends are the same.

    All intervals of a level are divided at once: each looks at A's ends from its
    middle outwards, one step a round, and bisects B's for them, until one is shared.
    """
    if not len(ends_a):
        return np.zeros((0, 4), np.int64)
    todo = np.array([[0, len(ends_a), 0, len(ends_b)]], np.int64)
    groups = []
    while len(todo):
        small = (todo[:, 1] - todo[:, 0] < 2) | (todo[:, 3] - todo[:, 2] < 2)
        groups.append(todo[small])
        todo = todo[~small]
        cut = np.full((len(todo), 2), -1, np.int64)
        open_, step = np.arange(len(todo)), 0
        while len(open_):
            a, to_a = todo[open_, 0], todo[open_, 1]
            middle = (a + to_a - 1) // 2
            at = middle + ((step + 1) // 2 if step % 2 else -(step // 2))
            inside = (at >= a) & (at < to_a - 1)          # the last end is no cut
            look, at = open_[inside], at[inside]
            j = np.searchsorted(ends_b, ends_a[at])
            shared = ends_b[j] == ends_a[at]
            cut[look[shared], 0], cut[look[shared], 1] = at[shared] + 1, j[shared] + 1
            step += 1
            open_ = open_[(cut[open_, 0] < 0) & (step < to_a - a + 1)]
        whole = cut[:, 0] < 0
        groups.append(todo[whole])
        todo, cut = todo[~whole], cut[~whole]
        left, right = todo.copy(), todo
        left[:, 1], left[:, 3] = cut[:, 0], cut[:, 1]
        right[:, 0], right[:, 2] = cut[:, 0], cut[:, 1]
        todo = np.concatenate([left, right])
    out = np.concatenate(groups)
    return out[np.argsort(out[:, 0])]


def byte_of() -> dict[str, int]:
    """Byte of every character of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others, in order, for U+0100 and after."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokens and groups of words: parts of " " + text between the cuts of ``CUT``.

    A word's key is the word without its first blank, or the word itself if it starts
    with a line break or with more white space.  What is known of a word is (groups as
    text, pairs, their times or None for once each, n_a, n_b, n_groups), or None if
    its bytes differ.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.path_a = path_a
        with open(path_a, encoding="utf-8") as f:
            file = json.load(f)
        vocab = file["model"]["vocab"] | {t["content"]: t["id"] for t in file["added_tokens"]}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = byte_of()
        bytes_a = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
                   for t, i in vocab.items()}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(r"[^▁]▁|\n", p) for p in pieces):
            raise ValueError("a piece crosses white space")
        if len(pieces) >= 1 << B_BITS:
            raise ValueError("too many pieces")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lead = len(self.b.encode("\n"))     # before a word: no blank is put there then
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64)
                                    for t in (self.bytes_a, self.bytes_b))
        # "id," and the id with what follows a group's last token
        self.text_a, self.text_b = (
            np.array([f"{i}{end}" for i in range(len(t)) for end in ("," + last)], object)
            for t, last in ((self.bytes_a, "|"), (self.bytes_b, ";")))
        self.fast = self._ranks(file)
        self.known = WordCache(limit=120_000)

    @cached_property
    def a(self):
        """The tokenizer itself, for what ``fast`` is not meant for."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path_a)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def _ranks(self, file: dict):
        """The same vocabulary for ``tiktoken``, which is faster, if ids follow merges."""
        import tiktoken
        from public_tokenizers import PATTERN

        kind, vocab = file["pre_tokenizer"], file["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        merged = [vocab.get("".join(m), -1) for m in pairs]
        if kind["type"] != "ByteLevel" or kind["add_prefix_space"] or file["normalizer"] \
                or min(merged, default=0) < 256 or any(np.diff(merged) <= 0):
            return None
        added = {t["id"] for t in file["added_tokens"]}
        return tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            self.bytes_a[i]: i for i in vocab.values() if i not in added})

    @staticmethod
    def keys(text: str) -> list[str]:
        body = " " + text
        if not ODD.search(body):
            return body.replace("\n", " \n")[1:].split(" ")
        return [w[1:] if w[0] == " " and not w[1:2].isspace() else w for w in CUT.split(body)]

    def learn(self, keys: list[str]) -> Iterator[tuple]:
        """What is to be known of each key, in order."""
        words = [k if k[:1] in (" ", "\n") else " " + k for k in keys]
        body = "".join(words)
        if self.fast and max(map(len, keys), default=0) <= LONG:
            a = self.fast.encode_ordinary(body)
        else:
            a = self.a.encode_batch_fast([body], add_special_tokens=False)[0].ids
        b = self.b.encode("\n" + body)[self.lead:]
        raw = body.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw \
                or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            if len(keys) > 1:               # which of them differ?
                yield from self.learn(keys[:len(keys) // 2])
                yield from self.learn(keys[len(keys) // 2:])
            elif keys:
                yield None
            return
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a = np.cumsum(self.size_a[a])
        groups = align(ends_a, np.cumsum(self.size_b[b]))
        first_a, to_a, first_b, to_b = groups.T
        n_a, n_b = to_a - first_a, to_b - first_b
        # tokens in the order of the text form, A's before B's in a group
        flat = np.empty(len(a) + len(b), object)
        last = np.zeros(len(a), np.int64)
        last[to_a - 1] = 1
        flat[np.arange(len(a)) + np.repeat(first_b, n_a)] = self.text_a[2 * a + last]
        last = np.zeros(len(b), np.int64)
        last[to_b - 1] = 1
        flat[np.arange(len(b)) + np.repeat(to_a, n_b)] = self.text_b[2 * b + last]
        flat = flat.tolist()
        # groups of each word
        ends = np.cumsum([len(w.encode()) for w in words]) if not body.isascii() \
            else np.cumsum([len(w) for w in words])
        upto = np.searchsorted(ends_a[to_a - 1], ends, "right")
        links = n_a * n_b
        if links.max(initial=0) <= PLAIN:
            # every A token of a group with every B token of it
            of_a = np.repeat(np.arange(len(a)), np.repeat(n_b, n_a))
            of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(links) - links, links)
            of_b = of_b % np.repeat(n_b, links) + np.repeat(first_b, links)
            pairs, times = (a[of_a] << B_BITS | b[of_b]).tobytes(), None
            link_end = 8 * np.cumsum(links)[upto - 1]
        else:                               # odd strings: ids of a group counted first
            found, count, size = [], [], []
            for i, to_i, j, to_j in groups.tolist():
                x, n = np.unique(a[i:to_i], return_counts=True)
                y, m = np.unique(b[j:to_j], return_counts=True)
                found.append((x[:, None] << B_BITS | y).ravel())
                count.append((n[:, None] * m).ravel())
                size.append(len(x) * len(y))
            pairs, times = np.concatenate(found).tobytes(), np.concatenate(count).tobytes()
            link_end = 8 * np.cumsum(size)[upto - 1]
        sums = [np.diff(x, prepend=0).tolist() for x in (to_a[upto - 1], to_b[upto - 1], upto)]
        at = pair = 0
        for text_end, pair_end, x, y, z in zip(
                (to_a[upto - 1] + to_b[upto - 1]).tolist(), link_end.tolist(), *sums):
            yield ("".join(flat[at:text_end]), pairs[pair:pair_end],
                   times and times[pair:pair_end], x, y, z)
            at, pair = text_end, pair_end

    def words(self, texts: list[str | None]) -> tuple[list[list[str]], dict[str, tuple | None]]:
        """Every text's keys, and what is known of them."""
        bags = [self.keys(t) if t else [] for t in texts]
        every = set().union(*bags)
        found = {}
        new = self.known.unknown(every)
        # white space at the end of a text is cut off alone: nothing may follow it
        usual = [k for k in new if k and len(k) <= LONG and not k[-1].isspace()]
        for at in range(0, len(usual), BULK):
            part = usual[at:at + BULK]
            self.known.update(zip(part, self.learn(part)))
        for key in set(new).difference(usual):                  # not kept
            found[key] = next(self.learn([key]))
        get = self.known.__getitem__
        for key in every - found.keys():
            found[key] = get(key)
        return bags, found


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for all tasks of a worker."""
    state, key = worker_state("align"), (path_a, path_b)
    if key not in state:
        state[key] = Aligner(path_a, path_b)
    return state[key]


def aligned_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id and groups, the text's token groups in order: ``a1,a2|b1;a3|b2,b3``
    (null without tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        for batch in batches:
            bags, found = tool.words(batch.column(1).to_pylist())
            out = ["".join([found[k][0] for k in bag])[:-1]
                   if bag and all([found[k] for k in bag]) else None for bag in bags]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())],
                                             names=["doc_id", "groups"])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run,
                       "doc_id long, groups string")


LONGS = pa.list_(pa.int64())
BLOCK = {"block": pa.int64(), "doc_id": LONGS, "n_a": LONGS, "n_b": LONGS, "n_groups": LONGS,
         "n_links": LONGS, "digest": pa.list_(pa.string()),
         "pair": LONGS, "held": LONGS,                        # pairs, and by how many documents
         "words": pa.binary()}                                # ``PACKED`` arrays
#: Words of each document, pairs of each word: 32-bit arrays with ends, numbers, times.
PACKED = ("word_end", "word", "times", "link_end", "link", "links")
BLOCK_SQL = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, "
             "n_groups array<long>, n_links array<long>, digest array<string>, "
             "pair array<long>, held array<long>, words binary")


def block_row(block: int, ids: list, bags: list[list[str]],
              found: dict[str, tuple | None]) -> pa.RecordBatch:
    """One row of ``BLOCK`` for the documents of a batch."""
    odd = {k for k, x in found.items() if x is None}
    if odd:
        bags = [[] if odd.intersection(bag) else bag for bag in bags]
    number = {k: i for i, k in enumerate(k for k in found if k not in odd)}
    known = [x for x in found.values() if x is not None]
    sizes = np.array([len(b) for b in bags], np.int64)
    nums = [[number[k] for k in b] for b in bags]
    flat = np.array([n for b in nums for n in b], np.int64)
    of_doc = np.repeat(np.arange(len(bags)), sizes)
    width = max(len(known), 1)
    one, times = np.unique(of_doc * width + flat, return_counts=True)
    doc, word = np.divmod(one, width)
    # pairs of each word
    codes = np.frombuffer(b"".join([x[1] for x in known]), np.int64)
    n_links = np.array([len(x[1]) // 8 for x in known], np.int64)
    pair, link = np.unique(codes, return_inverse=True)
    per_link = np.frombuffer(b"".join([x[2] or np.ones(len(x[1]) // 8, np.int64).tobytes()
                                       for x in known]), np.int64) \
        if any(x[2] for x in known) else np.ones(len(codes), np.int64)
    link_end = np.cumsum(n_links)
    # documents that hold each pair
    per_word = n_links[word] if len(word) else np.zeros(0, np.int64)
    at = np.arange(per_word.sum()) + np.repeat(
        (link_end - n_links)[word] - (np.cumsum(per_word) - per_word) if len(word) else [],
        per_word).astype(np.int64)
    held = np.unique(np.repeat(doc, per_word) * max(len(pair), 1) + link[at])
    stop = np.cumsum(sizes)

    def sums(values: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(values[flat] if len(flat) else [])])
        return np.diff(upto[stop], prepend=0).astype(np.int64)

    texts = [x[0] for x in known]
    word_links = np.diff(np.concatenate([[0], np.cumsum(per_link)])[link_end], prepend=0)
    columns = {
        "doc_id": ids,
        **{n: sums(np.array([x[i] for x in known], np.int64))
           for i, n in ((3, "n_a"), (4, "n_b"), (5, "n_groups"))},
        "n_links": sums(word_links),
        "digest": [hashlib.sha256("".join([texts[n] for n in b])[:-1].encode()).hexdigest()
                   if b else "" for b in nums],
        "pair": pair, "held": np.bincount(held % max(len(pair), 1), minlength=len(pair))}
    packed = pack(np.cumsum(np.bincount(doc, minlength=len(bags))), word, times, link_end, link,
                  per_link)
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), *(_one(columns[n], BLOCK[n]) for n in columns),
         pa.array([packed], pa.binary())], names=["block", *columns, "words"])


def pack(*arrays: np.ndarray) -> bytes:
    """32-bit arrays, each as its length and its values' differences, with the bytes of
    each place together, compressed."""
    raw = np.concatenate([np.append(len(x), np.diff(x, prepend=0)) for x in arrays]).astype("<i4")
    return len(raw).to_bytes(8, "little") + pa.compress(
        raw.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def unpack(packed: bytes) -> dict[str, np.ndarray]:
    size = int.from_bytes(packed[:8], "little")
    raw = np.frombuffer(pa.decompress(packed[8:], 4 * size, "zstd", asbytes=True), np.uint8)
    raw = np.ascontiguousarray(raw.reshape(4, -1).T).view("<i4").ravel()
    out, at = {}, 0
    for name in PACKED:
        out[name] = np.cumsum(raw[at + 1:at + 1 + raw[at]], dtype=np.int64)
        at += 1 + raw[at]
    return out


def _one(values, kind: pa.ListType) -> pa.ListArray:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()),
                                    pa.array(values, kind.value_type))


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Rows of ``BLOCK``, one for each batch of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32      # one committed task a partition
        for batch in batches:
            if batch.num_rows:
                yield block_row(number, batch.column(0).to_pylist(),
                                *tool.words(batch.column(1).to_pylist()))
                number += 1

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, BLOCK_SQL)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, a, b, n_docs (documents that hold the pair linked) and is_best (no pair of
    the same A id has more)."""
    counts = blocks.select(F.explode(F.arrays_zip("pair", "held")).alias("x")) \
        .groupBy(F.col("x.pair").alias("pair")).agg(F.sum("x.held").alias("n_docs")) \
        .withColumn("a", F.shiftright("pair", B_BITS).cast("int")) \
        .withColumn("b", F.col("pair").bitwiseAND((1 << B_BITS) - 1).cast("int"))
    most = F.max("n_docs").over(Window.partitionBy("a"))     # at most B's vocabulary each
    return counts.withColumn("is_best", F.col("n_docs") == most)


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every
    document: links whose count is their A id's highest, and the sum of all links'
    counts; the digest is that of ``aligned_groups``."""
    blocks = materialize(aligned_blocks(docs, path_a, path_b, id_col, text_col), "align-blocks")
    values = blocks.select("block", F.posexplode("pair").alias("at", "pair")) \
        .join(pair_counts(blocks).select("pair", "n_docs", "is_best"), "pair") \
        .select(F.col("block").alias("of_block"), "at", "n_docs", "is_best")
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    names = ["doc_id", *numbers, "n_best", "count_sum", "groups_sha256"]

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        at = {n: left.column(n).combine_chunks().flatten() for n in left.column_names
              if n not in ("block", "words")}
        array = unpack(left.column("words")[0].as_py())
        place = right.column("at").to_numpy()
        count = np.zeros(len(place), np.int64)
        count[place] = right.column("n_docs").to_numpy()
        best = np.zeros(len(place), np.int64)
        best[place] = right.column("is_best").to_numpy(zero_copy_only=False)

        def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(values)])[ends]
            return np.diff(upto, prepend=0)

        out = []
        for value in (best, count):
            of_word = sums(array["links"] * value[array["link"]], array["link_end"])
            out.append(sums(of_word[array["word"]] * array["times"], array["word_end"]))
        return pa.table([at["doc_id"], *(at[n] for n in numbers), *map(pa.array, out),
                         at["digest"]], names=names)

    return blocks.select("block", *[n for n in BLOCK if n not in ("block", "pair", "held")]) \
        .groupBy("block").cogroup(values.groupBy("of_block")).applyInArrow(
            settle, ", ".join(f"{n} long" for n in names[:-1]) + ", groups_sha256 string")
