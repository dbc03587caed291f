"""Best-fit packing of tokenized documents into sequences of bounded length.

Documents are tokenized in Arrow batches and cut into pieces of at most
``capacity`` tokens.  The packing itself is decided on the histogram of piece
lengths, which has at most ``capacity`` rows whatever the corpus size:

1. Large items (over a third of the capacity) fit at most twice in a bin.
   From the longest down, each length takes the longest partner that fits.
2. Smaller items, longest first, go to the bin with the smallest gap that
   holds them; new bins open only when none does.

Bins of equal content are handled as one group with a count.  Putting a
length into a group at least halves the group's gap and splits off at most
two groups, so the plan has at most a few tens of rows per distinct length,
independent of the input.  Every piece then finds its place from its rank
among the pieces of its length.

Defined results: ids are those of a plain call of the tokenizer, added tokens in
a text included; null or empty text is a document of the end id alone; null ids, repeated rows and extra columns are packed like any others; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WordCache, map_batches, materialize, rank_in_group, worker_state

#: Signs before a mark.  U+001C to U+001F are signs for the tokenizer, blanks for Python.
MARKS = re.compile(r"(?:[^\w\s]|[_\x1c-\x1f])[.,]")
CLOSING = re.compile(r"(?<=[^\W_])([.,])(?=[ \n]|\Z)")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordEncoder:
    """Token ids of whole texts as little-endian 32-bit bytes, word by word.

    The tokenizer drops white space between words and never merges across it,
    so a text's ids are its words' ids in order.  A closing mark after a letter or
    digit is a token of its own and is split off first.  ``encode`` looks every
    word up in a bounded cache and passes the unknown ones on in bulk.

    With ``added``, the strings of the file's added tokens become their ids, as
    in a plain call of the tokenizer: texts are cut there before anything else.
    Without, they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # in the words: what only lower-casing makes such a string is no token
        self.tok.encode_special_tokens = True
        tokens = self.tok.get_added_tokens_decoder() if added else {}
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in tokens.values()):
            raise ValueError("an added token is not matched as it stands")
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in tokens.items()}
        self.sign = os.path.commonprefix(list(self.added))
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, reverse=True)))})")
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words = WordCache(limit=200_000)

    def _plain(self, words: list[str]) -> None:
        for w, e in zip(words, self.tok.encode_batch_fast(words, add_special_tokens=False)):
            self.words[w] = np.array(e.ids, "<u4").tobytes()

    def _letters(self, words: list[str]) -> None:
        """Words of letters only: encoded joined, cut after each word-end token."""
        for i in range(0, len(words), 2000):
            part = words[i:i + 2000]
            e = self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(e.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                self._plain(part)
                continue
            raw, at, words_ = ids.tobytes(), 0, self.words
            for w, cut in zip(part, (4 * cuts).tolist()):
                words_[w] = raw[at:cut]
                at = cut

    def _split(self, text: str | None) -> list[str]:
        """The words of a text without added tokens."""
        # the lower case of a sigma depends on its place for Python alone
        low = text if not text or "Σ" in text else text.lower()
        if not low:
            low = ""
        elif MARKS.search(low):
            low = CLOSING.sub(r" \1", low)
        else:                       # each mark starts a run of its own: same cuts, faster
            low = low.replace(".", " .").replace(",", " ,")
        return low.replace("\n", " ").split(" ")

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for at in range(0, len(texts), 500):           # new words are encoded together
            bags, tokens = [], []          # words of each part; ids of the tokens between parts
            for text in texts[at:at + 500]:
                if text and self.added and self.sign in text:
                    parts = self.cut.split(text)
                    bags.append([self._split(x) for x in parts[::2]])
                    tokens.append([*(self.added[x] for x in parts[1::2]), b""])
                else:
                    bags.append([self._split(text)])
                    tokens.append([b""])
            new = self.words.unknown(set().union(*(words for bag in bags for words in bag)))
            self._letters([w for w in new if w.isalpha()])
            self._plain([w for w in new if not w.isalpha()])
            for bag, after in zip(bags, tokens):
                yield b"".join([b"".join(map(self.words.__getitem__, words)) + end
                                for words, end in zip(bag, after)])


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096,
                     end_id: int = 1, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (``PIECES``)."""
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("packing")
        encoder = state.get(tokenizer_path)
        if encoder is None:
            encoder = state[tokenizer_path] = WordEncoder(tokenizer_path, True)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, ids in zip(batch.column(0).to_pylist(),
                                encoder.encode(batch.column(1).to_pylist())):
                ids += tail
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for column, value in zip(out, (doc, piece, at // 4, len(part) // 4,
                                                   zlib.crc32(part))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, PIECES)


def pack_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Rows (length, first rank, items per bin, bins, first sequence, offset).

    A row places ``items per bin * bins`` pieces of that length: the i-th of
    them goes to sequence ``first + i // items`` at ``offset + i % items * length``.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    plan: list[tuple[int, ...]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}       # gap -> groups (first sequence, bins)
    bits = 0                                          # bit g: some group has gap g
    bins = 0

    def place(n: int, items: int, count: int, first: int, offset: int) -> None:
        plan.append((n, used[n], items, count, first, offset))
        used[n] += items * count
        left[n] -= items * count

    def keep(gap: int, first: int, count: int) -> None:
        nonlocal bits
        if gap and count:
            gaps.setdefault(gap, []).append((first, count))
            bits |= 1 << gap

    large = 0                                         # bit n: large length n is left
    for n in left:
        if 3 * n > capacity:
            large |= 1 << n
    for a in sorted((n for n in left if 3 * n > capacity), reverse=True):
        while left[a]:
            fits = large & ((1 << (min(a, capacity - a) + 1)) - 1)
            if left[a] < 2:
                fits &= ~(1 << a)
            b = fits.bit_length() - 1
            if b < 0:
                count = left[a]
                place(a, 1, count, bins, 0)
                keep(capacity - a, bins, count)
            elif a == b:
                count = left[a] // 2
                place(a, 2, count, bins, 0)
                keep(capacity - 2 * a, bins, count)
            else:
                count = min(left[a], left[b])
                place(a, 1, count, bins, 0)
                place(b, 1, count, bins, a)
                keep(capacity - a - b, bins, count)
                if not left[b]:
                    large &= ~(1 << b)
            bins += count
        large &= ~(1 << a)

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            wide = bits >> n
            if wide:
                gap = n + (wide & -wide).bit_length() - 1
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    bits &= ~(1 << gap)
            else:
                gap, first, count = capacity, bins, -(-left[n] // (capacity // n))
                bins += count
            items = gap // n
            full = min(count, left[n] // items)
            if full:
                place(n, items, full, first, capacity - gap)
                keep(gap - items * n, first, full)
            if full < count and left[n]:
                rest = left[n]
                place(n, rest, 1, first + full, capacity - gap)
                keep(gap - rest * n, first + full, 1)
                full += 1
            keep(gap, first + full, count - full)
    return plan


def best_fit_pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (columns of ``PIECES``, extra ones kept) with ``sequence_id``
    and ``offset``: no sequence holds more than ``capacity`` tokens."""
    pieces = materialize(pieces, "pack-pieces")       # tokenized once, read twice
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(n > capacity or n < 1 for n in histogram):
        raise ValueError("a piece is empty or longer than the capacity")
    plan = np.array(sorted(pack_plan(histogram, capacity)), np.int64).reshape(-1, 6)
    keys = (plan[:, 0] << 44) + plan[:, 1]
    ranked = rank_in_group(pieces, ["length"], F.xxhash64("doc_id", "piece", "ids_crc32"),
                           ["doc_id", "piece", "ids_crc32"], "_rank")
    names = [c for c in ranked.columns if c != "_rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length, rank = (at[n].to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
            row = plan[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            i = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(at[n] for n in names), pa.array(row[:, 4] + i // row[:, 2]),
                 pa.array(row[:, 5] + i % row[:, 2] * length)],
                names=[*names, "sequence_id", "offset"])

    schema = pieces.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    return map_batches(ranked, run, schema)
