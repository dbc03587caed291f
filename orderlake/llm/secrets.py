"""Secrets: fixed patterns, and formats learned by grammar inference.

The base patterns find credentials by name or prefix.  What they find is the
labelled sample of known credentials (a bounded number of each kind, chosen by
a seeded hash).  Per kind a prefix tree of the sample is merged state by state:
two states become one if a Hoeffding test can't tell their futures apart.  The
result is a probabilistic automaton of the kind's format.

Every maximal run of token characters that no base span encloses, also one that
extends a base span, is scored.  It is a further secret if, character for
character, it is as likely under the automaton of a kind as nearly all
credentials of it, and if as a whole, with its length, it is likelier there than
among the runs of the texts, by more than runs outnumber the kind's credentials.
Lengths are those of all base finds, and some mass goes to lengths between and
beyond them.  The runs are a Markov chain over symbols, counted over all rows.
Base spans stay.

Texts are scanned twice, for base spans and symbol counts and for the scores;
only spans and counts are kept in between.

Defined results: null text counts as empty and has no spans; null and repeated
ids and extra columns do no harm; without labelled credentials nothing is added; an
empty table gives an empty result; texts are read whole, whatever their length; base
spans that begin at one place are listed by kind.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import WordCache, discard, map_batches, materialize

#: Fixed base patterns, in the order of the kinds.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")        # maximal runs of 16 or more
KINDS = ("assign", "access", "hex", "format")

RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")       # the alphabet of the base credentials
SYMBOLS = " hlUd+/_.=-"                       # the first stands for all that ends a run
#: Symbol of every byte.
CODE = bytes(ord("h" if chr(c) in "abcdef" else "l" if "a" <= chr(c) <= "z" else
                 "U" if "A" <= chr(c) <= "Z" else "d" if "0" <= chr(c) <= "9" else
                 chr(c) if chr(c) in SYMBOLS else " ") for c in range(256))
#: Symbol number of every byte.
PLACE = bytes(SYMBOLS.index(chr(c)) for c in CODE)
SPREAD = 0.25              # of unseen lengths about seen ones, on the log scale
BELOW = 0.1                # share of unseen lengths that are shorter than seen ones
STAY = 0.8                 # chance, before counting, that a run's next symbol is the same
SAMPLE = 300               # labelled credentials of a kind, at most
SAMPLE_CHARS = 60_000      # and their characters: who does not fit is not sampled
MERGE_ALPHA = 0.05         # confidence of the Hoeffding test
QUANTILE = 0.01            # share of a kind's credentials that may score lower than a find
SEED = 5
SPAN = "array<struct<kind: int, start: int, end: int>>"


def symbols(text: str) -> str:
    """The text over a small alphabet: a-f h, g-z l, A-Z U, 0-9 d, the other token
    characters themselves, and a blank for all else."""
    return text.encode("ascii", "replace").translate(CODE).decode()


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential) of the base patterns, by start, then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def outside(text: str, base: Iterable[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, token) of every maximal run that no base span encloses."""
    return [(m.start(), m.end(), m[0]) for m in RUN.finditer(text)
            if not any(s <= m.start() and m.end() <= e for s, e in base)]


def pair_counts(texts: Iterable[tuple[str, Iterable[tuple[int, int]]]]) -> np.ndarray:
    """How often symbol j follows i in the texts without their base spans, at
    ``i * len(SYMBOLS) + j``."""
    rows = [bytes(1)]
    for text, base in texts:
        row = text.encode("ascii", "replace").translate(PLACE)
        for s, e in base:
            row = row[:s] + bytes(e - s) + row[e:]
        rows += [row, bytes(1)]
    at = np.frombuffer(b"".join(rows), np.uint8).astype(np.int64)
    k = len(SYMBOLS)
    out = np.bincount(at[:-1] * k + at[1:], minlength=k * k)
    out[0] = 0                                # between runs
    return out


class Automaton:
    """A probabilistic automaton by state merging over a prefix tree."""

    def __init__(self, words: list[str], alpha: float = MERGE_ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]      # uses of each symbol; "" ends
        for w in words:
            state = 0
            for c in w:
                self.count[state][c] += 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                state = self.next[state][c]
            self.count[state][""] += 1
        self.slack = math.sqrt(0.5 * math.log(2 / alpha))
        self.alphabet = len({c for w in words for c in w}) + 1
        self._merge()
        scores = sorted(self.score(w) for w in words)
        self.least = scores[int(QUANTILE * len(scores))] if scores else math.inf

    def _alike(self, a: int, b: int) -> bool:
        """Hoeffding test on all symbol shares of two states and those below them."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.count[a].total(), self.count[b].total()
            if n and m:
                bound = self.slack * (n ** -0.5 + m ** -0.5)
                for c in self.count[a].keys() | self.count[b].keys():
                    if abs(self.count[a][c] / n - self.count[b][c] / m) > bound:
                        return False
            todo += [(self.next[a][c], self.next[b][c])
                     for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, into: int, state: int) -> None:
        """Add a tree below ``state`` to ``into``."""
        todo = [(into, state)]
        while todo:
            a, b = todo.pop()
            self.count[a].update(self.count[b])
            for c, below in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], below))
                else:
                    self.next[a][c] = below

    def _merge(self) -> None:
        settled = [0]
        while True:
            fringe = [(-self.count[t].total(), s, c) for s in settled
                      for c, t in self.next[s].items() if t not in settled]
            if not fringe:
                return
            _, s, c = min(fringe)
            state = self.next[s][c]
            for other in settled:
                if self._alike(other, state):
                    self.next[s][c] = other
                    self._fold(other, state)
                    break
            else:
                settled.append(state)

    def score(self, word: str) -> float:
        """Mean log2 likelihood of a symbol, where the word goes on."""
        state, total = 0, 0.0
        for c in word:
            uses = self.count[state]
            total += math.log2((uses[c] + 0.1) / (uses.total() - uses[""] + 0.1 * self.alphabet))
            state = self.next[state].get(c, 0)
        return total / max(len(word), 1)


class Lengths:
    """log2 probability of a credential's length.  As much mass as a new length has
    turned up with lies about the lengths seen, most of it above them, as a run
    also holds what is written next to a credential."""

    def __init__(self, seen: dict[int, int]):
        self.seen, self.total = seen, sum(seen.values())
        self.new = min((len(seen) + 1) / (self.total + 1), 0.5)
        self.odds = 0.0             # log2 of the plain runs for each credential of the kind
        # by log length in steps of 1 %, so that a score needs few terms
        self.about: Counter = Counter()
        for n, c in seen.items():
            self.about[round(math.log(n), 2)] += c

    def score(self, n: int) -> float:
        at = math.log(n)
        near = sum(c * (BELOW if at < x else 1 - BELOW) * math.exp(-abs(at - x) / SPREAD)
                   for x, c in self.about.items()) / (SPREAD * n)
        p = (1 - self.new) * self.seen.get(n, 0) + self.new * near
        return math.log2(max(p / self.total, 1e-300))


class Formats:
    """Automata of the kinds, against a Markov chain of plain runs: ``plain`` are
    words, or counts of ``pair_counts``; ``lengths`` counts of all credentials."""

    def __init__(self, known: dict[int, list[str]], plain: list[str] | np.ndarray,
                 lengths: dict[int, dict[int, int]] | None = None, coded: bool = False):
        """``coded``: ``known`` holds the credentials' ``symbols``."""
        k = len(SYMBOLS)
        uses = np.asarray(plain if isinstance(plain, np.ndarray)
                          else pair_counts((w, ()) for w in plain)).reshape(k, k)
        self.kinds = []
        for kind, words in sorted(known.items()):
            if words:
                size = Lengths((lengths or {}).get(kind) or Counter(map(len, words)))
                size.odds = max(math.log2((uses[0].sum() + 1) / (size.total + 1)), 0.0)
                self.kinds.append((Automaton(sorted(words if coded else map(symbols, words))),
                                   size))
        stay = (uses.diagonal()[1:].sum() + 100 * STAY) / (uses[1:].sum() + 100)
        # a symbol seldom met goes on as all do: mostly with itself, or to the end
        before = np.full((k, k), (1 - stay) / 2 / (k - 2))
        before[:, 0] = (1 - stay) / 2
        np.fill_diagonal(before, stay)
        before[0] = [0, *[1 / (k - 1)] * (k - 1)]
        with np.errstate(divide="ignore"):
            chain = np.log2((uses + before) / (uses.sum(1, keepdims=True) + 1))
        self.chain = {x + y: float(chain[i, j]) for i, x in enumerate(SYMBOLS)
                      for j, y in enumerate(SYMBOLS)}

    def is_secret(self, token: str) -> bool:
        return self.judge(symbols(token))

    def judge(self, word: str) -> bool:
        """Whether a run with these symbols is a secret."""
        whole = None
        for a, lengths in self.kinds:
            s = a.score(word)
            if s >= a.least:
                if whole is None:
                    whole = sum(map(self.chain.__getitem__,
                                    map("".join, zip(" " + word, word + " "))))
                if s * len(word) + lengths.score(len(word)) > whole + lengths.odds:
                    return True
        return False


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Symbols and a digest of the credentials in base spans, never themselves, and one
    row of ``pair_counts`` a batch."""
    span = pa.list_(pa.struct([("kind", pa.int32()), ("word", pa.string()),
                               ("token", pa.int64())]))

    def digest(token: str) -> int:
        return int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "big",
                              signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t]
            found = [base_spans(t) for t in texts]
            pairs = pair_counts((t, [(s, e) for s, _, e, _ in f]) for t, f in zip(texts, found))
            yield pa.RecordBatch.from_arrays(
                [pa.array([[{"kind": k, "word": symbols(t), "token": digest(t)}
                            for f in found for _, k, _, t in f]], span),
                 pa.array([pairs.tolist()], pa.list_(pa.int64()))], names=["base", "pairs"])

    return map_batches(docs.select(text_col), run,
                       "base array<struct<kind: int, word: string, token: long>>, pairs array<long>")


def background(found: DataFrame) -> np.ndarray:
    """Sum of the ``pair_counts`` of all rows: a number for each pair of symbols."""
    out = np.zeros(len(SYMBOLS) ** 2, np.int64)
    for r in found.select(F.posexplode("pairs").alias("at", "n")).groupBy("at") \
            .agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def learn(found: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Formats:
    """Automata from at most ``sample`` distinct credentials of each kind, of
    ``sample_chars`` characters together at most; lengths from all of them."""
    known = found.select(F.explode("base").alias("x")).select("x.*")

    def some(kind: int) -> list[str]:
        rows = known.where((F.col("kind") == kind) & (F.length("word") <= sample_chars)) \
            .select("word", "token").distinct() \
            .orderBy(F.xxhash64(F.lit(SEED), "token"), "token", "word").limit(sample)
        upto = F.sum(F.length("word")).over(Window.orderBy(
            F.xxhash64(F.lit(SEED), "token"), "token", "word"))      # of ``sample`` rows
        return [r["word"] for r in rows.withColumn("upto", upto)
                .where(F.col("upto") <= sample_chars).select("word").collect()]

    lengths: dict[int, dict[int, int]] = {}
    for r in known.groupBy("kind", F.length("word").alias("size")).count().collect():
        lengths.setdefault(r["kind"], {})[r["size"]] = r["count"]
    return Formats({k: some(k) for k in (0, 1, 2)}, background(found), lengths, coded=True)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 sample: int = SAMPLE) -> DataFrame:
    """doc_id, base and all spans (arrays of kind, start, end), and their digest columns."""
    found = materialize(scan(docs, id_col, text_col), "secret-spans")
    formats = learn(found, sample)
    discard(found)
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def joined(spans: list[dict]) -> str:
        return ",".join(f"{KINDS[x['kind']]}:{x['start']}:{x['end']}" for x in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged = WordCache(formats.judge)        # by symbols: many runs have the same
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = [{"kind": k, "start": s, "end": e} for s, k, e, _ in base_spans(text)]
                words = symbols(text).split()
                every = base
                if formats.kinds and any(map(judged.__getitem__, set(words))):
                    more = outside(text, [(x["start"], x["end"]) for x in base])
                    every = sorted([*base, *({"kind": 3, "start": s, "end": e}
                                             for s, e, t in more if judged[symbols(t)])],
                                   key=lambda x: (x["start"], x["kind"]))
                if len(judged) >= judged.limit:
                    judged.age()
                kinds = Counter(x["kind"] for x in base)
                for column, value in zip(out, (
                        kinds[0], kinds[1], kinds[2],
                        hashlib.sha256(joined(base).encode()).hexdigest(), joined(every),
                        every, len(words))):
                    column.append(value)
            kinds_of = (*[pa.int64()] * 3, pa.string(), pa.string(), span, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, t) for x, t in zip(out, kinds_of))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans",
                       "found", "n_candidates"])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run,
                       "doc_id long, n_assign long, n_access long, n_hex long, "
                       f"base_sha256 string, spans string, found {SPAN}, n_candidates long")
