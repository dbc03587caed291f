"""Periodic runs of words: maximal stretches that repeat a block of words.

A run is a maximal stretch of consecutive words with a smallest period q (words q
apart are the same) that is at least ``min_words`` words and ``repeats`` (3 or more)
times q long.  They are found with the dictionary of basic factors: for every
power of two m, all stretches of m words get a number, equal for equal
stretches, made of the numbers of their halves.

1. From the least m that no run can escape up, the successor of an occurrence is
   the next one of the same factor in the document.  Successors at most 2m away
   propose their distance as a period.  Inside a run they follow each other in
   arithmetic progressions, one for each place in the block, so a range of
   neighbouring occurrences with one distance is one proposal.
2. A proposal is extended to both sides as far as words a period apart are the
   same, in steps of basic factors, longest first.
3. Proposals of several m that end up as one run are one.

The distance to a successor is the smallest period of what both occurrences
cover, as a smaller one would make an earlier occurrence; a run of period q shows
at the least m >= q, as two occurrences there cover less than 3q words.  So the
result is exact.

All documents of a batch are numbered together; a factor that occurs once in its
document is forgotten, and with it all longer ones, so ordinary prose costs a few
sorts of word numbers.  Nothing is shuffled.

Defined results: a null or empty text has no words and no runs; null and repeated
ids and extra columns do no harm (the result has the id and its own columns only);
an empty table gives an empty result; texts of any length are read whole (memory
is some 4 bytes a word and level); of runs with equal length / period the first,
then the one with the smaller period, is the best.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_batches, utf8

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_SQL = "struct<start: long, length: long, period: long>"


def basic_factors(words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(m, numbers, places, groups) for m = 1, 2, 4, ... while a factor occurs twice.

    ``numbers[i]`` is the number of the factor of m words at i, or -1 if it occurs
    once only; ``places`` are the others' places by number, each number's in order,
    and ``groups`` their numbers.  Words under 0 are like no other.
    """
    m, size = 1, len(words)
    at = np.flatnonzero(words >= 0)
    code = words[at].astype(np.int64)
    while len(at):
        order = np.argsort(code, kind="stable")
        code, at = code[order], at[order]
        same = code[1:] == code[:-1]
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        group = np.cumsum(np.concatenate([[True], ~same]))[again]
        at = at[again]
        if not len(at):
            return
        _, group = np.unique(group, return_inverse=True)
        numbers = np.full(size, -1, np.int32)
        numbers[at] = group
        yield m, numbers, at, group
        first = np.sort(at)
        first = first[first + m < size]
        first = first[numbers[first + m] >= 0]
        code = numbers[first].astype(np.int64) * (int(group[-1]) + 1) + numbers[first + m]
        at, m = first, 2 * m


def _extend(at: np.ndarray, other: np.ndarray, levels: list[tuple[int, np.ndarray]],
            step: int) -> np.ndarray:
    """How many words from ``at`` and ``other`` on are the same, to the right
    (``step`` 1) or to the left (-1, without the words at these places)."""
    size, out = len(levels[0][1]), np.zeros(len(at), np.int64)
    for m, numbers in reversed(levels):
        todo = np.arange(len(at))
        while len(todo):
            go = step * out[todo] - (m if step < 0 else 0)
            a, b = at[todo] + go, other[todo] + go
            fits = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < size)
            todo, a, b = todo[fits], a[fits], b[fits]
            equal = (numbers[a] >= 0) & (numbers[a] == numbers[b])
            todo = todo[equal]
            out[todo] += m
    return out


def find_runs(words: np.ndarray, min_words: int = 24, repeats: int = 3) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period.  ``words`` are
    word numbers; those under 0 are like no other."""
    if repeats < 3 or min_words < 1:
        raise ValueError("runs of at least three periods are found")
    # the least level that shows every run: period + m words fit in each
    least = 1
    while 2 * least <= 2 * min_words / 3:
        least *= 2
    levels, found = [], []
    for m, numbers, at, group in basic_factors(words):
        levels.append((m, numbers))
        if m < least:
            continue
        gap = np.diff(at)
        near = np.flatnonzero((group[1:] == group[:-1]) & (gap <= 2 * m))
        i, d = at[near], gap[near]
        order = np.argsort(i)
        i, d = i[order], d[order]
        if not len(i):
            continue
        opens = np.concatenate([[True], (np.diff(i) != 1) | (np.diff(d) != 0)])
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(i)) - 1
        found.append(np.stack([i[first], i[last] + d[first] + m, d[first]], 1))
    if not found:
        return np.zeros((0, 3), np.int64)
    start, end, period = np.concatenate(found).T
    start = start - _extend(start, start + period, levels, -1)
    end = end + _extend(end - period, end, levels, 1)
    long = end - start >= np.maximum(min_words, repeats * period)
    runs = np.unique(np.stack([start, end, period], 1)[long], axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, end, period in runs:
        cover[start + period] += 1
        cover[end] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = 24, repeats: int = 3,
                  rewrite: Callable[[int, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, runs (by start, then period), best (greatest length / period; null
    without runs) and collapsed (the text's words, joined by a blank, with the first
    period of every run only).

    ``rewrite`` may give other words for a document's id and words.
    """
    names = ["doc_id", "runs", "best", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").split() for t in utf8(batch.column(1))]
            if rewrite:
                texts = [rewrite(i, w) for i, w in zip(batch.column(0).to_pylist(), texts)]
            sizes = np.array([len(w) for w in texts], np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            numbers: dict[bytes, int] = {}
            flat = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t],
                            np.int64)
            # a word of two documents is two words
            flat += np.repeat(np.arange(len(texts)), sizes) * max(len(numbers), 1)
            runs: list[list] = [[] for _ in texts]
            for s, e, q in find_runs(flat, min_words, repeats).tolist():
                doc = int(np.searchsorted(starts, s, "right")) - 1
                runs[doc].append((s - int(starts[doc]), e - int(starts[doc]), q))
            listed = [[{"start": s, "length": e - s, "period": q} for s, e, q in r] for r in runs]
            best = [max(r, key=lambda x: (Fraction(x["length"], x["period"]), -x["start"],
                                          -x["period"]), default=None) for r in listed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(listed, pa.list_(RUN)), pa.array(best, RUN),
                 pa.array([collapse(w, r).decode() for w, r in zip(texts, runs)], pa.string())],
                names=names)

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run,
                       f"doc_id long, runs array<{RUN_SQL}>, best {RUN_SQL}, collapsed string")
