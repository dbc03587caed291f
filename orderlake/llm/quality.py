"""Quality by weak supervision: rules vote or abstain, EM weighs the votes.

Each rule looks at one measure of a document and votes bad, good, or, between two
thresholds, not at all.  Expectation-maximisation over the vote patterns of the
whole corpus estimates how each rule votes on good and on bad documents; the
posterior probability of "good" then takes the place of an all-must-pass
filter.  Common defects show in two measures, so a reliable rule finds others
that agree with it, and one that cries bad where all others say good loses its
weight.  A document has one of at most 3^rules vote patterns, so the corpus
reduces to a bounded table of pattern counts and EM runs on the driver.

Defined results: null text counts as no text (all measures 0, base failed);
null ids, repeated rows and extra columns pass through; texts of any length are
measured whole; a posterior of exactly one half keeps; an empty table gives an
empty result with the starting weights.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_batches, utf8

# The measures, as columns that measure() adds under this prefix.
PREFIX = "_ql_"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_bangs", "n_echoes", "n_marks", "n_signs", "n_bytes", "n_distinct")
WINDOW = 8
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)      # odd multipliers
UPPER = bytes(range(65, 91))
#: Letters, digits and all bytes beyond ASCII.
PLAIN = bytes(range(48, 58)) + UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
#: What is believed of any rule before counting: how often it votes bad, not at all and
#: good on bad and on good documents, the share of good ones, and how many documents
#: that belief weighs, whatever the corpus.
BELIEVED = np.array([[0.300, 0.050, 0.65], [0.005, 0.055, 0.94]])
BELIEVED_GOOD, BELIEVED_DOCS, EM_STEPS, EM_CLOSE = 0.85, 100, 500, 1e-9


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words covered by windows of ``WINDOW`` words that occur twice or more."""
    n = len(ids)
    if n <= WINDOW or distinct == n:
        return 0
    key, span = ids.astype(np.uint64) * MIX[0], 1
    while span < WINDOW:                     # hashes of 1, 2, 4, 8 words
        key = (key[:-span] ^ (key[span:] >> np.uint64(29))) * MIX[0] + key[span:] * MIX[1]
        span *= 2
    key.sort()
    if not (key[1:] == key[:-1]).any():      # distinct hashes: no window occurs twice
        return 0
    span, names = 1, distinct                # exact class numbers by the same doubling
    while span < WINDOW:
        both = ids[:-span] * names + ids[span:]
        _, ids, counts = np.unique(both, return_inverse=True, return_counts=True)
        span, names = 2 * span, len(counts)
    starts = np.flatnonzero(counts[ids] > 1)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(steps)[:n]))


def measures_of(text: bytes | None) -> tuple[int, ...]:
    """The ``MEASURES`` of one UTF-8 text."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    joined = b"".join(words)
    seen: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.array(list(map(seen.__getitem__, words)), np.int64)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(joined.decode()), len(text) - len(text.translate(None, b"#*$%&|<>")),
            len(lines) - len(set(lines)), _repeated(ids, len(seen)), len(lines),
            len(text) - len(text.translate(None, UPPER)), text.count(b"!"),
            int(np.count_nonzero(ids[1:] == ids[:-1])), text.count(b".") + text.count(b","),
            len(joined.translate(None, PLAIN)), len(joined), len(seen))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one long column per measure, named with ``PREFIX``."""
    names = [f"{PREFIX}{m}" for m in MEASURES]
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures_of(t) for t in utf8(batch.column(at))]
            table = np.array(rows, np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(table[:, i]) for i in range(len(names)))],
                names=[*batch.schema.names, *names])

    schema = docs.schema
    schema = type(schema)(list(schema.fields))
    for n in names:
        schema = schema.add(n, "long")
    return map_batches(docs, run, schema)


def _m(name: str) -> Column:
    return F.col(f"{PREFIX}{name}")


def rules() -> dict[str, Column]:
    """Rule name -> vote: -1 bad, 1 good, 0 nothing.  Null-free."""
    n = F.greatest(_m("n_words"), F.lit(1))
    chars = F.greatest(_m("word_chars"), F.lit(1))
    size = F.greatest(_m("n_bytes"), F.lit(1))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    def share(of: str, whole: Column, good: float, bad: float) -> Column:
        return vote(_m(of) > bad * whole, _m(of) <= good * whole)

    return {
        "symbols": share("n_symbols", n, 0.02, 0.15),
        "signs": share("n_signs", size, 0.06, 0.10),
        "shouting": share("n_upper", chars, 0.15, 0.4),
        "bangs": share("n_bangs", n, 0.05, 0.2),
        "windows": share("n_repeat_words", n, 0.05, 0.3),
        "echoes": share("n_echoes", n, 0.05, 0.2),
        # the number of distinct words grows as a power of the length
        "variety": vote(_m("n_distinct") < F.pow(n, F.lit(0.7)),
                        _m("n_distinct") >= 1.5 * F.pow(n, F.lit(0.7))),
        "lines": vote((_m("n_dup_lines") >= 3) & (_m("n_dup_lines") > 0.4 * _m("n_lines")),
                      _m("n_dup_lines") <= 0.1 * _m("n_lines")),
        "lengths": vote((chars > 20 * n) | (chars < 1.5 * n), (chars >= 3 * n) & (chars <= 10 * n)),
        "punctuation": vote(_m("n_marks") > 1.5 * n,
                            (_m("n_marks") >= 0.02 * n) & (_m("n_marks") <= 0.4 * n)),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], k: int) -> tuple[float, np.ndarray]:
    """EM over (votes, count) rows: the prior log-odds of "good" and, per rule
    and vote (-1, 0, 1), the log-likelihood ratio good : bad.

    Rules start alike, with the rates of ``BELIEVED``, which go on counting as
    ``BELIEVED_DOCS`` documents; what the corpus shows of a rule outweighs them.
    Rules are taken as no worse than chance: a bad vote never raises the odds of
    "good", a good vote never lowers them, and no vote leaves them as they are.
    """
    votes = np.array([p for p, _ in patterns], np.int64).reshape(-1, k) + 1
    count_ = np.array([c for _, c in patterns], float)
    rate, share, good = np.repeat(BELIEVED[:, None, :], k, axis=1), BELIEVED_GOOD, None
    for _ in range(EM_STEPS):
        prior, ratio = math.log(share / (1 - share)), np.log(rate[1] / rate[0])
        ratio[:, 0], ratio[:, 1] = np.minimum(ratio[:, 0], 0), 0
        ratio[:, 2] = np.maximum(ratio[:, 2], 0)
        logit = prior + ratio[np.arange(k), votes].sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        if good is not None and np.abs(new - good).max(initial=0) < EM_CLOSE:
            break
        good = new
        for c, weight in enumerate((count_ * (1 - good), count_ * good)):
            for v in range(3):
                seen = ((votes == v) * weight[:, None]).sum(axis=0)
                rate[c, :, v] = (seen + BELIEVED_DOCS * BELIEVED[c, v]) \
                    / (weight.sum() + BELIEVED_DOCS)
        share = ((count_ * good).sum() + BELIEVED_DOCS * BELIEVED_GOOD) \
            / (count_.sum() + BELIEVED_DOCS)
    return prior, ratio


def weigh(measured: DataFrame) -> tuple[float, np.ndarray]:
    """The EM weights from the vote patterns of all rows of a ``measure`` frame."""
    voted = rules()
    rows = measured.groupBy(*[v.alias(f"v{i}") for i, v in enumerate(voted.values())]) \
        .agg(F.count(F.lit(1)).alias("n")).collect()
    return estimate(sorted((tuple(r)[:-1], r["n"]) for r in rows), len(voted))


def judge(measured: DataFrame, weights: tuple[float, np.ndarray]) -> DataFrame:
    """``measured`` with the votes (``_ql_vote_*``), ``_ql_base_failed``,
    ``_ql_p_good`` (the posterior) and ``_ql_kept``."""
    prior, ratio = weights
    voted = rules()
    names = [f"{PREFIX}vote_{r}" for r in voted]
    logit = F.lit(float(prior))
    for name, (bad, none, good) in zip(names, ratio.tolist()):
        logit = logit + F.when(F.col(name) < 0, bad).when(F.col(name) > 0, good).otherwise(none)
    failed = (_m("n_words") < 20) | (100 * _m("n_repeat_words") > 30 * _m("n_words"))
    return measured.withColumns(dict(zip(names, voted.values()))) \
        .withColumns({f"{PREFIX}base_failed": failed, f"{PREFIX}p_good": 1 / (1 + F.exp(-logit))}) \
        .withColumn(f"{PREFIX}kept",
                    ~F.col(f"{PREFIX}base_failed") & (F.col(f"{PREFIX}p_good") >= 0.5))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the posterior keeps, with their own columns only.
    Reads ``docs`` twice, so that no text is stored or shuffled."""
    weights = weigh(measure(docs.select(F.col(text_col).alias("text"))))
    return judge(measure(docs, text_col), weights).where(F.col(f"{PREFIX}kept")) \
        .select(*docs.columns)
