"""Toxicity by subword bags: averaged embeddings under a linear softmax.

A word is the bag of its character n-grams, hashed into a fixed number of
buckets; a document's vector is the average of its words' vectors; a softmax
over two classes scores it.  Embeddings and softmax are trained together, in
numpy, on a bounded sample of labelled documents (at most ``MAX_ROWS`` of each
class, chosen by a seeded hash).  A misspelling shares most n-grams with the
word it hides, so it scores alike without having been seen.

After training, averaging and softmax being linear, every bucket comes down to
one number: a document's score is the logistic of the mean over its words.
Tasks get that table (1 MB) and score whole texts.

Defined results: null and empty texts, and texts without a letter or digit,
score the model's bias; labels that are null are not learned from; with no
label, or labels of one class only, every document scores the smoothed share
of class 1; null and repeated ids and extra columns do no harm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import WordCache, map_batches

BUCKETS = 1 << 18
SIZES = (3, 4, 5, 6)        # lengths of the character n-grams, word ends marked
DIMENSIONS = 2
MAX_ROWS = 2000             # labelled documents of each class that training takes at most
MIN_DOCS = 4                # buckets in fewer training documents stay without weight
STEPS = 100
CHUNK = 500                 # training documents handled at a time
EVEN = 0.5                  # how far rare n-grams are lifted towards frequent ones
NEUTRAL = 20                # words of no weight that join every average; steadies short texts
SEED = 11
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def words_of(text: str | None) -> list[str]:
    return text.split() if text else []


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, bucket) of every n-gram of the words, lower-cased and
    without marks at their ends, all words at once."""
    bare = [f"<{w}>" if (w := EDGES.sub("", x.lower())) else "" for x in words]
    size = np.array([len(x) for x in bare], np.int64)
    points = np.frombuffer("".join(bare).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points.astype(np.uint64) + np.uint64(1)
    word = np.repeat(np.arange(len(bare)), size)
    owner, bucket = [], []
    key = np.zeros(len(points), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(points) < n:
            break
        key = key[:len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:]
        if n in SIZES:
            inside = word[:len(points) - n + 1] == word[n - 1:]
            h = (key[inside] ^ (key[inside] >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            owner.append(word[:len(points) - n + 1][inside])
            bucket.append((h >> np.uint64(46)).astype(np.int64))
    if not owner:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(owner), np.concatenate(bucket)


class Model:
    """``weight``: a bucket's share in the log-odds; ``mean``: that of the mean
    word, which counts as none; ``bias``."""

    def __init__(self, weight: np.ndarray, bias: float, mean: float = 0.0):
        self.weight, self.bias, self.mean = weight, bias, mean

    def logit(self, values: np.ndarray) -> float:
        """The log-odds of a text from its words' values."""
        values = values[~np.isnan(values)]
        return float((values - self.mean).sum() / (len(values) + NEUTRAL)) + self.bias

    def words(self, words: list[str]) -> np.ndarray:
        """Mean weight of each word's n-grams; nan for a word that has none."""
        owner, bucket = grams(words)
        size = np.bincount(owner, minlength=len(words))
        with np.errstate(invalid="ignore"):
            return np.bincount(owner, self.weight[bucket], len(words)) / size


def _matrix(texts: list[str | None]) -> tuple[list[list[np.ndarray]], np.ndarray, np.ndarray]:
    """The averaged bags as a sparse matrix in parts of ``CHUNK`` rows (row in the
    part, column, value), the bucket of each column, and per row the share of its
    own words in the average."""
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int32)
           for t in texts]
    every, buckets, sizes = list(number), [], []
    for at in range(0, len(every), 20_000):
        owner, bucket = grams(every[at:at + 20_000])
        buckets.append(bucket[np.argsort(owner, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(owner, minlength=len(every[at:at + 20_000])))
    bucket, size = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (buckets, sizes))
    del number, every, buckets
    start = np.concatenate(([0], np.cumsum(size)))
    parts, own = [], np.zeros(len(texts))
    for first in range(0, len(ids), CHUNK):
        rows, columns, values = [], [], []
        for d, words in enumerate(ids[first:first + CHUNK]):
            words, often = np.unique(words[size[words] > 0], return_counts=True)
            if not len(words):
                continue
            n = size[words]
            at = np.repeat(start[words] - np.concatenate(([0], np.cumsum(n)[:-1])), n) \
                + np.arange(n.sum())
            found, inverse = np.unique(bucket[at], return_inverse=True)
            own[first + d] = share = often.sum() / (often.sum() + NEUTRAL)
            rows.append(np.full(len(found), d, np.int32))
            columns.append(found)
            values.append(np.bincount(inverse, np.repeat(share * often / often.sum() / n, n))
                          .astype(np.float32))
        parts.append([np.concatenate(x) if x else np.empty(0, np.int32)
                      for x in (rows, columns, values)])
    in_docs = sum((np.bincount(p[1], minlength=BUCKETS) for p in parts), np.zeros(BUCKETS, int))
    used = np.flatnonzero(in_docs >= MIN_DOCS)
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    for i, (row, column, value) in enumerate(parts):
        keep = in_docs[column] >= MIN_DOCS
        parts[i] = [row[keep], place[column[keep]], value[keep]]
    return parts, used, own


def train(texts: list[str | None], labels: np.ndarray, share: float | None = None,
          seed: int = SEED) -> Model:
    """Embeddings and softmax trained together by accelerated gradient descent,
    then scaled to the labels; ``share`` is the share of class 1 to expect."""
    labels = np.asarray(labels, int)
    n, ones = len(labels), int(labels.sum())
    weight = np.zeros(BUCKETS, np.float32)
    parts, used, own = _matrix(texts)
    if not 0 < ones < n or not len(used):
        return Model(weight, float(np.log((ones + 1) / (n - ones + 1))))
    width = len(used)

    def down(power: int, r: np.ndarray | None = None) -> np.ndarray:
        """Sums over the columns of value ** power, times a number per row."""
        out = np.zeros(width)
        for i, (row, column, value) in enumerate(parts):
            v = value if power == 1 else value ** power
            out += np.bincount(column, v if r is None else v * r[i * CHUNK + row], width)
        return out

    # rare n-grams in step with frequent ones: columns divided by a power of their spread
    spread = np.sqrt(down(2) / n) ** EVEN
    for part in parts:
        part[2] = (part[2] / spread[part[1]]).astype(np.float32)
    middle = down(1) / own.sum()                        # the mean word

    def across(v: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(row, value * v[column], min(CHUNK, n - i * CHUNK))
                               for i, (row, column, value) in enumerate(parts)])

    def times(v: np.ndarray) -> np.ndarray:             # centred bags by a column vector
        return across(v) - own * (middle @ v)

    def back(r: np.ndarray) -> np.ndarray:
        return down(1, r) - middle * (own @ r)

    rng = np.random.default_rng(seed)
    v = rng.normal(size=width)
    for _ in range(8):                                  # largest eigenvalue, for the step
        v = back(times(v / np.linalg.norm(v)))
    lift = 2 / np.sqrt(np.linalg.norm(v) / n)           # makes the logistic loss smooth at 1
    soft = rng.normal(size=DIMENSIONS)                  # class 1 minus class 0
    soft /= np.linalg.norm(soft)
    emb = rng.normal(0, 1e-3, (width, DIMENSIONS))
    balance = np.where(labels == 1, n / (2 * ones), n / (2 * (n - ones)))
    bias, ahead = 0.0, emb.copy()
    for step in range(STEPS):
        h = lift * np.stack([times(ahead[:, k]) for k in range(DIMENSIONS)], axis=1)
        miss = balance * (1 / (1 + np.exp(-np.clip(h @ soft + bias, -40, 40))) - labels) / n
        new = ahead - lift * np.outer(back(miss), soft) / (soft @ soft)
        soft = soft - 0.05 * h.T @ miss / max(1.0, float((h * h).sum(axis=1).mean()))
        bias -= miss.sum()
        ahead, emb = new + step / (step + 3) * (new - emb), new
    flat = emb @ soft
    weight[used] = flat / spread
    mean = float(middle @ flat)                         # what a word weighs on average
    means = across(flat) - own * mean
    scale, shift = _platt(means, labels)
    if share:
        shift += np.log(share / (1 - share)) - np.log(ones / (n - ones))
    return Model((weight * scale).astype(np.float32), float(shift), mean * scale)


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a one-variable logistic regression, by Newton steps."""
    mean, sd = x.mean(), x.std() + 1e-12
    z = np.stack([(x - mean) / sd, np.ones(len(x))], axis=1)
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -40, 40)))
        grad = z.T @ (p - t) + 1e-3 * b
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0] / sd), float(b[1] - b[0] * mean / sd)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """A model from labelled documents: of each class those with the smallest
    seeded hashes, at most ``max_rows``; only those reach the driver."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_tx_id"), F.col(label_col).cast("int").alias("_tx_y")).distinct()
    order = F.xxhash64(F.lit(SEED), F.col("_tx_id"))
    count = {r["_tx_y"]: r["count"] for r in known.groupBy("_tx_y").count().collect()}
    few = [known.where(F.col("_tx_y") == y).orderBy(order, "_tx_id").limit(max_rows)
           for y in (0, 1)]
    rows = docs.select(F.col(id_col).alias("_tx_d"), F.col(text_col).alias("text")) \
        .join(F.broadcast(few[0].union(few[1])), F.col("_tx_d") == F.col("_tx_id")) \
        .select("text", "_tx_y", order.alias("h")).orderBy("h", "text", "_tx_y") \
        .limit(2 * max_rows).collect()
    share = count.get(1, 0) / max(1, sum(count.values()))
    return train([r["text"] for r in rows], np.array([r["_tx_y"] for r in rows], int), share)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the text column, with ``_tx_score`` from 0 to 1."""
    columns = [c for c in docs.columns if c != text_col]
    weight, bias, mean = model.weight, model.bias, model.mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Model(weight, bias, mean), WordCache()
        for batch in batches:
            bags = [words_of(t) for t in batch.column(len(columns)).to_pylist()]
            logit = []
            for at in range(0, len(bags), 200):        # new words are scored together
                new = known.unknown(set().union(*bags[at:at + 200]))
                known.update(zip(new, own.words(new).tolist()))
                for words in bags[at:at + 200]:
                    logit.append(own.logit(np.array(list(map(known.__getitem__, words)), float)))
            p = 1 / (1 + np.exp(-np.clip(np.array(logit, float), -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(columns)], pa.array(p, pa.float64())],
                names=[*columns, "_tx_score"])

    schema = docs.select(*columns).schema.add("_tx_score", "double")
    return map_batches(docs.select(*columns, text_col), run, schema)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id's text leaves 0; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))
