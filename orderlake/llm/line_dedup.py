"""Line dedup by pairwise alignment: blocks of lines that a later document
shares with an earlier one are deleted from the later one.

1. Documents with equal text are one text, owned by its smallest id; the other
   rows are copies as a whole.
2. Texts that overlap are found through shared line hashes.  A line that at
   most ``RARE`` texts hold is evidence by itself.  A more frequent line is not;
   it is hashed together with the lines after it, or before it, up to
   ``MIN_WORDS`` words (``windows``), so that every block that could be deleted
   is still found, however many texts hold it.
3. Each text is paired with the first holder of each of its hashes: as many
   pairs as there are holders, never all pairs of a group.
4. Patience diff aligns a pair: lines unique in both are matched along the
   longest increasing run, and the gaps between matches in the same way.
   Aligned blocks of ``MIN_WORDS`` words or more go from the later text.  Lines
   that this leaves, because they are repeated or in another order, are looked
   up by the windows of the pair: each run of ``MIN_WORDS`` words or more that
   the earlier text holds goes.

What is deleted stays in the earliest document that holds it.

Defined results: lines are compared without surrounding ASCII white space;
lines without words neither match nor count, and go with a block that encloses
them; a null id comes after all others; a null text stays null and an empty one
empty; rows that repeat an id and a text are one document and keep the same
result; a whole copy of fewer than ``MIN_WORDS`` words stays; extra columns pass
through.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_batches, materialize, utf8

MIN_WORDS = 50
RARE = 32
#: Columns that ``dedup_lines`` adds.
ADDED = ("_ld_text", "_ld_lines", "_ld_words", "_ld_copy_of")


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched positions (in ``a``, in ``b``), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {h: i for i, h in enumerate(a[a0:a1], a0) if in_a[h] == 1 and in_b[h] == 1}
        unique = [(at[h], j) for j, h in enumerate(b[b0:b1], b0) if h in at]
        if not unique:
            continue
        tails: list[int] = []           # longest increasing run of positions in a
        last: list[int] = []
        back: list[int] = []
        for k, (i, _) in enumerate(unique):
            p = bisect_left(tails, i)
            back.append(last[p - 1] if p else -1)
            tails[p:p + 1], last[p:p + 1] = [i], [k]
        run, k = [], last[-1]
        while k >= 0:
            run.append(unique[k])
            k = back[k]
        p, q = a0, b0
        for i, j in run[::-1]:
            todo.append((p, i, q, j))
            # the match itself heads the next gap, so equal neighbours join it
            p, q = i, j
        todo.append((p, a1, q, b1))
    return sorted(out)


def windows(words: list[int], least: int) -> set[tuple[int, int]]:
    """(first, end) of the shortest runs of ``least`` words or more from a line on
    and up to a line, and of two lines that have as many each.

    Those inside a longer run cover it, each line break in it included.
    """
    out = set()
    end = total = 0
    for i, n in enumerate(words):
        while end < len(words) and total < least:
            total += words[end]
            end += 1
        if total < least:
            break
        out.add((i, end))
        total -= n
    first = total = 0
    for i, n in enumerate(words):
        total += n
        while total - words[first] >= least:
            total -= words[first]
            first += 1
        if total >= least:
            out.add((first, i + 1))
        if i and n >= least and words[i - 1] >= least:
            out.add((i - 1, i + 1))
    return out


def common_blocks(a: list[int], b: list[int], words: list[int], least: int) -> list[tuple[int, int]]:
    """(first, end) in ``b`` of the runs of ``least`` words or more that ``a`` holds."""
    out, first, before = [], 0, (-2, -2)
    matches = patience(a, b)
    for k, (i, j) in enumerate([*matches, (-9, -9)]):
        if (i - 1, j - 1) != before:
            if k and sum(words[first:before[1] + 1]) >= least:
                out.append((first, before[1] + 1))
            first = j
        before = (i, j)
    inside = {j for x, y in out for j in range(x, y)}
    in_a = set(a)
    if all(j in inside for j, h in enumerate(b) if h in in_a) \
            and all(x[1] < y[0] for x, y in zip(out, out[1:])):
        return out
    size = dict(zip(b, words))                    # lines that b lacks count nothing
    held = {tuple(a[x:y]) for x, y in windows([size.get(h, 0) for h in a], least)}
    joined: list[tuple[int, int]] = []
    for x, y in sorted([*out, *(w for w in windows(words, least) if tuple(b[w[0]:w[1]]) in held)]):
        if joined and x < joined[-1][1]:
            joined[-1] = (joined[-1][0], max(y, joined[-1][1]))
        else:
            joined.append((x, y))
    return joined


def line_table(docs: DataFrame, least: int) -> DataFrame:
    """doc, tid, lines (hashes of lines with words), words, anchors per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        for batch in batches:
            lines, words, alone, runs = [], [], [], []
            for text in utf8(batch.column(2)):
                parts = [p for x in (text or b"").split(b"\n") if (p := x.strip())]
                h, w = [digest(p) - (1 << 63) for p in parts], [len(p.split()) for p in parts]
                lines.append(h)
                words.append(w)
                alone.append(list(set(h)))
                found = {digest(b"\n".join(parts[x:y]), 1) - (1 << 63) for x, y in windows(w, least)}
                runs.append(list(found))
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lines, many),
                 pa.array(words, pa.list_(pa.int32())), pa.array(alone, many),
                 pa.array(runs, many)],
                names=["doc", "tid", "lines", "words", "alone", "runs"])

    return map_batches(docs, run, "doc long, tid string, lines array<long>, words array<int>, "
                                  "alone array<long>, runs array<long>")


def deletions(docs: DataFrame, least: int = MIN_WORDS, rare: int = RARE,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """tid (md5 of the text), owner, n_words, blocks [(first, end)] to delete,
    counted in lines with words."""
    rows = line_table(docs.where(F.col(text_col) != "").select(
        F.col(id_col).cast("long").alias("doc"), F.md5(text_col).alias("tid"), F.col(text_col)),
        least)
    texts = materialize(rows.groupBy("tid").agg(
        F.min("doc").alias("doc"), *[F.first(c).alias(c) for c in rows.columns[2:]]), "ld-texts")
    # order of texts: the smallest id, null last; equal ids by the text
    order = F.struct(F.col("doc").isNull().alias("late"), "doc", "tid")
    anchors = texts.select("tid", order.alias("at"), F.explode(F.array(
        F.struct(F.lit(True).alias("alone"), F.col("alone").alias("hs")),
        F.struct(F.lit(False).alias("alone"), F.col("runs").alias("hs")))).alias("a")) \
        .select("tid", "at", "a.alone", F.explode("a.hs").alias("h"))
    holders = anchors.groupBy("alone", "h").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first")) \
        .where((F.col("n") > 1) & (~F.col("alone") | (F.col("n") <= rare))) \
        .select("alone", "h", F.col("first.tid").alias("earlier"))
    pairs = anchors.select("tid", "alone", "h").join(holders, ["alone", "h"]) \
        .where("tid <> earlier").select("tid", "earlier").distinct()
    later = texts.select("tid", F.col("lines").alias("b"), F.col("words").alias("w"))
    earlier = texts.select(F.col("tid").alias("earlier"), F.col("lines").alias("a"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            found = [common_blocks(a, b, w, least) for a, b, w in zip(at["a"], at["b"], at["w"])]
            flat = pa.array([[{"first": x, "end": y} for x, y in f] for f in found],
                            pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array(at["tid"]), flat], names=["tid", "blocks"])

    both = pairs.join(later, "tid").join(earlier, "earlier").select("tid", "a", "b", "w")
    blocks = map_batches(both, align, "tid string, blocks array<struct<first: int, end: int>>") \
        .where(F.size("blocks") > 0) \
        .groupBy("tid").agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks"))
    total = F.aggregate("words", F.lit(0).cast("long"), lambda s, x: s + x)
    return texts.select("tid", F.col("doc").alias("owner"), total.alias("n_words")) \
        .join(blocks, "tid", "left")


def without(text: bytes, blocks: list[dict] | None) -> tuple[bytes, int, int]:
    """The text without the blocks; lines and words deleted."""
    if not blocks:
        return text, 0, 0
    lines = text.split(b"\n")
    full = [i for i, x in enumerate(lines) if x.strip()]
    gone: set[int] = set()
    for x in blocks:
        gone.update(range(full[x["first"]], full[x["end"] - 1] + 1))
    return (b"\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone),
            sum(len(lines[i].split()) for i in gone))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS, rare: int = RARE,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the cleaned text, the lines and words deleted, and for a
    whole copy the id of the earlier document (``ADDED``)."""
    found = deletions(docs, least, rare, id_col, text_col).withColumnRenamed("tid", "_ld_tid")
    columns = docs.columns
    inner = [f"_in_{i}" for i in range(len(columns))]     # no clash with names used here
    keyed = docs.toDF(*inner).withColumn("_ld_key", F.md5(inner[columns.index(text_col)]))
    joined = keyed.join(found, F.col("_ld_key") == F.col("_ld_tid"), "left")
    whole = ~F.col(inner[columns.index(id_col)]).cast("long").eqNullSafe(F.col("owner")) \
        & F.col("_ld_tid").isNotNull() & (F.col("n_words") >= least)
    ready = joined.select(*inner, F.col("blocks").alias("_ld_blocks"),
                          F.when(whole, F.col("owner")).alias("_ld_copy_of"),
                          F.coalesce(whole, F.lit(False)).alias("_ld_whole"))
    at = columns.index(text_col)
    k = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, lines, words = [], [], []
            for text, blocks, copy in zip(utf8(batch.column(at)), batch.column(k).to_pylist(),
                                          batch.column(k + 2).to_pylist()):
                if text is None:
                    new = (None, 0, 0)
                elif copy:
                    new = (b"", text.count(b"\n") + 1, len(text.split()))
                else:
                    new = without(text, blocks)
                for column, value in zip((kept, lines, words), new):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:k], pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(lines, pa.int64()), pa.array(words, pa.int64()), batch.column(k + 1)],
                names=[*columns, *ADDED])

    schema = docs.schema
    schema = type(schema)(list(schema.fields))
    for name, kind in zip(ADDED, ("string", "long", "long", "long")):
        schema = schema.add(name, kind)
    return map_batches(ready, run, schema)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their texts cleaned; a document whose words are all deleted
    goes, one that had none to begin with stays."""
    out = dedup_lines(docs, id_col=id_col, text_col=text_col)
    emptied = (F.col("_ld_words") > 0) & ~F.col("_ld_text").rlike(r"[^\x20\x09-\x0D]")
    return out.where(~emptied).select(*[
        F.col("_ld_text").alias(c) if c == text_col else F.col(c) for c in docs.columns])
