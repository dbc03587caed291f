"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (ann_forest, html_extract, licenses, line_dedup, minhash, mixing,
                           packing, periodic_runs, preference, quality, secrets, token_align,
                           toxicity)
from orderlake.llm.common import materialize, table

CAPACITY = 4096


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_ld_text").alias("text"),
                      F.col("_ld_lines").alias("n_lines_deleted"),
                      F.col("_ld_words").alias("n_words_deleted"),
                      F.col("_ld_copy_of").alias("copy_of"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized_pieces(table(spark, sf_dir, "documents"),
                                      public_tokenizers.path("word_bpe_49k.json"), CAPACITY)
    return packing.best_fit_pack(pieces, CAPACITY)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = materialize(quality.measure(docs).drop("text"), "ql-measures")
    out = quality.judge(measured, quality.weigh(measured))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept", "p_good")
    return out.select("doc_id", *[F.col(quality.PREFIX + n).alias(n) for n in names])


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("_hx_text").alias("text"),
                      F.length("_hx_text").cast("long").alias("n_chars"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    out = toxicity.score(docs, model)
    return out.select("doc_id", toxicity.held_out().alias("held_out"),
                      F.col("_tx_score").alias("score"),
                      (F.col("_tx_score") >= 0.5).cast("int").alias("predicted"))


def op7_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_secret_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op10_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 are the chosen and the rejected one of pair k."""
    talks = preference.conversations(table(spark, sf_dir, "conversations")) \
        .withColumn("pair_id", F.floor(F.col("conv_id") / 2))
    out = preference.preference_pairs(talks.where("pmod(conv_id, 2) = 0"),
                                      talks.where("pmod(conv_id, 2) = 1"), "pair_id")
    return out.withColumn("chosen_spans", preference.listed("chosen_spans")) \
        .withColumn("rejected_spans", preference.listed("rejected_spans"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                       public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.path("piece_bpe_32k.model"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, starts = F.col("base.label"), F.col("base.start")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return out.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                      F.array_min(starts).alias("first_word"),
                      F.array_max(starts).alias("last_word"), listed(base).alias("base_labels"),
                      listed(F.concat(base, F.col("found.label"))).alias("labels"), "score")


def repeated_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of every tenth id's document, by its hash, the words of a stretch over and over."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                      rewrite=repeated_words)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"],
                                                   F.lit(","), r["period"], F.lit("\n")))
    length, period = F.col("best.length"), F.col("best.period")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                      F.col("best.start").alias("start"), length.alias("length"),
                      period.alias("period"),
                      F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                      F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_best_fit_packing, op3_quality_rules, op4_minhash_dedup,
        op5_html_extraction, op6_toxicity, op7_ann_forest, op8_source_mixing,
        op9_secret_formats, op10_preference_pairs, op11_token_alignment, op12_license_scan,
        op13_periodic_runs)}

_SPANS = """array_to_string(list_transform(
    list_filter(range(1, len({0}) + 1), lambda i: {0}[i].role = 'assistant'),
    lambda i: (coalesce(list_sum(list_transform({0}[:i - 1],
                 lambda x: length(x.role) + length(x.text) + 6)), 0)
               + length({0}[i].role) + 5)::INT::VARCHAR || ':'
           || (coalesce(list_sum(list_transform({0}[:i - 1],
                 lambda x: length(x.role) + length(x.text) + 6)), 0)
               + length({0}[i].role) + 5 + length({0}[i].text))::INT::VARCHAR), ',')"""
_RENDER = """array_to_string(list_transform({0},
    lambda x: '<|' || x.role || '|>' || chr(10) || x.text || chr(10)), '')"""

#: DuckDB statements for the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op10_preference_pairs": f"""
WITH rows AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
talks AS (
  SELECT conv_id, conv_id // 2 AS pair_id,
         list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS t
  FROM rows GROUP BY conv_id),
pairs AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, a.conv_id AS chosen_id,
         b.conv_id AS rejected_id, a.t AS c, b.t AS r
  FROM (SELECT * FROM talks WHERE conv_id % 2 = 0) a
  FULL JOIN (SELECT * FROM talks WHERE conv_id % 2 <> 0) b ON a.pair_id = b.pair_id),
common AS (
  SELECT *, coalesce(len(list_filter(range(1, least(len(c), len(r)) + 1), lambda i:
      c[:i] = r[:i])), 0)::INT AS n_common FROM pairs),
cut AS (
  SELECT *, c[n_common + 1:] AS cr, r[n_common + 1:] AS rr, c[:n_common] AS p FROM common)
SELECT pair_id, chosen_id, rejected_id, n_common,
       coalesce({_RENDER.format('p')}, '') AS prompt,
       {_RENDER.format('cr')} AS chosen, {_RENDER.format('rr')} AS rejected,
       {_SPANS.format('cr')} AS chosen_spans, {_SPANS.format('rr')} AS rejected_spans
FROM cut"""}
