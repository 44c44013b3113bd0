"""Registered queries of this subpackage: one ``op<N>_<name>`` per operator, and ``pipeline``."""

from __future__ import annotations

import math
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.llm import conversation_repair, language_kn, pii_feistel, quality_qda, sentencepiece_unigram
from clipstat.llm.exact_fuse import exact_dedup
from clipstat.llm.line_templates import dedup_lines
from clipstat.llm.lm_mixing import score_texts
from clipstat.llm.pivot_index import link_vectors
from clipstat.llm.simhash_bk import simhash_groups
from clipstat.llm.source_mix import mix
from clipstat.llm.substring_sam import dedup_passages
from clipstat.llm.token_align import align_tokens
from clipstat.operators.nullsafe import join_null_safe


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(of: int) -> Column:
    """crc32(doc_id as text) mod ``of``."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = _table(spark, sf_dir, "labels").where(_fold(5) != 0)
    got = quality_qda.quality(_table(spark, sf_dir, "documents"), learn).withColumnRenamed("id", "doc_id")
    return got.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = exact_dedup(_table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash_groups(_table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_dropped", "text")


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_passages(_table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
bad AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS low FROM win) WHERE low < doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS g FROM bad GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN g IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(g, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_unigram.encode(docs, sentencepiece_unigram.load_pieces(), check_col="round_trip")
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "round_trip")


#: A fixed key for the fixture, so that reruns agree; real data need a secret one.
FIXTURE_KEY = "clipstat"


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii_feistel.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), key=FIXTURE_KEY)
    return got.select("doc_id", "text", *[pii_feistel.count_of(k).alias(f"n_{k}") for k in pii_feistel.KINDS])


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_kn.fit(docs.where(_fold(4) != 2))
    got = language_kn.identify(docs.select("doc_id", "text"), model)
    return got.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
                      F.col("lang_xent").alias("cross_entropy"), F.col("lang_rejected").alias("rejected"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mix(_table(spark, sf_dir, "documents"))
    return got.taken.selectExpr("_id AS doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
o AS (SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM s),
w AS (SELECT *, CASE src % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM o),
r AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()
           - coalesce(sum(cap) OVER (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b_left,
         sum(weight) OVER (ORDER BY cap / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM w),
l AS (SELECT *, CASE WHEN cap * w_left <= b_left * weight THEN NULL ELSE b_left / w_left END AS lvl FROM r),
t AS (
  SELECT *, CASE WHEN lvl IS NULL THEN cap
                 ELSE weight * (first_value(lvl IGNORE NULLS) OVER (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) END AS target
  FROM l),
q AS (SELECT *, least(floor(target + 0.5)::BIGINT, 2 * source_size) AS quota FROM t),
p AS (
  SELECT d.*, q.source_size, q.target, q.quota,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS pos
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, quota - pos)) + greatest(0, least(size, quota - source_size - pos)))::BIGINT AS taken
FROM p
"""


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = align_tokens(_table(spark, sf_dir, "documents"), digest=True)
    return got.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})



def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults by crc32 of conversation and turn: dropped (``gone``), emptied, without ends, repeated, all users."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    changed = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text)
    times = F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))
    return (conversations.withColumn("fault", fault)
            .select("conv_id", "turn", role.alias("role"), changed.alias("text"), (F.col("fault") == 0).alias("gone"), F.explode(times).alias("copy"))
            .drop("copy"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = conversation_repair.repair(damaged(_table(spark, sf_dir, "conversations")), gone_col="gone")
    digest = conversation_repair.message_digests(got.messages)
    return join_null_safe(got.summary, digest, ["conv_id"])



def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = score_texts(_table(spark, sf_dir, "documents"), _fold(5) != 1)
    return got.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                      (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_simhash": op4_simhash,
    "op5_lines": op5_lines,
    "op6_passages": op6_passages,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_pii": op8_pii,
    "op9_language": op9_language,
    "op10_source_mix": op10_source_mix,
    "op11_token_align": op11_token_align,
    "op12_conversations": op12_conversations,
    "op13_lm_score": op13_lm_score,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op6_passages": OP6_SQL,
    "op10_source_mix": OP10_SQL,
}
