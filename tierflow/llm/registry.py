"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import decontam, exactdup, merkle, mixing, neardup, ngram_lm, phrases, pii, repeats, sharding, tokencount, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.form_topic(F.col("text"))}
    got = mixing.mix(_table(spark, sf_dir, "documents"), dims)
    return got.select("doc_id", "n_tokens", "dim_source", "dim_lang", "dim_topic", "probability", "selected")


OP1_SQL = mixing.oracle({"source": "source", "lang": "lang", "topic": """CASE
    WHEN (length(coalesce(text, '')) - length(replace(coalesce(text, ''), '|', ''))) * 50 > length(coalesce(text, '')) THEN 'table'
    WHEN contains(coalesce(text, ''), '@') OR contains(coalesce(text, ''), '://') THEN 'contact'
    WHEN contains(coalesce(text, ''), '!!') THEN 'shout' WHEN length(coalesce(text, '')) > 5000 THEN 'long' ELSE 'prose' END"""})


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fitted(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.toxicity_scores(docs, model)
    return scored.select("doc_id", F.coalesce(~toxicity.learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(_table(spark, sf_dir, "pages"))
    records = warc.read_archives(manifest, payload=False)

    def ident(column):
        return F.regexp_extract(column, "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")
    return records.select(ident("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", ident("refers_to").alias("refers_to"), "digest_ok")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.length_histogram(tokencount.token_counts(_table(spark, sf_dir, "documents").select("text")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(_table(spark, sf_dir, "documents"), keep="max")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.digest(pii.pii_spans(_table(spark, sf_dir, "documents")))
    first = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    return got.select(*first, *(c for c in got.columns if c not in first))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = ngram_lm.fit(docs.filter(~ngram_lm.held_out(F.col("doc_id"))), least=1)
    got = ngram_lm.lm_scores(docs, model)
    return got.select("doc_id", ngram_lm.held_out(F.col("doc_id")).alias("held_out"), *(c for c in got.columns if c != "doc_id"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.reshard(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = repeats.drop_repeats(_table(spark, sf_dir, "documents"), words=50)
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), least=30, top=2000)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_mixing, op2_neardup, op3_toxicity, op4_warc, op5_token_counts, op6_decontamination,
                                                     op7_exact_dedup, op8_pii, op9_lm_scoring, op10_sharding, op11_merkle_manifest, op12_substring_dedup, op13_phrases, pipeline)}
ORACLE: dict[str, str] = {"op1_mixing": OP1_SQL, "op4_warc": warc.ORACLE, "op7_exact_dedup": exactdup.ORACLE, "op11_merkle_manifest": merkle.ORACLE,
                          "op12_substring_dedup": repeats.ORACLE, "op13_phrases": phrases.ORACLE}
