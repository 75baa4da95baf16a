"""The queries of this folder: thin calls of the operators with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import audit, bpe, codes, cuckoo, fingerprint, jaccard, langid, mixing, pii, quality, suffix_dedup, topk, warc
from folio.llm.common import table


def _fold(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.interleave(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", *[F.col(f"__{c}").cast("long").alias(c) for c in ("block", "release", "deadline", "slot", "position")])


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest_query(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = jaccard.classes(table(spark, sf_dir, "documents"), n=4, num=85, den=100)
    return got.select("doc_id", "n_shingles", "component_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.learn(docs.where(_fold(5) != 0).select("doc_id", "text", "lang"))
    got = langid.predict(docs.select("doc_id", "text"), dictionaries)
    return got.select("doc_id", (_fold(5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_query(table(spark, sf_dir, "documents"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.digest_query(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(_fold(3) != 1)
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", (_fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.duplicates(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_mixing, op2_warc, op3_suffix_dedup, op4_topk, op5_ngram_jaccard, op6_language, op7_pii, op8_order_minhash, op9_bpe, op10_quality)
    ops += (op11_exact_dedup, op12_filter_audit, op13_vector_codes)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.ORACLE, "op2_warc": warc.ORACLE, "op3_suffix_dedup": suffix_dedup.ORACLE, "op4_topk": topk.ORACLE, "op5_ngram_jaccard": jaccard.ORACLE, "op7_pii": pii.oracle()} | {
        "op11_exact_dedup": cuckoo.ORACLE, "op12_filter_audit": audit.ORACLE, "op13_vector_codes": codes.oracle()
    }
