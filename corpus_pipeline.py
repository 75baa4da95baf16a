"""The corpus pipeline: five stages from documents to token ids.

STAGES lists (name, function of (spark, docs, sf_dir)); each result is written as Parquet and read again as the next stage's docs.
All but the last return the columns of documents.

1. quality: documents that the classifier scores under 0.5 go.
2. near_duplicates: of each component of documents with Jaccard >= 0.8 of their five-word shingles one stays, that of the least doc_id.
3. personal_data: each span found is replaced by its kind in brackets; n_chars follows.
4. mixing: rows are put in the order of the Pfair mix of their sources; the files, by number and row, hold the mix.
5. tokens: position (the place, from 0, that mixing gave; rows that did not come from it unchanged are mixed here), n_tokens and ids (little-endian unsigned 32-bit) of each text by the public word BPE vocabulary.
"""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import bpe, jaccard, mixing, pii, quality
from folio.llm.common import delete, materialize, scratch, shared_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the labels of folds other than 1 of crc32(doc_id) mod 3, as op10 is; every document is scored."""
    labels = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    return quality.score(docs, quality.train(docs, labels), to="__score").where("__score >= 0.5").drop("__score")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row is told apart by its doc_id and text; of repeated rows one stays. Texts without words have no duplicates and all stay.

    The rows that stay are chosen by (doc_id, hash of the text); the documents meet this list dealt out by both, never by group, and repeated rows
    are merged in their tasks first."""
    found = jaccard.classes(docs.select("doc_id", "text"), n=5, num=80, den=100)
    known = lambda c: F.coalesce(F.col(c), F.lit(-(2**63)))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    best = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(row).alias("m"), F.count(F.lit(1)).alias("rows"))
    named = lambda x: x.select(known("doc_id").alias("__id"), F.col("th").alias("__th"))
    best = materialize(best.select("m.doc_id", "m.th", "rows"), "best")
    # Of these, rows that are there more than once.
    many = named(found.where("n_shingles > 0")).groupBy("__id", "__th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__id", "__th")
    many = materialize(many.join(named(best.where("rows > 1")), ["__id", "__th"], "left_semi"), "many")
    stay = named(best).join(many, ["__id", "__th"], "left_anti").unionByName(named(found.where("n_shingles = 0")).distinct())
    keyed = docs.withColumns({"__id": known("doc_id"), "__th": F.xxhash64("text")})
    out = keyed.join(materialize(stay, "stay"), ["__id", "__th"]).select(*docs.columns)
    if many.isEmpty():
        return out
    # One row of each is taken in every task, then of these.
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns))
    return out.unionByName(keyed.join(many, ["__id", "__th"]).groupBy("__id", "__th").agg(one.alias("__one")).select("__one.*"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(mixing.with_position(docs), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

#: A learned classifier decides in the first stage, which SQL cannot express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; what a stage no longer needs is deleted."""

    def step(before: tuple[DataFrame, str | None], stage) -> tuple[DataFrame, str]:
        docs, path = before
        to = f"{shared_dir(spark)}/pipeline-{stage[0]}-{uuid.uuid4().hex}"
        with scratch(spark):
            stage[1](spark, docs, sf_dir).write.parquet(to)
        if path:
            delete(spark, path)
        return spark.read.parquet(to), to

    return functools.reduce(step, STAGES, (table(spark, sf_dir, "documents"), None))[0]
