"""Corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's ``docs``.

1. quality classifier: documents with a score below 0.5 go
2. line dedup: later occurrences of repeated passages go; a document that
   loses all its lines goes (every line of it stands elsewhere)
3. n-gram Jaccard join: one document of each group of near duplicates stays
4. source mixing: documents are repeated or left out to meet the targets
5. best-fit packing: every remaining document's place in training sequences

All stages but the last return the columns of ``documents``; where line dedup
changes a text, ``n_chars`` follows it.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import fresh, materialize, read, release, tasks, text_hash
from adlens.llm.line_dedup import PASSAGE, line_dedup
from adlens.llm.mixing import SHARDS, mix
from adlens.llm.ngram_join import ngram_join
from adlens.llm.packing import pack
from adlens.llm.quality import fit, with_quality


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score, = fresh(docs, "score")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return with_quality(docs, model, score=score).where(F.col(score) >= 0.5).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    total, gone = fresh(docs, "n_lines", "n_removed")
    out = line_dedup(docs, n_lines=total, n_removed=gone, passage=PASSAGE).where(
        (F.col(gone) == 0) | (F.col(gone) < F.col(total)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, F.char_length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop(total, gone)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Equal rows (same id and text) count as one document."""
    k_id, k_text = fresh(docs, "k_id", "k_text")
    kept = (ngram_join(docs, count_links=False).where("keep").select(F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_text)).distinct())
    hashed, = fresh(docs.select("*", F.lit(0).alias(k_id), F.lit(0).alias(k_text)), "hashed")
    rows = docs.withColumn(hashed, text_hash("text"))
    return (rows.join(kept, F.col("doc_id").eqNullSafe(F.col(k_id)) & (F.col(hashed) == F.col(k_text)), "left_semi")
            .dropDuplicates(["doc_id", hashed]).drop(hashed))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    shard, = fresh(docs, "shard")
    return mix(docs, shards=max(SHARDS, tasks(spark)), shard=shard).drop(shard)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


def _alone(stage):
    """The stage, begun and ended without what others have left on the driver."""

    @wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        out = stage(spark, docs, sf_dir)
        release(spark)
        return out

    return begin


STAGES = [
    ("quality_classifier", _alone(keep_good)),
    ("line_dedup", _alone(drop_repeated_lines)),
    ("ngram_jaccard_join", _alone(keep_one_of_each_group)),
    ("source_mixing", _alone(mix_sources)),
    ("best_fit_packing", _alone(pack_sequences)),
]

#: The classifier, the keyed draws and best-fit have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = read(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
