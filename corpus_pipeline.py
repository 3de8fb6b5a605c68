"""A corpus cleaned and packed for training, stage by stage.

Each stage takes (spark, docs, sf_dir), where ``docs`` is what its predecessor kept, and
returns the documents it keeps with all their columns; the last returns the packing. A
stage's result is written as Parquet and read again as the next one's input.

Models are trained within their stage on the labels of ``sf_dir`` for documents of the
stage's own input, in bounded samples, and then judge all of that input. Held-out ids are
those of the operators' own queries. No stage can be put into SQL as a whole, so there is
no ``ORACLE_SQL``; tests hold the pipeline against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardroll.llm import exact_dedup, packing, quality_gam, simhash, toxicity
from boardroll.llm.common import release, remainder, stage, staged, unstage

QUALITY_FROM = 0.7
TOXIC_FROM = 0.5
NEAR_BITS = 3
NEAR_SHINGLE = 3
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_gam.train(docs, labels, remainder(F.col("doc_id"), 4) != 2)
    return quality_gam.accepted(docs, model, QUALITY_FROM)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    return toxicity.harmless(docs, model, TOXIC_FROM)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest id, of each group of identical texts."""
    return exact_dedup.without_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by SimHash.

    Fingerprints of three-word shingles link at three or fewer differing bits, as in op10.
    """
    return simhash.without_near_duplicates(docs, NEAR_BITS, NEAR_SHINGLE)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every remaining document, placed in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; every stage's result is staged as Parquet."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        before = staged(spark)
        result = stage(step(spark, docs, sf_dir), name)
        release(spark, since=before, but=result)  # the stage's own tables, once it is written
        unstage(docs)
        docs = result
    return docs
