"""One registered query per operator, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardroll.llm import (
    bpe,
    exact_dedup,
    lexical_search,
    license_scan,
    nearest,
    packing,
    quality_gam,
    quality_rules,
    runs,
    sharding,
    simhash,
    toxicity,
    url_filter,
)
from boardroll.llm.common import remainder


# The url rules and their verdicts.
URL_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode and decode every text with the public multilingual byte-level vocabulary."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    return bpe.round_trip(_table(spark, folder, "documents"), codec)


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces in sequences of 512 to 8192 words."""
    return packing.pack(_table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text; rows whose id has remainder 0 modulo 5 teach nothing."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.train(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    scored = toxicity.predict(toxicity.score(docs, model))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op4_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every text; rows whose id has remainder 2 modulo 4 teach nothing."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = quality_gam.train(docs, labels, remainder(F.col("doc_id"), 4) != 2)
    scored = quality_gam.predict(quality_gam.score(docs, model), 0.7)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of identical texts; the largest id of each stays."""
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"), digests=True)


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's host, path, rule and verdict; the rules' own verdicts train the model."""
    pages = _table(spark, folder, "pages")
    return url_filter.judge(pages, URL_RULES, url_filter.rule_labels(pages, URL_RULES))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases, tags and expressions in every text."""
    return license_scan.scan_licences(_table(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, tokens and rows."""
    return sharding.shard_documents(_table(spark, folder, "documents"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base statistics of every text, the base rule, and robust outliers among the rest."""
    return quality_rules.judge(_table(spark, folder, "documents"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint, and smallest id reachable by links of three or fewer bits."""
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    index = lexical_search.build_index(_table(spark, folder, "documents"))
    return lexical_search.search(index, _table(spark, folder, "benchmark"), 10)


def op12_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one."""
    vectors = _table(spark, folder, "embeddings")
    graph = nearest.build_graph(vectors, 10)
    return nearest.nearest(graph, vectors, F.col("vec_id") % 100 == 0, 10)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of 24 words and three periods or more; every tenth document is made periodic."""
    found = runs.find_runs(runs.looped(_table(spark, folder, "documents")), 24, 3)
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("strongest.start").alias("start"),
        F.col("strongest.length").alias("length"),
        F.col("strongest.period").alias("period"),
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_quality_gam": op4_quality_gam,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_license_scan": op7_license_scan,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash": op10_simhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_nearest": op12_nearest,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_lexical_search": r"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        counted AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
        sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counted, totals GROUP BY term, docs
        ),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) //
                (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (doc_id), totals
            GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
}
