"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each level only looks at what the level before left over:

1. the length in bytes of every text; rows of a length that occurs once are unique;
2. a hash of the first ``prefix`` characters, for rows of a repeated length;
3. SHA-256 of the whole text, for rows whose (length, prefix hash) occurs again.

What a level leaves over is kept as a bitmap over hashed keys. Its size follows the number
of rows up to ``most_bits`` (a few MB), a proven bound, so it is broadcast and tested in
the scan: no text is ever shuffled. Two keys may share a bit; such a row is just refined
once more than needed. Only the third level decides equality, together with the length.

Only DataFrame functions are used. Defined results: a null text is the empty text; of equal
texts the largest id stays (a null id only if all ids of its group are null), and of rows
that also share that id one stays; ``group_size`` counts rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardroll.llm.common import bitmap, bits_for, keep_marked, stage, text_of, with_bit


def _repeated(keys: DataFrame, bits: int) -> DataFrame:
    """Bitmap of the keys in ``key`` that occur more than once."""
    return bitmap(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), bits)


def exact_duplicates(
    docs: DataFrame, prefix: int = 128, most_bits: int = 1 << 26, digests: bool = False
) -> DataFrame:
    """doc_id, keep_id, group_size and kept of every row.

    With ``digests`` also ``text_sha256`` of every row; the rows that refinement leaves out
    are then read in full for that column alone.
    """
    text = text_of(docs)
    bits = bits_for(docs.count(), most_bits)
    rows = docs.select("doc_id", text.alias("body"))
    length = F.octet_length("body").cast("long")
    by_length = F.xxhash64(length)
    by_prefix = F.xxhash64(length, F.substring("body", 1, prefix))

    lengths = stage(_repeated(rows.select(by_length.alias("key")), bits), "lengths")
    rows = with_bit(rows, by_length, lengths, bits, "second")
    prefixes = stage(_repeated(rows.where("second").select(by_prefix.alias("key")), bits), "prefixes")
    rows = with_bit(rows, F.when(F.col("second"), by_prefix), prefixes, bits, "third")

    full = F.sha2(F.col("body").cast("binary"), 256)
    columns = ["doc_id", F.when(F.col("third"), F.unhex(full)).alias("full"), length.alias("size")]
    marked = rows.select(*columns, *([F.unhex(full).alias("digest")] if digests else []))
    marked = stage(marked.withColumn("tie", F.monotonically_increasing_id()), "digests")

    best = F.max(F.struct(F.coalesce(F.col("doc_id").isNotNull(), F.lit(False)), "doc_id", "tie"))
    groups = (
        marked.where(F.col("full").isNotNull())
        .groupBy("full", "size")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .where("group_size > 1")
        .select(F.col("full").alias("key"), F.col("size").alias("key_size"), "group_size", "best")
    )
    groups = stage(groups, "groups")
    # Rows without a full hash are unique; their own hash keeps them from meeting in one task.
    key = F.coalesce("full", F.unhex(F.sha2(F.col("tie").cast("string").cast("binary"), 256)))
    found = marked.withColumn("own_key", key).join(
        groups, (F.col("own_key") == F.col("key")) & (F.col("size") == F.col("key_size")), "left"
    )
    alone = F.col("key").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("best.tie") == F.col("tie"))).alias("kept"),
        *([F.lower(F.hex("digest")).alias("text_sha256")] if digests else []),
    )


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with their columns.

    Rows are chosen by id and text digest. Where a table repeats an id with the same text,
    one of those rows is taken.
    """
    marked = exact_duplicates(docs, digests=True)
    marked = marked.select("doc_id", "kept", F.unhex("text_sha256").alias("digest"))
    return keep_marked(docs, stage(marked, "marked"))
