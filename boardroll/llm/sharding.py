"""Sharding: vector bin packing that balances bytes, tokens and rows of shards jointly.

Rows with equal texts form a group, which is placed whole unless it is so large that no
shard could take it evenly: a group of more than a ``1 / (shards * split)`` share of the
bytes, tokens or rows is dealt into parts by row first (there can be only a bounded number
of such groups). Each group is a vector of three demands and goes to the shard where the
dot product with the residual capacity is highest.

Groups above a ``1 / (shards * fine)`` share, of which there are at most
``3 * shards * fine``, are placed first, one after the other, from large to small. All
others are dealt by hash into blocks of about ``block_rows`` groups; each block is placed
by itself into its share of the capacity that the large groups left. A group of a block is
so small a part of a shard that the blocks' differences vanish in the sum.

Slots within a shard are numbered by counting per bucket of rows, adding up the counts,
and numbering within each bucket, so no task orders a whole shard.

Defined results: a null text has no bytes and no tokens; null and repeated ids are placed
row by row; an empty table gives no rows; the law that holds is ``bytes``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardroll.llm.common import stage, text_of
from boardroll.llm.packing import word_count

_DEMANDS = ("bytes", "tokens", "rows")
WEIGHTS = (2.0, 1.0, 1.0)
"""How much each demand counts; bytes lead, as theirs is the law."""


def place(demands: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each group, and what each shard took.

    ``demands`` (n, 3) and ``capacity`` (shards, 3) are in the same units; groups go from
    the largest to the smallest, ties by position.
    """
    mean = np.maximum(capacity.mean(axis=0), 1e-12)
    need = demands / mean * np.sqrt(WEIGHTS)
    room = capacity / mean * np.sqrt(WEIGHTS)
    shard = np.empty(len(need), np.int64)
    for k in np.argsort(-need.max(axis=1), kind="stable").tolist():
        shard[k] = at = int((room @ need[k]).argmax())
        room[at] -= need[k]
    taken = np.stack([np.bincount(shard, demands[:, d], len(capacity)) for d in range(3)], axis=1)
    return shard, taken


def _items(rows: DataFrame, shards: int, split: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Rows with their part, the groups (grp, part) with their demands, and the totals."""
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    totals = rows.agg(*sums).first()
    total = np.array([float(totals[d] or 0) for d in _DEMANDS])
    share = F.greatest(*[F.col(d) / F.lit(max(total[k], 1.0)) for k, d in enumerate(_DEMANDS)])
    parts = F.least(F.ceil(share * (shards * split)), F.col("rows")).cast("long")
    large = rows.groupBy("grp").agg(*sums).select("grp", parts.alias("parts")).where("parts > 1")
    large = stage(large, "large-groups")  # at most 3 * shards * split rows
    rows = rows.join(F.broadcast(large), "grp", "left").withColumn(
        "part", F.pmod(F.xxhash64("rid"), F.coalesce("parts", F.lit(1)))
    )
    rows = stage(rows.drop("parts"), "rows")
    return rows, stage(rows.groupBy("grp", "part").agg(*sums), "groups"), total


def assign(rows: DataFrame, shards: int, split: int = 8, fine: int = 1000, block_rows: int = 20000) -> DataFrame:
    """``rows`` (rid, grp, size, tokens) with their shard."""
    rows, items, total = _items(rows, shards, split)
    share = F.greatest(*[F.col(d) / F.lit(max(total[k], 1.0)) for k, d in enumerate(_DEMANDS)])
    large = items.where(share * (shards * fine) > 1)
    held = large.select("grp", "part", *_DEMANDS).toArrow()  # at most 3 * shards * fine rows
    held = held.sort_by([("grp", "ascending"), ("part", "ascending")])
    demands = np.stack([held.column(d).to_numpy().astype(float) for d in _DEMANDS], axis=1)
    chosen, taken = place(demands, np.tile(total / shards, (shards, 1)))
    left = np.maximum(total / shards - taken, 0.0)
    left /= np.maximum(left.sum(axis=0), 1e-12)

    small = items.where(share * (shards * fine) <= 1)
    blocks = max(1, -(-small.count() // block_rows))
    key = F.xxhash64("grp", "part")
    small = small.withColumn("key", key).withColumn("block", F.pmod("key", F.lit(blocks)))

    def packed(table: pa.Table) -> pa.RecordBatch:
        table = table.sort_by([("key", "ascending"), ("grp", "ascending"), ("part", "ascending")])
        own = np.stack([table.column(d).to_numpy().astype(float) for d in _DEMANDS], axis=1)
        shard, _ = place(own, left * own.sum(axis=0))
        columns = [table.column("grp").combine_chunks(), table.column("part").combine_chunks(), pa.array(shard, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["grp", "part", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for given in batches:
            if not given.num_rows:
                continue
            block = given.column(given.schema.get_field_index("block")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if waiting and waiting[-1].column("block")[0].as_py() != block[low]:
                    yield packed(pa.Table.from_batches(waiting))
                    waiting = []
                waiting.append(given.slice(low, high - low))
        if waiting:
            yield packed(pa.Table.from_batches(waiting))

    schema = "grp binary, part long, shard int"
    dealt = small.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(run, schema)
    first = pa.table([held.column("grp"), held.column("part"), pa.array(chosen, pa.int32())], names=["grp", "part", "shard"])
    spark = rows.sparkSession
    placed = dealt if not held.num_rows else dealt.unionByName(spark.createDataFrame(first, schema))
    return rows.join(stage(placed, "shards"), ["grp", "part"]).drop("part")


def slots(rows: DataFrame, shards: int) -> DataFrame:
    """Adds ``slot``, gapless from 0 within each shard; rows are told apart by ``rid``."""
    buckets = max(1, int((rows.count() / shards) ** 0.5))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("rid"), F.lit(buckets)))
    counts = stage(rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lower"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "rid"))
    numbered = rows.withColumn("inside", inside)
    return numbered.join(stage(offsets, "offsets"), ["shard", "bucket"]).withColumn(
        "slot", (F.col("lower") + F.col("inside") - 1).cast("long")
    )


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law)."""
    text = text_of(docs)
    raw = text.cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        word_count(text).cast("long").alias("tokens"),
        F.unhex(F.md5(raw)).alias("grp"),
        F.monotonically_increasing_id().alias("rid"),
    )
    placed = stage(assign(stage(rows, "sizes"), shards), "placed")
    return slots(placed, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
