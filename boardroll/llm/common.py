"""What the operators share: scratch tables, text mapping in Arrow batches, label samples."""

from __future__ import annotations

import gc
import pickle
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_ROWS_AT_ONCE = 512
_SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "256"}
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables between steps: ``spark.checkpoint.dir``, else the warehouse.

    No temporary folder of a machine is ever used. The warehouse of a session that names none is
    a folder of the driver's machine, which executors elsewhere do not see; there that is
    an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    master = spark.sparkContext.master
    if not named and root.startswith(("file:", "/")) and not master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return root


def stage(df: DataFrame, name: str, **layout: object) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: what follows re-reads files instead of repeating the work when
    an executor is lost, and the planner knows the table's size. ``release`` deletes the
    tables that a session has staged. ``layout`` are options of the Parquet writer.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/boardroll-{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.options(**layout).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged = path
    return table


def staged(spark: SparkSession) -> int:
    """How many tables this session holds staged now; for ``release`` to go back to."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, but: DataFrame | None = None) -> int:
    """Delete the tables staged since there were ``since`` of them, all but one; how many they were.

    Call it once what was made of them is saved.
    """
    mine = _made.get(spark.sparkContext.applicationId, [])
    gone = [p for p in mine[since:] if p != getattr(but, "_staged", None)]
    for path in gone:
        mine.remove(path)
        _delete(spark, path)
    return len(gone)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again; other frames stay as they are."""
    for table in tables:
        mine = _made.get(table.sparkSession.sparkContext.applicationId, [])
        if (path := getattr(table, "_staged", None)) in mine:
            mine.remove(path)
            _delete(table.sparkSession, path)


def give_up_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that are out of use.

    The cleaner acts once the driver's JVM has collected the plans, which in a long loop of
    small ones may be long after the disk is full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows reach and leave Python in batches of a few MB, whatever the session says, for what runs meanwhile.

    By default a batch holds 64 MB, and while its buffers are doubled a task holds three times that
    outside the heap; and 4,096 rows are decoded at once, however long their texts.
    """
    before = {key: spark.conf.get(key) for key in _SMALL_BATCHES}
    for key, value in _SMALL_BATCHES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def share(df: DataFrame, value: object) -> Callable[[], object]:
    """Broadcast a model or vocabulary of bounded size; the result gives it inside tasks."""
    packed = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def map_texts(
    docs: DataFrame,
    work: Callable[[], Callable[[list[str]], Sequence[pa.Array]]],
    fields: Sequence[StructField],
    keys: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Apply ``work()`` to every whole text in Arrow batches, keeping the row's ``keys``.

    ``work`` is called once per task and gives a function from a list of texts (null as
    empty) to one Arrow array per field. At most ``_ROWS_AT_ONCE`` texts are unpacked at
    a time. Rows are independent: no shuffle, one output row per input row.
    """
    schema = StructType([*(StructField(k, docs.schema[k].dataType) for k in keys), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = work()
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(at, _ROWS_AT_ONCE)
                texts = [t or "" for t in part.column(len(keys)).to_pylist()]
                columns = [*part.columns[: len(keys)], *apply(texts)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return docs.select(*keys, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id has remainder -1."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus, F.lit(-1))


def label_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """Texts of at most ``per_class`` labelled documents of each class, and all classes' sizes.

    The texts have the columns doc_id, label and text.

    Only ids that ``docs`` holds and ``usable`` (a condition on ``doc_id``) admits are
    drawn, in the order of a hash, so the sample does not depend on the layout. A
    document labelled twice takes the larger label; null ids and labels teach nothing.
    The drawn ids are at most ``2 * per_class`` rows of 16 bytes, a proven bound, and so
    are broadcast; texts are not shuffled but for the sample itself.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    held = stage(marked.join(docs.select("doc_id"), "doc_id", "left_semi"), "labelled")
    sizes = {r["label"]: r["count"] for r in held.where("label IN (0, 1)").groupBy("label").count().collect()}
    order = F.xxhash64("doc_id")
    drawn = None
    for value in (0, 1):
        part = held.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    drawn = stage(drawn, "label-sample")
    texts = (
        docs.select("doc_id", text_of(docs).alias("text"))
        .join(F.broadcast(drawn), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.max("text").alias("text"))
    )
    return texts, sizes


def class_weights(label: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give each class of the sample the share it has among all labels."""
    total = sum(sizes.values())
    weight = np.ones(len(label))
    for value, count in sizes.items():
        mine = label == value
        if mine.any():
            weight[mine] = len(label) * count / (total * mine.sum())
    return weight


def filter_texts(docs: DataFrame, work: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """Rows of ``docs``, with all columns, whose whole text passes.

    ``work`` is called once per task and gives a function from texts (null as empty) to
    booleans. Every row is judged by itself, so null or repeated ids do not matter.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = work()
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(low, _ROWS_AT_ONCE)
                passed = apply([t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(np.asarray(passed, bool)))

    return docs.mapInArrow(run, docs.schema)


_PAGE = 32768  # bits per row of a bitmap, as bitmap_construct_agg makes them


def bits_for(rows: int, most_bits: int) -> int:
    """Bits of a bitmap for ``rows`` keys: sixteen or more each, up to ``most_bits``."""
    return min(most_bits, max(_PAGE, 1 << (16 * max(rows, 1)).bit_length()))


def bitmap(keys: DataFrame, bits: int) -> DataFrame:
    """Bitmap of the hashed keys in ``key``, one row per page of 4 KB."""
    place = F.pmod("key", F.lit(bits))
    return keys.groupBy(F.bitmap_bucket_number(place).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("map")
    )


def with_bit(rows: DataFrame, key: Column, pages: DataFrame, bits: int, name: str) -> DataFrame:
    """Adds the boolean ``name``: whether the key's bit is set.

    The pages are broadcast; they are ``bits / 8`` bytes at most, whatever the data.
    """
    page = pages.select(F.col("page").alias(f"{name}_page"), F.col("map").alias(f"{name}_map"))
    bit = F.pmod(key, F.lit(bits))
    joined = rows.join(F.broadcast(page), F.bitmap_bucket_number(bit) == F.col(f"{name}_page"), "left")
    place = F.bitmap_bit_position(bit).cast("int")
    byte = F.substring(F.col(f"{name}_map"), F.shiftright(place, 3) + 1, F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    held = F.coalesce(F.getbit(number, place.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    return joined.withColumn(name, held).drop(f"{name}_page", f"{name}_map")


def text_digest(docs: DataFrame) -> Column:
    """SHA-256 of the text: with the id, what tells a row of ``docs`` from others."""
    return F.unhex(F.sha2(text_of(docs).cast("binary"), 256))


def keep_marked(docs: DataFrame, marked: DataFrame, most_bits: int = 1 << 26) -> DataFrame:
    """Rows of ``docs``, with all columns, that ``marked`` keeps.

    ``marked`` has doc_id, digest (``text_digest``) and kept for every row of ``docs``.
    Rows that repeat both id and text are one document, of which one row stays. A bitmap
    of the ids with something to drop is tested in the scan; only rows that it holds are
    joined, so the texts of all others are never shuffled.
    """
    pairs = marked.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    pairs = pairs.where("NOT kept OR n > 1").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("kept").alias("__kept")
    )
    pairs = stage(pairs, "decisions")
    bits = bits_for(pairs.count(), most_bits)
    key = F.xxhash64(docs["doc_id"])
    pages = stage(bitmap(pairs.select(F.xxhash64("__id").alias("key")), bits), "decided-ids")
    likely = with_bit(docs, key, pages, bits, "__likely")
    rest = likely.where("__likely").withColumn("__own", text_digest(likely))
    same = rest["doc_id"].eqNullSafe(pairs["__id"]) & (rest["__own"] == pairs["__digest"])
    met = rest.join(pairs, same, "left").where("__kept IS NULL OR __kept")
    once = met.where("__kept IS NULL").select(*docs.columns)
    twice = met.where("__kept").dropDuplicates(["__id", "__digest"]).select(*docs.columns)
    return likely.where("NOT __likely").select(*docs.columns).unionByName(once).unionByName(twice)
