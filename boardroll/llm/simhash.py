"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint's 64 bits are cut into six blocks. Two fingerprints that differ in at most
three bits agree on at least three whole blocks, so both appear under at least one of the
20 choices of three blocks. Distinct fingerprints are joined on (choice, the bits of those
blocks), about 32 bits, and every candidate is verified by its Hamming distance.

A block group is searched inside one task by growing trees: from a fingerprint to all not
yet reached ones within the distance. This gives one link per fingerprint reached, never
all pairs, and leaves connectivity exact. The members of a group of over ``chunk``
fingerprints are blocked again, by the same argument on the bits they do not share by
force: those are cut into six blocks, of which close pairs agree on three. Each step halves the free
bits, so that after three steps a group has 2^8 members at most; the rows it takes are a
fixed multiple of the members, however many they are. Copies share a fingerprint and take
part once.

Components come from alternating large-star and small-star steps over the links; each
step writes its tables to the shared folder, which cuts the lineage.

Defined results: a null text is empty; a text without words has fingerprint zero and links
like any other; a null id gets its row's component but is nobody's component id (null if
all its members have null ids); repeated rows get the same row twice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from boardroll.llm.common import keep_marked, map_texts, stage, text_digest

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WHITE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
SEED = 42


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of one text, unsigned.

    Lower-cases A-Z, takes words between white space (space, tab to carriage return) and
    hashes each run of ``shingle`` words with XXH64 (seed 42). A bit is set if more than
    half of the hashes set it. A shorter text is one shingle; without words it is zero.
    """
    words = text.encode("utf-8", "replace").translate(_LOWER).translate(_WHITE).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    count = len(starts)
    parts = map(joined.__getitem__, map(slice, starts, stops))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 65536):
        bits = np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys`` and fp, the fingerprint's bits as a signed long, for every row."""

    def work():
        def apply(texts: list[str]) -> list[pa.Array]:
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            return [pa.array(found.view(np.int64))]

        return apply

    return map_texts(docs, work, [StructField("fp", LongType())], keys)


def _choices(free: int, blocks: int, bits: int) -> list[int]:
    """Masks of every choice of ``blocks - bits`` out of ``blocks`` near equal blocks of the free bits."""
    places = [b for b in range(64) if free >> b & 1]
    edges = [len(places) * k // blocks for k in range(blocks + 1)]
    own = [sum(1 << b for b in places[edges[k] : edges[k + 1]]) for k in range(blocks)]
    return [sum(choice) for choice in combinations(own, blocks - bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _trees(group: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within ``bits`` of each other."""
    left = np.arange(len(group))
    links: list[tuple[int, int]] = []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(group[left] ^ group[at]) <= bits
            links += [(at, k) for k in left[near].tolist()]
            todo += left[near].tolist()
            left = left[~near]
    return links


def _search(bits: int):
    """Links within each run of rows of equal group in a partition sorted by group."""

    def links(run: pd.DataFrame) -> pd.DataFrame:
        fp = run["fp"].to_numpy().view(np.uint64)
        keys = run[["mask", "held"]].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts = np.concatenate(([0], cuts))
        sizes = np.diff(np.concatenate((starts, [len(fp)])))
        two = starts[sizes == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= bits]
        a, b = [fp[two]], [fp[two + 1]]
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            group = fp[start : start + size]
            found = np.array(_trees(group, bits), np.int64).reshape(-1, 2)
            a.append(group[found[:, 0]])
            b.append(group[found[:, 1]])
        out = pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})
        return out.drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[["mask", "held"]].to_numpy()
            same = (keys == keys[-1]).all(axis=1)
            last = len(batch) - int(np.argmin(same[::-1])) if not same.all() else 0
            if last:
                yield links(pd.concat([*rest, batch.iloc[:last]], ignore_index=True))
                rest = [batch.iloc[last:]]
            elif rest and (rest[-1][["mask", "held"]].to_numpy()[-1] != keys[0]).any():
                yield links(pd.concat(rest, ignore_index=True))
                rest = [batch]
            else:
                rest.append(batch)
        if rest:
            yield links(pd.concat(rest, ignore_index=True))

    return run


_SMALL = 8  # free bits of which a group is searched whatever its size


def block_groups(distinct: DataFrame, bits: int = 3, blocks: int = 6, chunk: int = 1024) -> DataFrame:
    """Rows (mask, held, fp) in groups of at most ``chunk``: equal bits ``held`` under ``mask``.

    Any two of the distinct ``fp`` within ``bits`` of each other share a group. Groups of one
    are left out.
    """
    spark, everything = distinct.sparkSession, (1 << 64) - 1
    masks = _choices(everything, blocks, bits)
    listed = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    keyed, found = distinct.select("fp", F.explode(listed).alias("mask")), None
    while True:
        keyed = keyed.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("held"))
        sizes = keyed.groupBy("mask", "held").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sizes = stage(sizes, "block-sizes")
        fits = (F.col("n") <= chunk) | (F.bit_count("mask") >= 64 - _SMALL)
        met = keyed.join(sizes.where(fits).select("mask", "held"), ["mask", "held"])
        found = met if found is None else found.unionByName(met)
        hot = sizes.where(~fits)
        # At most 20, then 400 masks: those of one step times the choices of the next.
        held = [r["mask"] for r in hot.select("mask").distinct().collect()]
        if not held:
            return found
        finer = [(m, [_signed(m & everything | c) for c in _choices(~m & everything, blocks, bits)]) for m in held]
        finer = F.broadcast(spark.createDataFrame(finer, "mask long, masks array<long>"))
        large = keyed.join(hot.select("mask", "held"), ["mask", "held"]).join(finer, "mask")
        keyed = stage(large.select("fp", F.explode("masks").alias("mask")).distinct(), "hot-blocks")


def block_links(distinct: DataFrame, bits: int = 3, blocks: int = 6, chunk: int = 1024) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``bits``, given distinct ``fp``.

    Every returned pair is within the distance, and the graph of the returned links has
    the same components as the graph of all such pairs.
    """
    group = ["mask", "held"]
    return (
        block_groups(distinct, bits, blocks, chunk)
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInPandas(_search(bits), "a long, b long")
    )


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every linked node: node, root.

    ``links`` are pairs (a, b) of longs. Large-star hooks a node's larger neighbours to
    its smallest one, small-star the smaller ones; the pair of steps is repeated until it
    changes nothing, which takes about the logarithm of the longest path. The minima are
    written before they are joined, so that both sides of the join are plain shuffles in
    which a node with very many links is split.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = stage(links.select(high.alias("u"), low.alias("v")).where("u != v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "star")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(large.where("u != v").distinct(), "links")
        least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _classes(marked: DataFrame, bits: int) -> DataFrame:
    """fp, root (one fingerprint per component) and component_id of every fingerprint."""
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(block_links(distinct.select("fp"), bits))
    linked = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    linked = stage(linked, "linked")
    named = stage(linked.groupBy("root").agg(F.min("first_id").alias("component_id")), "named")
    return stage(linked.join(named, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row."""
    marked = stage(fingerprints(docs, shingle), "fingerprints")
    classes = _classes(marked, bits)
    return marked.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """One row of ``docs`` per root, with all columns: that of the smallest id.

    ``rooted`` has root, doc_id and digest of every row. Among rows that share that id the
    one of the smallest text digest stays; a null id stays only where its component has no
    other.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "digest")).alias("first")
    first = stage(rooted.groupBy("root").agg(first), "first")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    decided = rooted.join(first, "root").select("doc_id", "digest", kept.alias("kept"))
    return keep_marked(docs, decided)


def without_near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3) -> DataFrame:
    """One row of ``docs`` per component, with all columns, as ``keep_first`` chooses it."""
    marked = docs.select("doc_id", "text").withColumn("digest", text_digest(docs))
    marked = stage(fingerprints(marked, shingle, ("doc_id", "digest")), "fingerprints")
    rooted = stage(marked.join(_classes(marked, bits), "fp").select("root", "doc_id", "digest"), "rooted")
    return keep_first(docs, rooted)
