"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

``build_graph`` links every distinct vector to ``degree`` near ones:

1. First links come from ``trees`` deals of the vectors by random hyperplanes through their mean,
   and one deal at random that keeps the graph connected. Within a deal's group, of about
   ``leaf`` vectors whatever the data (larger ones are dealt on by a hash), each vector takes
   its nearest.
2. NN-descent: every vector gathers a sample of its links, both ways, and those that met
   become candidates for each other: neighbours of neighbours, of which one link is new. A
   shuffle joins the members' vectors to the links, one row per vector compares its members,
   and only pairs that beat a member's worst link go on to the next shuffle. It ends when
   fewer than ``least`` of all links change.

Vectors travel as one byte a coordinate with a scale of their own, which is enough to order
links. ``nearest`` starts each query at its own vector's links and keeps its ``pool`` best
vectors; a round opens the ``opened`` best not yet opened, joins their links and the vectors at
their ends, and measures in double precision. It ends when no query has anything to open.
Queries go in blocks whose vectors fit ``_BLOCK_BYTES``; vectors and links are joined by
shuffle, never broadcast.

Equal vectors are one vector of the graph; each stands for its k + 1 smallest ids, which is all that
any result can hold of it, and queries join it by value. So groups of copies of any size
cost one node, and ties within them are exact.

Every step is written to the shared folder and earlier ones are deleted; shuffle files of
finished steps are given up too, so the disk holds about one step.

Defined results: vectors that are null or zero or hold null or non-finite components, null ids,
and vectors of another length than the commonest (of equals the longer) take no part; of
different vectors under one id the smaller, by component, counts; fewer than k candidates
give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardroll.llm.common import give_up_shuffles, share, stage, unstage

_BLOCK_BYTES = 16 << 20
_ROWS = 1024  # rows of members compared at a time
_PAIRS = 16384  # distances measured at a time


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _bytes(column: pa.Array) -> np.ndarray:
    """Binary values of equal length as the rows of a matrix."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(column), -1)


def encode(matrix: np.ndarray) -> np.ndarray:
    """One scale (eight bytes) and a signed byte per coordinate for every row."""
    scale = np.maximum(np.abs(matrix).max(axis=1), np.finfo(np.float64).tiny) / 127
    code = np.rint(matrix / scale[:, None]).astype(np.int8)
    return np.hstack([scale[:, None].view(np.uint8).reshape(len(matrix), 8), code.view(np.uint8)])


def decode(codes: np.ndarray) -> np.ndarray:
    scale = np.ascontiguousarray(codes[:, :8]).view(np.float64)
    return scale * codes[:, 8:].view(np.int8)


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``left`` to all of ``right``, for stacks of matrices."""
    products = left @ np.swapaxes(right, -1, -2)
    one, two = (left**2).sum(-1), (right**2).sum(-1)
    return np.maximum(one[..., :, None] + two[..., None, :] - 2 * products, 0)


def _pairs(v: np.ndarray, u: np.ndarray, d: np.ndarray, most: int) -> pa.RecordBatch:
    """Distinct links with at most ``most`` of each v, the nearest."""
    order = np.lexsort((u, d, v))
    v, u, d = v[order], u[order], d[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])
    v, u, d = v[fresh], u[fresh], d[fresh]
    starts = np.concatenate(([0], np.flatnonzero(v[1:] != v[:-1]) + 1)) if len(v) else np.empty(0, int)
    place = np.arange(len(v)) - np.repeat(starts, np.diff(np.append(starts, len(v))))
    keep = place < most
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (v, u, d)], names=["v", "u", "d"])


@dataclass(frozen=True)
class Shape:
    """How the graph is built."""

    degree: int = 24
    sample: int = 8
    trees: int = 4
    leaf: int = 512
    rounds: int = 12
    least: float = 0.02
    seed: int = 7


@dataclass
class Graph:
    """Distinct vectors (node, vector), the ids each stands for (node, vec_id) and links (node, near)."""

    nodes: DataFrame
    members: DataFrame
    links: DataFrame


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part, one per id."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("vector", lambda x: x != 0)
    sound = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .where("vec_id IS NOT NULL AND vector IS NOT NULL")
        .where(~bad)
        .where(~zero)
    )
    size = F.size("vector").alias("size")
    common = sound.groupBy(size).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    wanted = common[0]["size"] if common else 0
    return sound.where(F.size("vector") == wanted).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _distinct(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors under their smallest id, and the k + 1 smallest ids of each."""
    same = Window.partitionBy("vector").orderBy("vec_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = vectors.withColumn("place", F.row_number().over(same)).withColumn("node", F.first("vec_id").over(same))
    ranked = stage(ranked.where(F.col("place") <= k + 1), "vectors")
    return ranked.where("place = 1").select("node", "vector"), ranked.select("node", "vec_id")


def _coded(nodes: DataFrame, count: int, shape: Shape) -> DataFrame:
    """node, code and the group it has in every deal."""
    mean = nodes.select(F.posexplode("vector")).groupBy("pos").agg(F.avg("col").alias("m")).orderBy("pos").collect()
    centre = np.array([r["m"] for r in mean])
    depth = max(0, int(np.ceil(np.log2(count / shape.leaf))))
    planes = np.random.default_rng(shape.seed).normal(size=(shape.trees, len(centre), depth))
    shared = share(nodes, (centre, planes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, planes = shared()
        powers = 1 << np.arange(planes.shape[2])
        for batch in batches:
            if batch.num_rows:
                near = _matrix(batch.column(1)) - centre
                codes = [c.tobytes() for c in encode(near)]
                leaves = np.stack([((near @ p) > 0) @ powers for p in planes] + [np.zeros(len(near), int)], 1)
                columns = [batch.column(0), pa.array(codes, pa.binary()), pa.array(list(leaves), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "code", "leaves"])

    return stage(nodes.mapInArrow(run, "node long, code binary, leaves array<long>"), "codes")


def _dealt(coded: DataFrame, shape: Shape) -> DataFrame:
    """First links: each vector's nearest in each of its groups."""
    each = max(1, shape.degree // 3)
    rows = coded.select("node", "code", F.posexplode("leaves").alias("tree", "leaf"))
    large = rows.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shape.leaf)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / shape.leaf)
    part = F.pmod(F.xxhash64("node", "tree"), parts).alias("part")
    groups = (
        rows.join(large, ["tree", "leaf"], "left")
        .select("tree", "leaf", part, F.struct("node", "code").alias("member"))
        .groupBy("tree", "leaf", "part")
        .agg(F.collect_list("member").alias("members"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            ids, codes = flat.field(0).to_numpy(), _bytes(flat.field(1))
            for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                if end - start < 2:
                    continue
                own, places = ids[start:end], decode(codes[start:end])
                d = _squares(places, places)
                np.fill_diagonal(d, np.inf)
                most = min(each, len(own) - 1)
                near = np.argpartition(d, most - 1, axis=1)[:, :most]
                yield _pairs(
                    np.repeat(own, most), own[near.ravel()],
                    np.take_along_axis(d, near, 1).ravel(), most,
                )

    return groups.select("members").mapInArrow(run, "v long, u long, d double")


def _linked(pairs: DataFrame, shape: Shape, turn: int) -> DataFrame:
    """Links v to u, the ``degree`` nearest of each v, from pairs that may repeat.

    ``new`` tells links whose ends were not compared yet, ``fresh`` those that were not there
    before, ``pick`` the sample that takes part in the next comparison.
    """
    once = (
        pairs.repartition("v")
        .groupBy("v", "u")
        .agg(F.min("d").alias("d"), F.bool_and("new").alias("new"), F.bool_and("fresh").alias("fresh"))
    )
    nearest = Window.partitionBy("v").orderBy("d", "u")
    sampled = Window.partitionBy("v", "new").orderBy(F.xxhash64("v", "u", F.lit(turn)))
    best = once.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= shape.degree).drop("place")
    return best.withColumn("pick", F.row_number().over(sampled) <= shape.sample)


def _compared(links: DataFrame, coded: DataFrame, shape: Shape, turn: int) -> DataFrame:
    """Pairs of neighbours' neighbours that beat a worst link: v, u, d."""
    picked = links.where("pick")
    back = picked.select(F.col("u").alias("v"), F.col("v").alias("u"), "new")
    sampled = Window.partitionBy("v", "new").orderBy(F.xxhash64("v", "u", F.lit(turn)))
    back = back.withColumn("place", F.row_number().over(sampled)).where(F.col("place") <= shape.sample).drop("place")
    full = F.count(F.lit(1)) >= shape.degree
    worst = links.groupBy(F.col("v").alias("node")).agg(F.when(full, F.max("d")).alias("worst"))
    ends = coded.select("node", "code").join(worst, "node", "left")
    met = (
        picked.select("v", "u", "new")
        .unionByName(back)
        .join(ends, F.col("u") == F.col("node"))
        .groupBy("v")
        .agg(F.collect_list(F.struct("u", "new", "worst", "code")).alias("members"))
        .select("members")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                yield compare(batch.column(0).slice(low, _ROWS))

    def compare(lists: pa.ListArray) -> pa.RecordBatch:
        sizes, flat = lists.value_lengths().to_numpy(), lists.flatten()
        width, places = int(sizes.max()), decode(_bytes(flat.field(3)))
        row = np.repeat(np.arange(len(sizes)), sizes)
        column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = np.full((len(sizes), width), -1, np.int64)
        new, held = np.zeros(ids.shape, bool), np.zeros(ids.shape, bool)
        worst = np.zeros(ids.shape)
        points = np.zeros((*ids.shape, places.shape[1]))
        ids[row, column], held[row, column] = flat.field(0).to_numpy(), True
        new[row, column] = flat.field(1).to_numpy(zero_copy_only=False)
        worst[row, column] = flat.field(2).fill_null(float("inf")).to_numpy()
        points[row, column] = places
        d = _squares(points, points)
        good = held[:, :, None] & held[:, None, :] & (new[:, :, None] | new[:, None, :])
        good &= (ids[:, :, None] != ids[:, None, :]) & (d < worst[:, :, None])
        at, one, two = np.nonzero(good)
        return _pairs(ids[at, one], ids[at, two], d[at, one, two], shape.degree)

    return met.mapInArrow(run, "v long, u long, d double")


def build_graph(vectors: DataFrame, k: int = 10, shape: Shape = Shape()) -> Graph:
    """The neighbour graph of all vectors that take part; results of up to ``k`` can be asked."""
    spark = vectors.sparkSession
    sound = stage(usable(vectors), "usable")
    nodes, members = _distinct(sound, k)
    unstage(sound)
    count = nodes.count()
    if count < 2:
        return Graph(nodes, members, nodes.select("node", F.array().cast("array<long>").alias("near")).limit(0))
    coded = _coded(nodes, count, shape)
    first = _dealt(coded, shape).withColumns({"new": F.lit(True), "fresh": F.lit(True)})
    links = stage(_linked(first, shape, 0), "links")
    give_up_shuffles(spark)
    for turn in range(1, shape.rounds + 1):
        old = links.select("v", "u", "d", (F.col("new") & ~F.col("pick")).alias("new"), F.lit(False).alias("fresh"))
        found = _compared(links, coded, shape, turn).withColumns({"new": F.lit(True), "fresh": F.lit(True)})
        better = stage(_linked(old.unionByName(found), shape, turn), "links")
        unstage(links)
        links = better
        give_up_shuffles(spark)
        if links.where("fresh").count() < shape.least * shape.degree * count:
            break
    both = links.select("v", "u", "d").unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u"), "d"))
    nearest = Window.partitionBy("v").orderBy("d", "u")
    once = both.repartition("v").groupBy("v", "u").agg(F.min("d").alias("d"))
    kept = once.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= 3 * shape.degree)
    near = stage(kept.groupBy(F.col("v").alias("node")).agg(F.collect_list("u").alias("near")), "graph")
    unstage(links, coded)
    give_up_shuffles(spark)
    return Graph(nodes, members, near)


def _measured(asked: DataFrame, nodes: DataFrame, ids: np.ndarray, places: np.ndarray, worst: np.ndarray) -> DataFrame:
    """q, node and d of the asked nodes that can enter the queries' pools.

    ``asked`` has node and qs, the places in ``ids`` of the queries that meet it.
    """
    shared = share(nodes, (ids, places, worst))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, places, worst = shared()
        for batch in batches:
            if not batch.num_rows:
                continue
            own, queries = _matrix(batch.column(1)), batch.column(2)
            row = np.repeat(np.arange(len(own)), queries.value_lengths().to_numpy())
            query = queries.flatten().to_numpy()
            node = batch.column(0).to_numpy()
            for low in range(0, len(row), _PAIRS):
                r, q = row[low : low + _PAIRS], query[low : low + _PAIRS]
                d = np.sqrt(((own[r] - places[q]) ** 2).sum(axis=1))
                good = d <= worst[q]
                columns = [pa.array(ids[q[good]]), pa.array(node[r[good]]), pa.array(d[good])]
                yield pa.RecordBatch.from_arrays(columns, names=["q", "node", "d"])

    met = nodes.join(asked, "node").select("node", "vector", "qs")
    return met.mapInArrow(run, "q long, node long, d double")


def _searched(graph: Graph, block: DataFrame, pool: int, opened: int) -> DataFrame:
    """q, node and d: the ``pool`` best nodes found for each query node of a bounded block.

    ``block`` has node and vector.
    """
    spark = block.sparkSession
    table = block.select("node", "vector").toArrow()
    ids, places = table.column("node").to_numpy(), _matrix(table.column("vector").combine_chunks())
    ids, places = ids[order := np.argsort(ids)], places[order]
    numbers = spark.createDataFrame(pa.table({"q": ids, "number": np.arange(len(ids), dtype=np.int32)}))
    worst = np.full(len(ids), np.inf)
    here = block.select(F.col("node").alias("q"), "node", F.lit(0.0).alias("d"))
    best = stage(here.withColumns({"open": F.lit(False), "turn": F.lit(True)}), "pool")
    nearest = Window.partitionBy("q").orderBy("d", "node")
    waiting = Window.partitionBy("q", "open").orderBy("d", "node")
    while True:
        front = best.where("turn").join(numbers, "q").groupBy("node").agg(F.collect_list("number").alias("qs"))
        met = front.join(graph.links, "node").select(F.explode("near").alias("node"), "qs")
        asked = met.select("node", F.explode("qs").alias("q")).groupBy("node").agg(F.collect_set("q").alias("qs"))
        found = _measured(asked, graph.nodes, ids, places, worst).withColumn("open", F.lit(True))
        merged = (
            best.select("q", "node", "d", "open")
            .unionByName(found)
            .repartition("q")
            .groupBy("q", "node")
            .agg(F.min("d").alias("d"), F.bool_and("open").alias("open"))
            .withColumn("place", F.row_number().over(nearest))
            .where(F.col("place") <= pool)
            .withColumn("turn", F.col("open") & (F.row_number().over(waiting) <= opened))
        )
        # What takes its turn counts as opened from now on.
        merged = merged.select("q", "node", "d", (F.col("open") & ~F.col("turn")).alias("open"), "turn")
        later = stage(merged, "pool")
        unstage(best)
        best = later
        state = best.groupBy("q").agg(
            F.when(F.count(F.lit(1)) >= pool, F.max("d")).alias("worst"), F.bool_or("turn").alias("more")
        ).toArrow()
        give_up_shuffles(spark)
        at = np.searchsorted(ids, state.column("q").to_numpy())
        worst[at] = state.column("worst").fill_null(float("inf")).to_numpy()
        if not state.num_rows or not any(state.column("more").to_pylist()):
            return best.select("q", "node", "d")


def nearest(graph: Graph, vectors: DataFrame, wanted: Column, k: int = 10, pool: int = 800, opened: int = 128) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of every ``wanted`` row.

    ``vectors`` is what the graph was built from, and ``wanted`` a condition on vec_id.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).where(wanted).select(F.col("vec_id").alias("query_id"), "vector")
    asked = stage(rows.join(graph.nodes, "vector").select("query_id", "node", "vector"), "asked")
    starts = asked.groupBy("node").agg(F.first("vector").alias("vector"))
    starts = stage(starts, "starts")
    count = starts.count()
    found = starts.select(F.col("node").alias("q"), "node", F.lit(0.0).alias("d")).limit(0)
    if count:
        size = starts.select(F.size("vector")).first()[0]
        blocks = -(-count * size * 8 // _BLOCK_BYTES)
        own = F.pmod(F.xxhash64("node"), F.lit(blocks))
        for number in range(blocks):
            block = starts.where(own == number)
            if not block.isEmpty():
                found = found.unionByName(_searched(graph, block, pool, opened))
    nearby = Window.partitionBy("q").orderBy("d", "node")
    # One more than k: the query's own vector is among them.
    top = found.withColumn("place", F.row_number().over(nearby)).where(F.col("place") <= k + 1).drop("place")
    listed = top.join(graph.members, "node").select(F.col("q").alias("node"), "vec_id", "d")
    met = asked.select("query_id", "node").join(listed, "node").where("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy("d", "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    result = stage(ranked.select("query_id", "rank", "vec_id", F.col("d").alias("score")), "nearest")
    give_up_shuffles(spark)
    return result
