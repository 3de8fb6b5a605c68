"""Ranked lexical search over a K2-treap of the term-document grid.

``build_index`` cuts the documents into segments of bounded size. A segment is a square grid with a row per term
and a column per document, cut into quarters again and again. Only cells that hold
something are stored, level by level: which of its four quarters hold something (a bit each, so that
a running count of bits leads to the children) and the greatest impact in the cell, rounded up to a
multiple of ``_STEP``. The last level holds each term's occurrences in the document, from which the
exact impact follows. Frequent terms come first among the rows, and documents that share
their commonest term lie side by side, so that whole ranges lack an item's terms.

``search`` takes every item through every segment. A node is a range of documents with, for
each term of the item, the cell of that term's row path; the sum of weight times the cells'
maxima bounds the score of any document in it. The nodes of greatest bound are halved first, a batch
at a time and for all terms at once, until no node's bound reaches the item's k-th best score. That
score carries over to the task's next segments. Nodes that only tie with it are still
opened, because a smaller id wins a tie, so the result is exact.

With N documents that hold a term, L terms in all, n terms in a document, df documents that hold
a term and tf its occurrences there: m = 10 + (90 n N) div L, impact = (10^9 tf) div
(1000 tf + 8 m), weight = floor(1000 ln((2 N + 2) / (2 df + 1))), score = sum of weight * impact.

At scale: texts are read twice (N and L, then the index) and not shuffled; a segment is built and
searched in one task's memory, segments are written, read and sent to Python a few at a time; weights join the index's term counts to the items' terms by shuffle.
Items go to the tasks in blocks of about ``block`` items, and each block reads the index once. Each
task returns at most k rows an item.

Defined results: terms are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z
lower-cased; a null or empty text has none and is neither found nor counted; the texts of
rows that share an item id count as one text; an item without a term found has no rows; repeated
documents each take a rank; null document ids come last among ties.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from boardroll.llm.common import map_texts, share, small_batches, stage

_STEP = 16  # impacts are under 10^6, so a rounded maximum fits 16 bits
_BITS = np.array([bin(k).count("1") for k in range(16)], np.int64)
_LAST = np.iinfo(np.int64).max
# A segment's row has MBs; by default a task would gather 128 MB of them to write, and decode as much at once to read.
_ROW_GROUPS = {"parquet.block.size": 8 << 20, "parquet.block.row.count.limit": 8, "parquet.page.size.row.check.min": 1}


def _is_term(code: int) -> bool:
    return code >= 0x80 or chr(code).isalnum()


_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if _is_term(c) else 32 for c in range(256))

SEGMENT = StructType(
    [
        StructField("doc_ids", ArrayType(LongType())),
        StructField("lengths", ArrayType(LongType())),  # m of each document
        StructField("terms", ArrayType(BinaryType())),
        StructField("counts", ArrayType(LongType())),  # documents of the segment per term
        StructField("quarters", ArrayType(BinaryType())),  # per level, a byte a cell
        StructField("maxima", ArrayType(BinaryType())),  # per level, 16 bits a cell
        StructField("occurrences", BinaryType()),  # 32 bits per cell of the last level
    ]
)
_ARROW = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())),
        ("quarters", pa.list_(pa.binary())), ("maxima", pa.list_(pa.binary())),
        ("occurrences", pa.binary()),
    ]
)


def terms_of(text: str) -> list[bytes]:
    """The text's terms in order, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_TERMS).split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count adds to a score, before the term's weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _spread(numbers: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers moved to the even places."""
    x = numbers.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


@dataclass
class Treap:
    """One segment's cells, level by level from the whole grid down to single entries."""

    quarters: list[np.ndarray]
    maxima: list[np.ndarray]
    occurrences: np.ndarray

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, tf: np.ndarray, impact: np.ndarray) -> Treap:
        depth = max(1, int(rows.max()).bit_length(), int(columns.max()).bit_length())
        codes = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(codes)
        codes, peak = codes[order], -(-impact[order] // _STEP)
        quarters, maxima = [], []
        for _ in range(depth):
            parents = codes >> np.uint64(2)
            starts = np.concatenate(([0], np.flatnonzero(parents[1:] != parents[:-1]) + 1))
            quarter = (np.uint8(1) << (codes & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
            quarters.append(np.bitwise_or.reduceat(quarter, starts))
            peak = np.maximum.reduceat(peak, starts)
            maxima.append(peak.astype(np.uint16))
            codes = parents[starts]
        return cls(quarters[::-1], maxima[::-1], tf[order].astype(np.uint32))

    def children(self, level: int) -> np.ndarray:
        """Where the children of each cell of a level start in the next."""
        held = _BITS[self.quarters[level]]
        return np.cumsum(held) - held


class _Builder:
    """Collects documents and turns them into a segment's row."""

    def __init__(self, n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.leading: list[int] = []
        self.rows: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []
        self.cells = 0

    def add(self, doc_id: int | None, terms: list[bytes]) -> None:
        held, known = Counter(terms), self.known
        rows = np.fromiter((known.setdefault(t, len(known)) for t in held), np.int64, len(held))
        self.ids.append(doc_id)
        self.sizes.append(len(terms))
        self.leading.append(known[max(held, key=held.__getitem__)])
        self.rows.append(rows)
        self.tfs.append(np.fromiter(held.values(), np.int64, len(held)))
        self.cells += len(held)

    def segment(self) -> pa.RecordBatch:
        sizes = np.array(self.sizes, np.int64)
        m = 10 + (90 * sizes * self.n_docs) // self.n_terms
        order = np.lexsort((sizes, self.leading))
        column = np.empty(len(order), np.int64)
        column[order] = np.arange(len(order))
        columns = np.repeat(column, [len(r) for r in self.rows])
        rows, tf = np.concatenate(self.rows), np.concatenate(self.tfs)
        counts = np.bincount(rows, minlength=len(self.known))
        by_count = np.argsort(-counts, kind="stable")
        place = np.empty(len(by_count), np.int64)
        place[by_count] = np.arange(len(by_count))
        treap = Treap.build(place[rows], columns, tf, impacts(tf, m[order][columns]))
        terms = pa.array(list(self.known), pa.binary()).take(pa.array(by_count))
        row = {
            "doc_ids": [self.ids[k] for k in order.tolist()], "lengths": m[order], "terms": terms,
            "counts": counts[by_count], "quarters": [q.tobytes() for q in treap.quarters],
            "maxima": [p.tobytes() for p in treap.maxima], "occurrences": treap.occurrences.tobytes(),
        }
        self.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([row[f.name]], f.type) for f in _ARROW], schema=_ARROW
        )


@dataclass
class Index:
    """The staged segments, and what scores need to know of all documents."""

    segments: DataFrame
    n_docs: int
    n_terms: int


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents that hold a term, and all their terms with repeats."""

    def work():
        return lambda texts: [pa.array([len(terms_of(t)) for t in texts], pa.int64())]

    sizes = map_texts(docs, work, [StructField("n", LongType())])
    found = sizes.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    return found["docs"], found["terms"]


def build_index(docs: DataFrame, segment_docs: int = 2048, segment_cells: int = 250_000) -> Index:
    """Index every row of ``docs`` (doc_id, text); a segment ends at either bound."""
    with small_batches(docs.sparkSession):
        return _built(docs, segment_docs, segment_cells)


def _built(docs: DataFrame, segment_docs: int, segment_cells: int) -> Index:
    n_docs, n_terms = corpus_size(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = _Builder(n_docs, n_terms)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                terms = terms_of(text.as_py() or "")
                if terms:
                    builder.add(doc_id, terms)
                if len(builder.ids) >= segment_docs or builder.cells >= segment_cells:
                    yield builder.segment()
        if builder.ids:
            yield builder.segment()

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return Index(stage(columns.mapInArrow(run, SEGMENT), "treaps", **_ROW_GROUPS), n_docs, n_terms)


def weighted_terms(index: Index, items: DataFrame) -> DataFrame:
    """Each item's distinct terms that some document holds: item_id, term and weight."""

    def work():
        return lambda texts: [pa.array([list({*terms_of(t)}) for t in texts], pa.list_(pa.binary()))]

    terms = map_texts(items, work, [StructField("terms", ArrayType(BinaryType()))], ("item_id",))
    asked = stage(terms.select("item_id", F.explode("terms").alias("term")).distinct(), "item-terms")
    counted = (
        index.segments.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
        .select(F.col("t.terms").alias("term"), F.col("t.counts").alias("n"))
        .join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("n").alias("df"))
    )
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.n_docs + 2) / (2 * F.col("df") + 1)))
    weighed = counted.select("term", weight.cast("long").alias("weight")).where("weight > 0")
    return asked.join(weighed, "term").select("item_id", "term", "weight")


class _Segment:
    """A segment's row, opened for searching."""

    def __init__(self, row: dict[str, pa.Scalar]) -> None:
        self.terms = row["terms"].values
        ids = row["doc_ids"].values
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(_LAST).to_numpy()
        self.m = row["lengths"].values.to_numpy()
        read = [(name, kind) for name, kind in (("quarters", np.uint8), ("maxima", np.uint16))]
        levels = [[np.frombuffer(x.as_buffer(), kind) for x in row[name].values] for name, kind in read]
        self.treap = Treap(*levels, np.frombuffer(row["occurrences"].as_buffer(), np.uint32))
        self.first = [self.treap.children(k) for k in range(len(self.treap.quarters))]

    def rows_of(self, terms: pa.Array) -> np.ndarray:
        """Grid rows of the terms; -1 for those that the segment lacks."""
        return pc.index_in(terms, value_set=self.terms).fill_null(-1).to_numpy()


class Best:
    """The best documents found so far for one item."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.known = np.empty(0, bool)

    @property
    def least(self) -> int:
        """Score below which a document cannot enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores = np.concatenate((self.scores, scores))
        ids, known = np.concatenate((self.ids, ids)), np.concatenate((self.known, known))
        best = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[best], ids[best], known[best]


def descend(segment: _Segment, rows: np.ndarray, weights: np.ndarray, best: Best, entries: int = 16384) -> None:
    """Offer ``best`` all documents of the segment that can enter it, best ranges first.

    A batch takes as many nodes as hold about ``entries`` cells.
    """
    treap, depth = segment.treap, len(segment.treap.quarters)
    if not len(rows):
        return
    root = np.zeros((1, len(rows)), np.int64)
    bound = _STEP * int(treap.maxima[0][0]) * weights.sum()
    # Entries: greatest bound, order of arrival, level, bounds, columns, cells, terms.
    heap = [(-bound, 0, 0, np.array([bound]), np.zeros(1, np.int64), root, np.arange(len(rows)))]
    arrived = 0
    while heap:
        top, _, level, bounds, columns, cells, own = heapq.heappop(heap)
        if -top < best.least:
            return
        batch = max(1, entries // len(own))
        if len(bounds) > batch:
            order = np.argsort(-bounds, kind="stable")
            order = order[bounds[order] >= best.least]
            take, rest = order[:batch], order[batch:]
            if len(rest):
                arrived += 1
                later = (bounds[rest], columns[rest], cells[rest], own)
                heapq.heappush(heap, (-int(bounds[rest[0]]), arrived, level, *later))
            columns, cells = columns[take], cells[take]
        held = cells >= 0
        quarters = np.where(held, treap.quarters[level][cells], 0)
        start = segment.first[level][cells]
        lower = 2 * ((rows[own] >> (depth - 1 - level)) & 1)
        halves = []
        for side in (0, 1):
            place = lower + side
            inside = (quarters >> place) & 1 == 1
            halves.append(np.where(inside, start + _BITS[quarters & ((1 << place) - 1)], -1))
        cells = np.concatenate(halves)
        columns = np.concatenate((2 * columns, 2 * columns + 1))
        some = (cells >= 0).any(axis=1)
        cells, columns = cells[some], columns[some]
        if not len(cells):
            continue
        held = cells >= 0
        if level + 1 == depth:
            tf = np.where(held, treap.occurrences[cells], 0).astype(np.int64)
            scores = impacts(tf, segment.m[columns][:, None]) @ weights[own]
            good = np.flatnonzero(scores >= best.least)
            found = columns[good]
            best.offer(scores[good], segment.ids[found], segment.known[found])
            continue
        peaks = np.where(held, treap.maxima[level + 1][cells], 0).astype(np.int64)
        bounds = _STEP * (peaks @ weights[own])
        good = bounds >= best.least
        if good.any():
            bounds, columns, cells = bounds[good], columns[good], cells[good]
            present = (cells >= 0).any(axis=0)
            arrived += 1
            entry = (bounds, columns, cells[:, present], own[present])
            heapq.heappush(heap, (-int(bounds.max()), arrived, level + 1, *entry))


def _block_search(segments: DataFrame, block: dict[object, list[tuple[bytes, int]]], k: int, item: StructField) -> DataFrame:
    """item_id, doc_id and score of each task's best documents for a block of items."""
    terms = sorted({t for listed in block.values() for t, _ in listed})
    at = {t: n for n, t in enumerate(terms)}
    plan = [
        (key, np.array([at[t] for t, _ in listed]), np.array([w for _, w in listed], np.int64))
        for key, listed in block.items()
    ]
    shared = share(segments, (terms, plan))
    schema = StructType([StructField("item_id", item.dataType), StructField("doc_id", LongType()), StructField("score", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, plan = shared()
        asked, best = pa.array(terms, pa.binary()), [Best(k) for _ in plan]
        for batch in batches:
            for n in range(batch.num_rows):
                segment = _Segment({f.name: batch.column(f.name)[n] for f in _ARROW if f.name != "counts"})
                rows = segment.rows_of(asked)
                for (_, places, weights), found in zip(plan, best, strict=True):
                    here = rows[places] >= 0
                    descend(segment, rows[places][here], weights[here], found)
        keys = [key for (key, _, _), found in zip(plan, best, strict=True) for _ in found.ids]
        ids = np.concatenate([b.ids for b in best])
        unknown = ~np.concatenate([b.known for b in best])
        scores = np.concatenate([b.scores for b in best])
        columns = [pa.array(keys, asked_type), pa.array(ids, mask=unknown), pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    asked_type = pa.int64() if item.dataType == LongType() else None
    return segments.drop("counts").mapInArrow(run, schema)


def search(index: Index, items: DataFrame, k: int = 10, block: int = 512) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents, score above 0.

    ``items`` has item_id and text.
    """
    with small_batches(items.sparkSession):
        return _ranked(index, items, k, block)


def _ranked(index: Index, items: DataFrame, k: int, block: int) -> DataFrame:
    weighed = stage(weighted_terms(index, items), "weighted-terms")
    blocks = max(1, -(-weighed.select("item_id").distinct().count() // block))
    own = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = None
    for number in range(blocks):
        asked: dict[object, list[tuple[bytes, int]]] = {}
        for row in weighed.where(own == number).sort("item_id", "term").toLocalIterator():
            asked.setdefault(row["item_id"], []).append((bytes(row["term"]), row["weight"]))
        if asked:
            part = stage(_block_search(index.segments, asked, k, items.schema["item_id"]), "found")
            found = part if found is None else found.unionByName(part)
    if found is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return items.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
