"""Best-fit packing of documents into sequences of several permitted lengths.

A document's length comes from a column expression (words by default). What exceeds the
longest permitted length is cut off in full sequences, which need no packing; one rest per
document remains. Rests are dealt by a hash into blocks of about ``block_rows``, and each
block is packed by itself, so a task holds ids and lengths of one block only, whatever the
size of the corpus.

Within a block, rests are placed from long to short, each into the open bin that it fills
best. If none has room, the permitted length is opened that costs least per word it can be
expected to hold: the lengths are tried jointly on the rests still to come, taking the
longest that fits again and again. When all are placed, each bin is downsized to the
cheapest permitted length that holds its contents.

Defined results: a null text is empty; an empty document has length ``separator`` like an
empty line in a sequence, so it is packed too; a null id is kept; rows that repeat an id are
packed one by one. Nothing is dropped or cut short.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardroll.llm.common import text_of

COSTS = {512: 512 * 1.03, 1024: 1024 * 1.06, 2048: 2048 * 1.13, 4096: 4096 * 1.25, 8192: 8192 * 1.5}
"""Permitted sequence lengths and what one sequence costs: attention makes long ones dearer."""


def word_count(text: Column) -> Column:
    """Words between white space (space, tab to carriage return)."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")))


_PLACED = ("n_units", "piece", "piece_start", "piece_length", "block", "number", "bin_start", "capacity")


class _Rests:
    """Lengths still to be placed, with counts; finds the longest one that fits."""

    def __init__(self, lengths: np.ndarray):
        values, counts = np.unique(lengths, return_counts=True)
        self.values, self.counts = values.tolist(), dict(zip(values.tolist(), counts.tolist(), strict=True))

    def take(self, length: int) -> None:
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length]
            self.values.pop(bisect_left(self.values, length))

    def expected(self, room: int) -> int:
        """What a bin with ``room`` would hold if the longest fitting rests went in."""
        held, last, used = 0, len(self.values), 0
        while room and last:
            at = bisect_left(self.values, room + 1, 0, last) - 1
            if at < 0:
                break
            length = self.values[at]
            n = min(self.counts[length], room // length)
            held, room, last = held + n * length, room - n * length, at
            used += 1
            if used == 8:  # a forecast; what is left open then is small
                break
        return held


def pack_block(lengths: np.ndarray, costs: Mapping[int, float] = COSTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and start of every length (given long to short), and each bin's capacity.

    Lengths are at least 1 and at most the largest permitted length.
    """
    sizes = sorted(costs)
    rests = _Rests(lengths)
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    bins_with: dict[int, list[int]] = {}
    opened: list[int] = []
    filled: list[int] = []
    numbers, starts = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, length in enumerate(lengths.tolist()):
        rests.take(length)
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            number = bins_with[room].pop()
            if not bins_with[room]:
                del bins_with[room]
                rooms.pop(at)
        else:
            number = len(opened)
            room = min(
                (s for s in sizes if s >= length),
                key=lambda s: (costs[s] / (length + rests.expected(s - length)), s),
            )
            opened.append(room)
            filled.append(0)
        numbers[k], starts[k] = number, filled[number]
        filled[number] += length
        room -= length
        if room:
            if room not in bins_with:
                insort(rooms, room)
                bins_with[room] = []
            bins_with[room].append(number)
    used = np.array(filled, np.int64)
    down = {}
    for need in np.unique(used).tolist():
        down[need] = min((s for s in sizes if s >= need), key=lambda s: (costs[s], s))
    return numbers, starts, np.array([down[u] for u in used.tolist()], np.int64)


def pack(
    docs: DataFrame, costs: Mapping[int, float] = COSTS, length: Column | None = None,
    separator: int = 1, block_rows: int = 20000,
) -> DataFrame:
    """One row per piece of a document, placed in a sequence.

    doc_id, n_units (the document's length with its separator), piece (0, 1, ...), piece_start
    and piece_length within the document, bin_id, bin_start within the sequence, capacity.
    """
    longest = max(costs)
    own = word_count(text_of(docs)) if length is None else length
    blocks = max(1, -(-docs.count() // block_rows))
    units = docs.select("doc_id", (own + separator).cast("long").alias("n_units"))
    # Ids are near unique; the row's number keeps null or repeated ones from sharing a block.
    spread = F.xxhash64("doc_id", "n_units", F.monotonically_increasing_id())
    units = units.withColumn("spread", spread).withColumn("block", F.pmod("spread", F.lit(blocks)))
    costs = dict(costs)

    def packed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        n_units = rows.column("n_units").to_numpy()
        rest = (n_units - 1) % longest + 1
        order = np.lexsort((rows.column("spread").to_numpy(), -rest))
        rows, n_units, rest = rows.take(pa.array(order)), n_units[order], rest[order]
        ids, block = rows.column("doc_id").combine_chunks(), rows.column("block").to_numpy()
        numbers, starts, capacity = pack_block(rest, costs)
        full = (n_units - rest) // longest
        lower = np.cumsum(full) - full
        each = np.arange(len(rest))
        yield batch(ids, n_units, block, each, full, full * longest, rest, numbers, starts, capacity[numbers])
        at = np.repeat(each, full)
        for low in range(0, len(at), 50_000):  # full sequences of very long documents
            part = at[low : low + 50_000]
            piece = np.arange(low, low + len(part)) - lower[part]
            whole = np.full(len(part), longest)
            number = len(capacity) + np.arange(low, low + len(part))
            yield batch(ids, n_units, block, part, piece, piece * longest, whole, number, 0 * whole, whole)

    def batch(ids, n_units, block, at, *columns) -> pa.RecordBatch:
        values = [n_units[at], *columns[:3], block[at], *columns[3:]]
        arrays = [ids.take(pa.array(at)), *(pa.array(v.astype(np.int64)) for v in values)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *_PLACED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for given in batches:
            if not given.num_rows:
                continue
            block = given.column(given.schema.get_field_index("block")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if held and held[-1].column(3)[0].as_py() != block[low]:
                    yield from packed(pa.Table.from_batches(held))
                    held = []
                held.append(given.slice(low, high - low))
        if held:
            yield from packed(pa.Table.from_batches(held))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{name} long" for name in _PLACED)
    ordered = units.repartition(blocks, "block").sortWithinPartitions("block")
    placed = ordered.mapInArrow(run, schema)
    bin_id = F.col("block") * F.lit(1 << 40) + F.col("number")
    return placed.select(
        "doc_id", "n_units", "piece", "piece_start", "piece_length", bin_id.alias("bin_id"), "bin_start", "capacity"
    )
