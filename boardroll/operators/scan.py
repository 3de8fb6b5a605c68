"""Ordered scans (running sum, previous value, forward fill) that survive hot keys.

A plain window puts all rows of a key in one task. Here a key with more than its share of the
rows is cut where a sample's quantiles of (key, order) lie, whatever columns make up the order and
however its values are spread. Every piece is a window group of its own, and what
flows into it is carried in:

1. A sample of bounded size gives the splitters. Keys that are not hot are never cut; without
   hot keys a plain window follows.
2. One small aggregate per piece of a hot key, over the key, order and value columns of just
   those keys, is summed up (or the last value taken) along the pieces. There are at most a
   few per shuffle partition, so they enter the plan as one array, not as a join.
3. Rows are shuffled once by (key, piece); a row's result is that of its piece's window combined
   with what was carried in.

The input is read for the sample, for the hot keys' aggregate if there are any, and for the rows; the
first two read few columns. Save it first if it is costly to compute.

``chunk_rows`` is the size of a piece for inputs that the sample holds whole; larger ones are
cut into about two pieces a shuffle partition. ``chunk_rows=None`` takes one window per key;
use that only where the operator before bounds a key's rows, as a calendar does. ``order``
must not tie, or the result is as undefined as that of a plain window. Keys and order are
of atomic types; nulls come first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 200_000
_SAMPLE = 4096
_PER_PIECE = 16  # sample rows that a piece is cut from, at least


def _text(column: str, kind: T.DataType) -> Column:
    """The value as text that ``_literal`` reads back exactly."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if not isinstance(kind, T.AtomicType):
        raise TypeError(f"cannot cut keys along {column}, a {kind.simpleString()}")
    return F.col(column).cast("string")


def _literal(text: str | None, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(text).cast("long"))
    return F.unhex(F.lit(text)) if isinstance(kind, T.BinaryType) else F.lit(text).cast(kind)


class Cuts:
    """Where the hot keys of an input are cut."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int) -> None:
        self.keys, self.columns = list(keys), [*keys, *order]
        self._kinds = [df.schema[c].dataType for c in self.columns]
        pieces = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        size = max(_SAMPLE, _PER_PIECE * pieces)
        sample = (
            df.select(*self.columns)
            .orderBy(F.xxhash64(*self.columns))
            .limit(size)
            .sort(*self.columns)
            .select(*[_text(c, k).alias(c) for c, k in zip(self.columns, self._kinds, strict=True)])
            .collect()
        )
        step = chunk_rows if len(sample) < size else size // pieces
        found: dict[tuple, None] = {}  # in order, without repeats
        for _, rows in groupby(sample, key=lambda row: row[: len(self.keys)]):
            own = list(rows)
            n = len(own) // step
            found |= {tuple(own[part * len(own) // n]): None for part in range(1, n)}
        self.splitters = list(found)

    def _tuple(self, values: Sequence[Column], columns: Sequence[str]) -> Column:
        return F.struct(*[v.alias(c) for v, c in zip(values, columns, strict=True)])

    def _array(self, columns: Sequence[str]) -> Column:
        """The splitters' values of the columns, as a literal."""
        kinds = self._kinds[: len(columns)]
        return F.array(
            *[self._tuple([_literal(t, k) for t, k in zip(s, kinds, strict=False)], columns) for s in self.splitters]
        )

    def piece(self) -> Column:
        """Number of splitters at or before the row, by binary search."""
        n, splitters = len(self.splitters), self._array(self.columns)
        row = self._tuple([F.col(c) for c in self.columns], self.columns)
        steps = [1 << bit for bit in reversed(range(n.bit_length()))]
        return F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda low, step: F.when(
                (low + step <= n) & (F.get(splitters, low + step - 1) <= row), low + step
            ).otherwise(low),
        )

    def continues(self) -> Column:
        """Whether the row's key began before the row's piece did."""
        own = self._tuple([F.col(k) for k in self.keys], self.keys)
        starts = F.get(self._array(self.keys), F.col("_part") - 1)
        return F.coalesce((F.col("_part") > 0) & starts.eqNullSafe(own), F.lit(False))

    def hot(self) -> Column:
        """Whether the row's key is one of those that are cut."""
        keys = {s[: len(self.keys)] for s in self.splitters}
        if len(self.keys) == 1:  # one list, which scans can use to skip
            key, kind = F.col(self.keys[0]), self._kinds[0]
            listed = key.isin(*[_literal(k, kind) for (k,) in keys if k is not None])
            return (listed | key.isNull()) if (None,) in keys else listed
        same = [
            reduce(Column.__and__, [F.col(c).eqNullSafe(_literal(v, k)) for c, v, k in zip(self.keys, values, self._kinds, strict=False)])
            for values in sorted(keys, key=str)
        ]
        return reduce(Column.__or__, same)


def _scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    chunk_rows: int,
    state: Column,
    carried: Callable[[Window], Column],
    local: Callable[[Window], Column],
    combined: Callable[[Column, Column], Column],
) -> DataFrame:
    """A scan in pieces.

    ``state`` aggregates ``_value`` over a piece; ``carried`` takes the ``_state`` of the pieces before,
    over a window along them; ``local`` the result within a piece, and ``combined`` (carried, local) the row's.
    """
    cuts = Cuts(df, keys, order, chunk_rows)
    rows = df.withColumn("_value", value)
    if not cuts.splitters:
        rows = rows.withColumn("_local", local(Window.partitionBy(*keys).orderBy(*order)))
        return rows.withColumn(name, F.col("_local")).drop("_value", "_local")
    placed = rows.withColumn("_part", cuts.piece())
    flows = (
        placed.where(cuts.hot())
        .groupBy(*keys, "_part")
        .agg(state.alias("_state"))
        .withColumn("_carry", carried(Window.partitionBy(*keys).orderBy("_part")))
        .where(cuts.continues())
    )
    # Each splitter is a row, so entry n is what flows into piece n + 1.
    flows = flows.agg(F.array_sort(F.collect_list(F.struct("_part", "_carry"))).alias("flows")).scalar()
    done = placed.withColumn("_local", local(Window.partitionBy(*keys, "_part").orderBy(*order)))
    carry = F.when(cuts.continues(), F.get(flows, F.col("_part") - 1)["_carry"])
    done = done.withColumn("_carry", carry.cast(done.schema["_local"].dataType))
    result = combined(F.col("_carry"), F.col("_local"))
    return done.withColumn(name, result).drop("_value", "_part", "_local", "_carry")


def _before(window: Window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str = "running_sum",
    include_current: bool = True,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the key's rows up to (or strictly before) each row."""
    last = Window.currentRow if include_current else -1

    def local(window: Window) -> Column:
        return F.sum("_value").over(window.rowsBetween(Window.unboundedPreceding, last))

    if chunk_rows is None:
        whole = df.withColumn("_value", value)
        return whole.withColumn(name, local(Window.partitionBy(*keys).orderBy(*order))).drop("_value")
    return _scan(
        df, keys, order, value, name, chunk_rows,
        state=F.sum("_value"),
        carried=lambda window: F.sum("_state").over(_before(window)),
        local=local,
        combined=lambda carry, own: F.coalesce(carry + own, carry, own),
    )


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str = "running_max",
    include_current: bool = True,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Greatest ``value`` of the key's rows up to (or strictly before) each row.

    Rows that tie in the order may be taken in any sequence.
    """
    last = Window.currentRow if include_current else -1

    def local(window: Window) -> Column:
        return F.max("_value").over(window.rowsBetween(Window.unboundedPreceding, last))

    if chunk_rows is None:
        whole = df.withColumn("_value", value)
        return whole.withColumn(name, local(Window.partitionBy(*keys).orderBy(*order))).drop("_value")
    return _scan(
        df, keys, order, value, name, chunk_rows,
        state=F.max("_value"),
        carried=lambda window: F.max("_state").over(_before(window)),
        local=local,
        combined=lambda carry, own: F.greatest(carry, own),
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str = "previous",
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """``value`` of the key's row just before each row; null on its first row."""
    if chunk_rows is None:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))
    # In a struct, a null value differs from no row.
    scanned = _scan(
        df, keys, order, F.struct(value.alias("v")), name, chunk_rows,
        state=F.max_by("_value", F.struct(*order)),
        carried=lambda window: F.lag("_state").over(window),
        local=lambda window: F.lag("_value").over(window),
        combined=lambda carry, own: F.coalesce(own, carry),
    )
    return scanned.withColumn(name, F.col(name)["v"])


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str | None = None,
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Last non-null ``value`` seen at or before each row of the key."""
    name = name or value

    def local(window: Window) -> Column:
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last("_value", ignorenulls=True).over(frame)

    if chunk_rows is None:
        whole = df.withColumn("_value", F.col(value))
        return whole.withColumn(name, local(Window.partitionBy(*keys).orderBy(*order))).drop("_value")
    return _scan(
        df, keys, order, F.col(value), name, chunk_rows,
        state=F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))),
        carried=lambda window: F.last("_state", ignorenulls=True).over(_before(window)),
        local=local,
        combined=lambda carry, own: F.coalesce(own, carry),
    )
