"""CUBE with named total rows, over groups and over single rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


UNKNOWN = "inconnu"


def labelled_cube(
    df: DataFrame,
    fixed: Sequence[str],
    totals: Mapping[str, str | None],
    sums: Mapping[str, Column],
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Sums for every subset of the dimensions in ``totals``, within the fixed columns.

    ``totals`` maps a dimension to the label of its total row (None leaves it null). A
    null dimension value is labelled ``unknown`` before the cube, so that a null in the
    cube is always a total and never mistaken for a value.

    Rows are first summed to the finest grain, so CUBE multiplies that small result by
    2^n and not the input. Only additive measures are taken; build means from two sums.
    """
    dims = list(totals)
    known = df.withColumns({d: F.coalesce(F.col(d), F.lit(unknown)) for d in dims})
    base = known.groupBy(*fixed, *dims).agg(*[c.alias(name) for name, c in sums.items()])
    sets = [
        [F.col(c) for c in (*fixed, *kept)]
        for size in range(len(dims), -1, -1)
        for kept in combinations(dims, size)
    ]
    cube = base.groupingSets(sets, *[F.col(c) for c in (*fixed, *dims)]).agg(
        *[F.sum(name).alias(name) for name in sums],
    )
    return cube.withColumns(
        {d: F.coalesce(F.col(d), F.lit(label)) for d, label in totals.items() if label}
    )


def row_cube(df: DataFrame, dims: Sequence[str], label: str) -> DataFrame:
    """Repeat each row for every subset of ``dims`` replaced by ``label``.

    One generator in one pass, instead of a union of 2^n scans.
    """
    masks = F.explode(F.array(*[F.lit(mask) for mask in range(2 ** len(dims))]))
    masked = df.withColumn("_mask", masks)
    return masked.withColumns(
        {
            dim: F.when(F.col("_mask").bitwiseAND(1 << place) != 0, F.lit(label)).otherwise(
                F.col(dim)
            )
            for place, dim in enumerate(dims)
        }
    ).drop("_mask")
