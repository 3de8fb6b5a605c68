"""Declarative data checks; each returns the failing rows as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardroll.operators.dealing import grouped


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with ``n_rows``; null keys are compared too."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[object]) -> DataFrame:
    """Rows whose non-null value is not in the accepted list."""
    return df.filter(~F.col(column).isin(*accepted))


def outside_range(
    df: DataFrame,
    column: str,
    low: float | None = None,
    high: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Rows whose non-null value is outside the accepted range."""
    value, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | ((value < low) if inclusive else (value <= low))
    if high is not None:
        bad = bad | ((value > high) if inclusive else (value >= high))
    return df.filter(bad)


def _duplicated(df: DataFrame, unique: Mapping[str, Sequence[str]]) -> DataFrame:
    """check_name and n_failures of each set of keys: how many of its values more than one row holds."""
    columns = list(dict.fromkeys(c for keys in unique.values() for c in keys))
    sets = list(dict.fromkeys(frozenset(keys) for keys in unique.values()))
    if len(sets) == 1:  # so that rows that are dealt by part of the key can stay where they are
        held = grouped(df, *columns).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").withColumn("_set", F.lit(0))
    else:
        by_set = df.groupingSets([[c for c in columns if c in keys] for keys in sets], *columns)
        held = by_set.agg(F.grouping_id(*columns).alias("_set"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    # Bits of a set's number: one for every column, the first the highest, set where it is left out.
    number = {keys: sum((c not in keys) << n for n, c in enumerate(reversed(columns))) for keys in sets}
    counted = held.agg(*[F.count_if(F.col("_set") == number[keys]).alias(f"s{n}") for n, keys in enumerate(sets)])
    rows = [
        F.struct(F.lit(f"unique:{name}").alias("check_name"), F.col(f"s{sets.index(frozenset(keys))}").alias("n_failures"))
        for name, keys in unique.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


def quality_report(
    df: DataFrame,
    unique: Mapping[str, Sequence[str]] | None = None,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[object]] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """One row per check with its number of failures.

    All row-level checks are counted in a single pass over the table. All uniqueness checks
    share another: one grouping by every set of keys at once, which counts the duplicated
    key values of each; null keys are compared too.
    """
    row_checks: dict[str, Column] = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    for column, values in (accepted or {}).items():
        row_checks[f"accepted_values:{column}"] = ~F.col(column).isin(*values)
    for column, (low, high) in (ranges or {}).items():
        row_checks[f"accepted_range:{column}"] = ~F.col(column).between(low, high)
    parts = []
    if row_checks:
        names = list(row_checks)
        counted = df.agg(*[F.count_if(row_checks[n]).alias(f"c{i}") for i, n in enumerate(names)])
        pairs = F.array(
            *[
                F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("n_failures"))
                for i, n in enumerate(names)
            ]
        )
        parts.append(counted.select(F.inline(pairs)))
    if unique:
        parts.append(_duplicated(df, unique))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
