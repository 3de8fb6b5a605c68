"""CSV seeds: small lookups with declared types, some of them optional."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from boardroll.operators.dealing import join_codes
from boardroll.sources.registry import SEEDS

_CORRUPT = "_corrupt_record"
_SHOWN = 5


class BadSeed(ValueError):
    """A seed that does not hold what is declared for it."""


def read_seed(spark: SparkSession, name: str, path: str | None) -> DataFrame:
    """Read a seed with its declared types; ``path=None`` gives the empty seed.

    Columns are found by their names in the header, in any order and case; others are left out.
    A declared column that the header lacks, a name given twice, a row of more or fewer
    cells than the header, and a cell that is not of its type raise ``BadSeed``, which names
    the first such records (the one after the header is 1) and columns. An empty cell is null.
    """
    declared = StructType.fromDDL(SEEDS[name])
    if path is None:
        return spark.createDataFrame([], declared)
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    given = [c.strip().removeprefix("﻿") for c in reader.option("inferSchema", False).csv(path).columns]
    lower = [c.lower() for c in given]
    missing = [f.name for f in declared if f.name.lower() not in lower]
    if missing:
        raise BadSeed(f"{name} lacks {', '.join(missing)}: its header is {', '.join(given)}")
    # Cells are read as text under numbered names, and then found by the header's.
    cells = StructType([StructField(f"c{n}", StringType()) for n in range(len(given))])
    rows = reader.schema(cells.add(_CORRUPT, StringType())).option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    text = {f.name: F.col(f"c{lower.index(f.name.lower())}") for f in declared}
    typed = [text[f.name].try_cast(f.dataType).alias(f.name) for f in declared]
    wrong = [
        F.when(text[f.name].isNotNull() & text[f.name].try_cast(f.dataType).isNull(),
               F.concat(F.lit(f"{f.name} holds "), text[f.name], F.lit(f", no {f.dataType.simpleString()}")))
        for f in declared
    ]
    uneven = F.when(F.col(_CORRUPT).isNotNull(), F.concat(F.lit("not one cell for each column: "), _CORRUPT))
    faults = F.array_compact(F.array(uneven, *wrong))
    # Seeds are small files, read by one task: the row's number is the record's.
    numbered = rows.select((F.monotonically_increasing_id() + 1).alias("record"), faults.alias("faults"))
    bad = numbered.where(F.size("faults") > 0).orderBy("record").limit(_SHOWN).collect()
    if bad:
        listed = "; ".join(f"record {r['record']}: {', '.join(r['faults'])}" for r in bad)
        raise BadSeed(f"{name}: {listed}")
    return rows.select(*typed)


def flag_codes(df: DataFrame, codes: DataFrame, column: str, name: str, *spread: str) -> DataFrame:
    """Flag rows whose ``column`` is among the codes of a seed; an empty seed flags none.

    The list stays a joined frame: it is not collected to build a literal list. The rows of a
    code are spread by the columns ``spread``, if any, as ``join_codes`` does.
    """
    listed = codes.select(F.col(codes.columns[0]).alias("_code")).distinct()
    if spread:
        flagged = join_codes(df.withColumn("_code", F.col(column)), listed.withColumn(name, F.lit(True)), "_code", *spread, how="left")
        return flagged.withColumn(name, F.col(name).isNotNull()).select(*df.columns, name)
    return (
        df.join(listed, F.col(column) == F.col("_code"), "left")
        .withColumn(name, F.col("_code").isNotNull())
        .drop("_code")
    )


def code_labels(df: DataFrame, label: str, code: str, chosen: list[object]) -> DataFrame:
    """Distinct labels of the chosen codes, for a run's log."""
    if not chosen:
        raise ValueError("at least one code is needed")
    return df.filter(F.col(code).isin(*chosen)).select(label).distinct()
