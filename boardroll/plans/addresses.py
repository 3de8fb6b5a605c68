"""Pupil addresses: the latest of each school year and the one held on 30 September."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardroll.functions import day_of_year, school_year
from boardroll.params import Params

FIELDS = ("no_civ", "orient_rue", "genre_rue", "rue", "ville", "code_post")
STARTS_FROM_MONTH, ENDS_FROM_MONTH = 7, 9


def yearly_addresses(addresses: DataFrame, params: Params) -> DataFrame:
    """One row per pupil and school year.

    A pupil's first address counts, and the others count if they are all of one type or
    are marked for official mail. An address holds until the day before the next one.

    What is kept is decided from one aggregate per pupil; addresses that start on the
    same day are collapsed to one before the window that closes the intervals. Both picks
    of a year then come from a single aggregation, with no join of the table to itself.
    """
    valid = addresses.filter(F.col("date_effect") != F.col("date_fin")).select(
        "fiche", "type_adr", "date_effect", "ind_envoi_meq", F.struct(*FIELDS).alias("address")
    )
    start_order = F.struct("date_effect", "type_adr", "address")
    pupils = valid.groupBy("fiche").agg(
        F.min(start_order).alias("first"),
        (F.min("type_adr") == F.max("type_adr")).alias("one_type"),
    )
    kept = valid.join(pupils, "fiche").filter(
        F.col("one_type") | (F.col("ind_envoi_meq") == 1) | (start_order == F.col("first"))
    )
    next_start = F.lead("date_effect").over(Window.partitionBy("fiche").orderBy("date_effect"))
    held = (
        kept.groupBy("fiche", "date_effect")
        .agg(F.max_by("address", F.struct("type_adr", "address")).alias("address"))
        .withColumn("until", F.coalesce(F.date_sub(next_start, 1), F.lit(params.as_of)))
    )
    first, last = school_year("date_effect", STARTS_FROM_MONTH), school_year("until", ENDS_FROM_MONTH)
    by_year = held.withColumn(
        "annee", F.explode(F.when(first <= last, F.sequence(first, last)))
    )
    on_30_sept = day_of_year("annee", 9, 30).between(F.col("date_effect"), F.col("until"))
    picks = by_year.groupBy("fiche", "annee").agg(
        F.max_by("address", "date_effect").alias("last"),
        F.max_by("address", F.when(on_30_sept, F.col("date_effect"))).alias("sept"),
    )
    return picks.select(
        "fiche",
        "annee",
        *[F.col(f"last.{field}").alias(f"last_{field}") for field in FIELDS],
        *[
            F.col(f"sept.{field}").alias("ville__30sept" if field == "ville" else f"{field}_30sept")
            for field in FIELDS
        ],
    )
