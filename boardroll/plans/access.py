"""Row-level access: which account may see which school, and the workplace list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardroll.functions import is_blank

MANAGER_PREFIX = "1"


def manager_schools(accounts: DataFrame) -> DataFrame:
    """One row per manager account and school; the main school is always included."""
    listed, main = F.col("ecoles"), F.col("ecole_principale")
    trimmed = F.transform(F.split(listed, ","), lambda school: F.trim(school))
    schools = (
        F.when(main.isNull(), listed)
        .when(is_blank(listed), main)
        .when(F.array_contains(trimmed, F.trim(main)), listed)
        .otherwise(F.concat_ws(",", listed, main))
    )
    return (
        accounts.filter(F.col("corps_emploi").startswith(MANAGER_PREFIX))
        .withColumn("ecoles", schools)
        .select(
            "cle_organisationnelle",
            "compte_authentification",
            "nom",
            "prenom",
            "ecoles",
            "corps_emploi",
            "ecole_principale",
            "description_corps_emploi_principal",
            F.explode(F.split("ecoles", ",")).alias("ecole"),
        )
    )


def workplaces(places: DataFrame) -> DataFrame:
    return places.select("lieu_trav", F.col("descr").alias("lieu_trav_desc")).distinct()
