"""Teachers' qualifications and the report on qualified teachers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardroll.functions import band, year_boundaries
from boardroll.operators import latest
from boardroll.params import Params

# Labels and codes of the report.
TEACHER_PREFIX = "3"
NO_QUALIFICATION = "Aucune"
AGE_EDGES = (25, 35, 45, 55, 65)
AGE_LABELS = (
    "24 ans et moins",
    "25 à 34 ans",
    "35 à 44 ans",
    "45 à 54 ans",
    "55 à 64 ans",
    "65 ans et plus",
)


def teacher_qualifications(
    current: DataFrame, statuses: DataFrame, qualifications: DataFrame, params: Params
) -> DataFrame:
    """Active teachers with each valid qualification, the longest valid one per type."""
    active = statuses.filter(F.col("etat_actif").cast("int") == 1).select("etat_empl").distinct()
    valid = qualifications.filter(
        F.col("date_expir").isNull() | (F.col("date_expir") >= F.lit(params.as_of))
    ).select("matr", "type_qualif", "date_expir")
    rows = (
        current.filter(F.col("corp_empl").startswith(TEACHER_PREFIX))
        .join(active, "etat_empl")
        .join(valid, "matr", "left")
    )
    return latest(
        rows, ["matr", "type_qualif"], F.col("date_expir").desc(), "etat_empl", "lieu_trav",
        "stat_eng", "corp_empl",
    ).select(
        "matr",
        "etat_empl",
        F.col("lieu_trav").alias("workplace"),
        "stat_eng",
        "corp_empl",
        "type_qualif",
        "date_expir",
    )


def qualification_report(
    teachers: DataFrame,
    employees: DataFrame,
    workplaces: DataFrame,
    statuses: DataFrame,
    job_classes: DataFrame,
    teacher_statuses: DataFrame,
    qualification_names: DataFrame,
    params: Params,
    sectors: DataFrame | None = None,
) -> DataFrame:
    """Qualified and unqualified teachers with labels; the sector seed is optional."""
    people = employees.select("matr", "legal_name", "sex_friendly_name", "birth_date")
    status = statuses.select("etat_empl", F.col("descr").alias("status_name"))
    classes = job_classes.select(F.col("code_job").alias("corp_empl"), "code_job_name")
    kinds = teacher_statuses.select(F.col("code").alias("stat_eng"), "statut")
    names = qualification_names.select(
        F.col("code").alias("type_qualif"),
        F.col("descr").alias("qualification_name"),
        F.col("is_qualified").cast("int").alias("is_qualified"),
    )
    rows = (
        teachers.join(people, "matr")
        .join(workplaces.select("workplace", "workplace_name"), "workplace")
        .join(status, "etat_empl")
        .join(classes, "corp_empl")
        .join(kinds, "stat_eng")
        .join(names, "type_qualif", "left")
    )
    if sectors is None:
        rows = rows.withColumns(
            {"ordre_Ens": F.lit(None).cast("string"), "secteur_Descr": F.lit(None).cast("string")}
        )
    else:
        places = sectors.select(F.col("lieu_trav").alias("workplace"), "ordre_Ens", "secteur_Descr")
        rows = rows.join(places, "workplace", "left")
    qualified = F.coalesce(F.col("is_qualified") == 1, F.lit(False))
    return rows.select(
        F.col("matr").alias("matricule"),
        F.col("legal_name").alias("nom_legal"),
        F.when(F.lower("sex_friendly_name") == "femme", "Femme").otherwise("Homme").alias("genre"),
        band(year_boundaries("birth_date", F.lit(params.as_of)), AGE_EDGES, AGE_LABELS).alias(
            "tranche_age"
        ),
        F.col("workplace_name").alias("lieu_principal"),
        F.col("code_job_name").alias("corp_empl"),
        F.when(F.col("type_qualif").isNull(), F.lit(NO_QUALIFICATION))
        .otherwise(F.col("qualification_name"))
        .alias("qualification"),
        F.col("status_name").alias("etat_empl"),
        qualified.cast("int").alias("edb"),
        (~qualified).cast("int").alias("endb"),
        F.col("statut").alias("statut_enseignant"),
        F.col("ordre_Ens").alias("ordre_ens"),
        F.col("secteur_Descr").alias("secteur"),
        "date_expir",
        "type_qualif",
    )
