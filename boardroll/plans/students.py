"""Pupils: diplomas, the yearly pupil table, attendance perimeters and populations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardroll.params import Params

# Teaching levels, and grade labels as
# (label, level, cycle, years of the cycle, classes that alone give the grade).
KINDERGARTEN_4, KINDERGARTEN_5, PRIMARY, SECONDARY = "1", "2", "3", "4"
GRADES = (
    ("Prim 1", PRIMARY, "1", ("1", "7"), ()),
    ("Prim 2", PRIMARY, "1", ("2", "8"), ()),
    ("Prim 3", PRIMARY, "2", ("1", "7"), ()),
    ("Prim 4", PRIMARY, "2", ("2", "8"), ()),
    ("Prim 5", PRIMARY, "3", ("1", "7"), ()),
    ("Prim 6", PRIMARY, "3", ("2", "8"), ()),
    ("Sec 1", SECONDARY, "1", ("1", "7"), ()),
    ("Sec 2", SECONDARY, "1", ("2", "8"), ()),
    ("Sec 3", SECONDARY, "2", ("1", "7"), ("3",)),
    ("Sec 4", SECONDARY, "2", ("2", "8"), ("4",)),
    ("Sec 5", SECONDARY, "2", ("3", "9"), ("5", "7", "8")),
)
KINDERGARTEN_LABELS = {KINDERGARTEN_4: "Mat 4", KINDERGARTEN_5: "Mat 5"}
# Classes in which a primary pupil in (cycle, year) repeats the year.
REPEATING_CLASSES = {
    (1, 7): ("A",),
    (1, 8): ("B", "C"),
    (2, 7): ("D",),
    (2, 8): ("E", "F"),
    (3, 7): ("G",),
    (3, 8): ("H", "I"),
}
REGULAR_POPULATION = "régulier"
DIPLOMAS = {"indice_des": "DES", "indice_cfpt": "CFPT", "indice_cfms": "CFMS"}
SEMI_SKILLED_PATH, TRAINING_PATH = "08", "07"


def diplomas(mentions: DataFrame, programmes: DataFrame) -> DataFrame:
    """Sanctioned programmes with their school year (from September) and diploma flags."""
    year = F.substring("date_exec_sanct", 1, 4).cast("int")
    month = F.substring("date_exec_sanct", 5, 2).cast("int")
    known = programmes.select(F.col("prog_meq").alias("prog_charl"), "type_diplome")

    def flag(condition: Column) -> Column:
        return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))

    return mentions.join(known, "prog_charl").select(
        "fiche",
        "code_perm",
        "eco_cen_off",
        "prog_charl",
        F.when(month.between(9, 12), year).when(month.between(1, 8), year - 1).alias("annee"),
        flag(F.col("ind_reus_sanct_charl") == "O").alias("ind_obtention"),
        "regime_sanct_charl",
        "date_exec_sanct",
        "date_obt_mention",
        *[flag(F.col("type_diplome") == code).alias(name) for name, code in DIPLOMAS.items()],
    )


def grade_label() -> Column:
    """Grade from level, cycle and year of the cycle; the first match of the list wins."""
    level, cycle, year = F.col("ordre_ens"), F.col("cycle_ref"), F.col("annee_cycle_ref")
    label = F
    for name, grade_level, grade_cycle, years, classes in GRADES:
        in_cycle = (cycle == grade_cycle) & year.isin(*years)
        in_class = F.col("classe").isin(*classes) if classes else F.lit(False)
        label = label.when((level == grade_level) & (in_cycle | in_class), F.lit(name))
    for grade_level, name in KINDERGARTEN_LABELS.items():
        label = label.when(level == grade_level, F.lit(name))
    return label.otherwise(F.lit("-"))


def repeats_year() -> Column:
    """1 for a pupil who repeats the year: by class in primary, else as the year before."""
    level, classe = F.col("ordre_ens"), F.col("classe")
    cycle, year = F.col("cycle_ref").try_cast("int"), F.col("annee_cycle_ref").try_cast("int")
    before = Window.partitionBy("fiche").orderBy("annee", "id_eco")
    repeats = F.lit(False)
    for (of_cycle, of_year), classes in REPEATING_CLASSES.items():
        repeats = repeats | (
            (level == PRIMARY) & (cycle == of_cycle) & (year == of_year) & classe.isin(*classes)
        )
    regular = F.lower("population").contains(REGULAR_POPULATION)
    repeats = repeats | ((level == SECONDARY) & regular & (F.lag("classe").over(before) == classe))
    repeats = repeats | ((level == KINDERGARTEN_5) & (F.lag("ordre_ens").over(before) == level))
    return F.when(repeats, 1).otherwise(0)


def yearly_students(
    spine: DataFrame,
    pupils: DataFrame,
    schools: DataFrame,
    measures: DataFrame,
    measure_names: DataFrame,
    params: Params,
) -> DataFrame:
    """One row per pupil and year: school, grade, repeater and programme flags."""
    base = spine.filter("seqid = 1").filter(
        F.col("annee") >= params.current_year - params.years_of_students
    )
    record = pupils.select(
        "fiche", "id_eco", "grp_rep", "dist", "ordre_ens", "classe", "class",
        "plan_interv_ehdaa", "cycle_ref", "annee_cycle_ref", "difficulte", "age_30_sept",
        "type_parcours", "categ_prog_part", "type_prog_part", "grille",
    )
    named = schools.select("id_eco", F.col("school_friendly_name").alias("nom_ecole"))
    measured = measures.select("fiche", "id_eco", "type_mesure", "is_francisation")
    described = measure_names.filter(F.col("nom_table") == "type_mesure").select(
        F.col("code").alias("type_mesure"),
        F.col("cf_descr_abreg").alias("description_type_mesure"),
    )
    plan = F.col("plan_interv_ehdaa")
    return (
        base.join(record, ["fiche", "id_eco"])
        .join(named, "id_eco")
        .join(measured, ["fiche", "id_eco"], "left")
        .join(described, "type_mesure", "left")
        .select(
            "code_perm",
            "id_eco",
            "annee",
            "fiche",
            "population",
            "eco",
            "grp_rep",
            "dist",
            "nom_ecole",
            "ordre_ens",
            "classe",
            "class",
            "cycle_ref",
            "annee_cycle_ref",
            F.when(plan.isNull(), "Sans").when(plan == "1", "Avec").otherwise(plan).alias(
                "plan_interv_ehdaa"
            ),
            grade_label().alias("niveau_scolaire"),
            "difficulte",
            repeats_year().alias("is_doubleur"),
            "age_30_sept",
            "type_parcours",
            F.col("type_prog_part").alias("type_programme_particulier"),
            F.col("categ_prog_part").alias("categorie_programme_particulier"),
            F.col("categ_prog_part").isNotNull().cast("int").alias("is_ppp"),
            "type_mesure",
            F.when(F.col("is_francisation") == 1, 1).otherwise(0).alias("is_francisation"),
            "description_type_mesure",
            "grille",
        )
    )


def _perimeter(students: DataFrame, params: Params, condition: Column) -> DataFrame:
    """Pupils that meet a condition, without the provisional year to come."""
    return (
        students.filter(condition)
        .filter(F.col("annee") < params.current_year + 1)
        .select("fiche", "id_eco")
    )


def diploma_perimeter(students: DataFrame, params: Params) -> DataFrame:
    last_grade = (F.col("ordre_ens") == SECONDARY) & (F.col("niveau_scolaire") == "Sec 5")
    return _perimeter(students, params, last_grade)


def semi_skilled_perimeter(students: DataFrame, params: Params) -> DataFrame:
    on_path = (F.col("ordre_ens") == SECONDARY) & (F.col("type_parcours") == SEMI_SKILLED_PATH)
    return _perimeter(students, params, on_path)


def training_perimeter(students: DataFrame, params: Params) -> DataFrame:
    on_path = (
        (F.col("type_parcours") == TRAINING_PATH)
        & (F.col("cycle_ref").try_cast("int") == 2)
        & (F.col("annee_cycle_ref").try_cast("int") == 3)
    )
    return _perimeter(students, params, on_path)


def population(
    pupils: DataFrame,
    school_years: DataFrame,
    people: DataFrame,
    predicate: Column | None = None,
) -> DataFrame:
    """Distinct pupils of a population; a site states it as a predicate.

    The predicate may use the columns of the pupil record, ``eco`` and ``annee``.
    """
    rows = pupils.join(school_years.select("id_eco", "annee", "eco"), "id_eco", "left").join(
        people.select("fiche", "code_perm"), "fiche", "left"
    )
    if predicate is not None:
        rows = rows.filter(predicate)
    return rows.select("code_perm", "id_eco", "annee").distinct()
