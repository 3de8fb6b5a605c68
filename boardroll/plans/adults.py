"""Adult education: people, enrolments, headcount report and success reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardroll.functions import (
    age_on,
    band,
    concat_blank,
    dash_if_blank,
    day_of_year,
    is_blank,
    ratio,
    surrogate_key,
    yyyymmdd,
)
from boardroll.operators import decode, labelled_cube, row_cube
from boardroll.params import Params

# Populations, states, labels, code domains and report dimensions.
GENERAL = "Formation générale des adultes"
VOCATIONAL = "Formation professionnelle"
ENROLLED, FINISHED = "En cours", "Terminé"
ALL = "Tous"
AGE_EDGES = (16, 18, 22, 26)
AGE_LABELS = ("- de 16 ans", "16-17 ans", "18-21 ans", "22-25 ans", "+ de 26 ans")
GENDERS = {"F": "Fille", "M": "Garçon"}
LANGUAGE_DOMAIN = "X_Lang"
# (code column, domain, label column)
CODES = (
    ("service_enseign", "X_ServiceEnseign", "descr_service_enseign"),
    ("motif_depart", "X_MotifDep", "descr_motif_dep"),
    ("raison_depart", "X_RaisonDepart", "desc_raison_depart"),
    ("type_parcours", "X_TypeParcours", "descr_type_parcours"),
    ("cond_admiss", "X_CondAdmiss", "descr_condadmiss"),
    ("raison_grat_scol", "X_RaisonGratScol", "descr_raison_grat_scol"),
)
GENERAL_DIMS = (
    "programme", "organisation_horaire", "desc_type_parcours", "service_enseignement",
    "nom_centre", "genre", "desc_raison_depart",
)
VOCATIONAL_DIMS = (
    "programme", "groupe_horaire", "desc_type_parcours", "condition_admission",
    "nom_centre", "genre", "desc_raison_depart",
)
LISTED = (
    "freq", "prenom_nom", "code_perm", "fiche", "population", "année", "annee_scolaire",
    "eco_cen", "bat", "ind_transm", "ville", "interv_age", "interv_age_fp", "etat_formation",
    "langue_maternelle", "type_diplome", "descr_raison_grat_scol", "descr_motif_dep",
)


def adult_students(
    populations: DataFrame, people: DataFrame, addresses: DataFrame, codes: DataFrame
) -> DataFrame:
    """One row per person, with the highest of each attribute where records differ.

    Each side is reduced to one row per key before it is joined, so that the product of a
    person's records, files and addresses is never formed.
    """
    genre = F.col("genre")
    label = F
    for code, name in GENDERS.items():
        label = label.when(genre == code, F.lit(name))
    spoken = decode(people, codes, "lang_matern", LANGUAGE_DOMAIN, "desc_lang_matern")
    attributes = [
        "nom", "prenom", "date_naissance", "ind_lieu_naissance_n", "lang_matern", "desc_lang_matern",
    ]
    person = spoken.groupBy("code_perm").agg(
        *[F.max(c).alias(c) for c in attributes], F.max(label.otherwise(genre)).alias("genre")
    )
    mailing = addresses.filter((F.col("envoimeq") == "1") & (F.trim("date_fin") == ""))
    home = mailing.groupBy("fiche").agg(
        F.max("ville").alias("ville"), F.max("code_post").alias("code_post")
    )
    homes = (
        populations.select("code_perm", "fiche")
        .distinct()
        .join(home, "fiche", "left")
        .groupBy("code_perm")
        .agg(F.max("ville").alias("ville"), F.max("code_post").alias("code_post"))
    )
    full = concat_blank("nom", F.lit(", "), "prenom", F.lit(" ("), "code_perm", F.lit(" )"))
    return homes.join(person, "code_perm").select(
        "code_perm",
        "nom",
        "prenom",
        full.alias("nom_prenom_code_perm"),
        "date_naissance",
        "ind_lieu_naissance_n",
        "lang_matern",
        "desc_lang_matern",
        "ville",
        "code_post",
        "genre",
    )


def adult_enrolments(
    populations: DataFrame,
    students: DataFrame,
    enrolments: DataFrame,
    programmes: DataFrame,
    codes: DataFrame,
    timetables: DataFrame,
    centres: DataFrame,
    params: Params,
) -> DataFrame:
    """Enrolments of the last years with ages at two dates and all codes decoded."""
    recent = populations.filter(F.col("annee") >= params.current_year - params.years_of_adults)
    births = students.select("code_perm", yyyymmdd("date_naissance").alias("birth"))
    detail = enrolments.select(
        "fiche", "annee", "freq", "client", "eco_cen", "org", "bat", "org_hor", "date_deb",
        "date_fin_sifca", "activ_form", "donpers", "cond_admiss", "ind_transm", "prog",
        "raison_grat_scol", "type_parcours", "service_enseign", "motif_depart", "raison_depart",
    )
    rows = (
        recent.select("code_perm", "fiche", "annee", "freq", "population")
        .join(births, "code_perm")
        .join(detail, ["fiche", "annee", "freq"])
        .join(centres.select("eco_cen", F.col("descr").alias("centre")), "eco_cen")
        .join(programmes.select("prog", "descr_prog", "type_diplome"), "prog", "left")
        .join(
            timetables.select("eco_cen", "org_hor", F.col("descr").alias("descr_org_hor")),
            ["eco_cen", "org_hor"],
            "left",
        )
    )
    for column, domain, name in CODES:
        rows = decode(rows, codes, column, domain, name)
    june = age_on(F.col("birth"), day_of_year("annee", 6, 30))
    september = age_on(F.col("birth"), day_of_year("annee", 9, 30))
    state = F.when(
        is_blank("date_fin_sifca") | (F.col("motif_depart") == params.still_enrolled_reason),
        F.lit(ENROLLED),
    ).otherwise(F.lit(FINISHED))
    transmissible = F.when(F.col("ind_transm") == 1, "Transmissible").when(
        F.col("ind_transm") == 0, "Non-transmissible"
    )
    return rows.select(
        "code_perm",
        "fiche",
        "client",
        "population",
        "annee",
        "freq",
        concat_blank(F.lit("("), "eco_cen", F.lit(") - "), "centre").alias("nom_centre"),
        band(june, AGE_EDGES, AGE_LABELS).alias("interv_age"),
        band(september, AGE_EDGES, AGE_LABELS).alias("interv_age_fp"),
        june.alias("age_30_juin"),
        september.alias("age_30_septembre"),
        "org",
        "eco_cen",
        "bat",
        "org_hor",
        transmissible.alias("ind_transm"),
        "descr_org_hor",
        "date_deb",
        "date_fin_sifca",
        "activ_form",
        "donpers",
        "cond_admiss",
        "descr_condadmiss",
        state.alias("etat_formation"),
        "prog",
        "descr_prog",
        "type_diplome",
        "raison_grat_scol",
        "descr_raison_grat_scol",
        "type_parcours",
        "descr_type_parcours",
        "service_enseign",
        "descr_service_enseign",
        "motif_depart",
        "descr_motif_dep",
        "raison_depart",
        "desc_raison_depart",
    )


def _coded(code: str, label: str) -> Column:
    return concat_blank(code, F.lit(" - "), label)


def _coded_if_known(code: str, label: str) -> Column:
    return F.when(F.col(label).isNotNull(), _coded(code, label))


def adult_headcount_report(enrolments: DataFrame, students: DataFrame) -> DataFrame:
    """Report rows: one per enrolment, with labels for every slicer."""
    who = students.select(
        "code_perm",
        "genre",
        concat_blank("prenom", F.lit(" "), "nom").alias("prenom_nom"),
        "desc_lang_matern",
        "ville",
    )
    timetable = F.when(is_blank("activ_form"), F.col("donpers")).otherwise(F.col("activ_form"))
    return enrolments.join(who, "code_perm").select(
        "nom_centre",
        "freq",
        "prenom_nom",
        "code_perm",
        "fiche",
        "population",
        F.col("annee").alias("année"),
        concat_blank("annee", F.lit("-"), F.col("annee") + 1).alias("annee_scolaire"),
        "eco_cen",
        "bat",
        "ind_transm",
        "ville",
        "interv_age",
        "interv_age_fp",
        dash_if_blank(timetable).alias("groupe_horaire"),
        _coded("cond_admiss", "descr_condadmiss").alias("condition_admission"),
        F.col("descr_org_hor").alias("organisation_horaire"),
        "etat_formation",
        "genre",
        F.col("desc_lang_matern").alias("langue_maternelle"),
        "prog",
        F.coalesce(_coded_if_known("prog", "descr_prog"), F.lit("-")).alias("programme"),
        "type_diplome",
        "raison_grat_scol",
        _coded("raison_grat_scol", "descr_raison_grat_scol").alias("descr_raison_grat_scol"),
        "type_parcours",
        _coded("type_parcours", "descr_type_parcours").alias("desc_type_parcours"),
        _coded_if_known("service_enseign", "descr_service_enseign").alias("service_enseignement"),
        "service_enseign",
        "motif_depart",
        "descr_motif_dep",
        "raison_depart",
        _coded_if_known("raison_depart", "desc_raison_depart").alias("desc_raison_depart"),
    )


def succeeded(params: Params) -> Column:
    """Reason of departure is a success. Codes are numbers; other text is no success."""
    return F.coalesce(
        F.col("raison_depart").try_cast("int").isin(*params.success_reasons), F.lit(False)
    )


def _finished(report: DataFrame, population: str) -> DataFrame:
    return report.filter(
        (F.col("population") == population) & (F.col("etat_formation") == FINISHED)
    )


def _success_rates(rows: DataFrame, dims: Sequence[str], params: Params) -> DataFrame:
    dashed = rows.withColumns({d: dash_if_blank(d) for d in dims})
    cube = labelled_cube(
        dashed,
        ["année"],
        {d: ALL for d in dims},
        {
            "nombre_total": F.count(F.lit(1)),
            "nombre_total_by_reussite": F.sum(succeeded(params).cast("int")),
        },
    )
    return cube.filter("nombre_total_by_reussite > 0").select(
        "année",
        *dims,
        "nombre_total",
        "nombre_total_by_reussite",
        ratio("nombre_total_by_reussite", "nombre_total").alias("taux"),
        surrogate_key("année", *dims).alias("id_filtre"),
    )


def general_success_rates(report: DataFrame, params: Params) -> DataFrame:
    """Success counts and rate for every filter, general adult education."""
    rows = _finished(report, GENERAL)
    if params.excluded_services:
        excluded = [int(code) for code in params.excluded_services]
        rows = rows.filter(~F.col("service_enseign").try_cast("int").isin(*excluded))
    return _success_rates(rows, GENERAL_DIMS, params)


def vocational_success_rates(report: DataFrame, params: Params) -> DataFrame:
    """Success counts and rate for every filter, vocational training."""
    return _success_rates(_finished(report, VOCATIONAL), VOCATIONAL_DIMS, params)


def _success_list(
    report: DataFrame, population: str, dims: Sequence[str], params: Params
) -> DataFrame:
    rows = _finished(report, population).filter(succeeded(params))
    originals = {f"{d}_bis": F.col(d) for d in dims}
    dashed = rows.withColumns(originals).withColumns({d: dash_if_blank(d) for d in dims})
    needed = dashed.select(*originals, *dims, *[c for c in LISTED if c not in dims])
    return row_cube(needed, dims, ALL).select(
        *originals, surrogate_key("année", *dims).alias("id_filtre"), *LISTED
    )


def general_success_list(report: DataFrame, params: Params) -> DataFrame:
    """People who succeeded, once per filter that shows them, general adult education."""
    return _success_list(report, GENERAL, GENERAL_DIMS, params)


def vocational_success_list(report: DataFrame, params: Params) -> DataFrame:
    """People who succeeded, once per filter that shows them, vocational training."""
    return _success_list(report, VOCATIONAL, VOCATIONAL_DIMS, params)
