"""Declared checks of the tables and seeds: keys, required columns, values and ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from boardroll.operators import quality_report


@dataclass(frozen=True)
class Checks:
    """``key`` is the column set that no two rows share."""

    key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: Mapping[str, Sequence[object]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def passes(self) -> int:
        """How often the checks read the table."""
        return bool(self.key or self.unique) + bool(self.not_null or self.accepted or self.ranges)


# The checks each table and seed is declared with.
CHECKS: dict[str, Checks] = {
    "absence_reasons": Checks(("id_eco", "motif_abs"), not_null=("category_abs",)),
    "absences_daily": Checks(("fiche", "date_abs", "id_eco", "event_kind", "code_matiere")),
    "absence_sequences": Checks(
        ("school_year", "fiche", "id_eco", "absence_sequence_id", "event_kind")
    ),
    "daily_students": Checks(("date_evenement", "id_eco", "groupe", "grille", "etape")),
    "padding": Checks(
        ("id_eco", "date_evenement", "groupe", "event_kind", "code_matiere", "etape", "grille")
    ),
    "daily_metrics": Checks(
        (
            "annee",
            "groupe",
            "school_friendly_name",
            "date_evenement",
            "etape_friendly",
            "event_kind",
            "code_matiere",
        )
    ),
    "daily_rate_report": Checks(("filter_key", "jour_semaine", "date_evenement")),
    "term_rate_report": Checks(("filter_key", "etape_friendly")),
    "kind_distribution_report": Checks(("filter_key", "date_evenement", "event_description")),
    "subject_distribution_report": Checks(("filter_key", "date_evenement", "code_matiere")),
    "absence_filters_report": Checks(("filter_key", "eco")),
    "long_absence_report": Checks(("school_friendly_name", "fiche", "event_start_date")),
    "yearly_addresses": Checks(("fiche", "annee")),
    "adult_students": Checks(unique=("code_perm",), not_null=("code_perm",)),
    "adult_enrolments": Checks(
        ("fiche", "code_perm", "annee", "freq", "population"),
        not_null=("code_perm", "fiche", "annee", "freq", "population"),
    ),
    "adult_headcount_report": Checks(("code_perm", "population", "année", "freq", "fiche")),
    "general_success_rates": Checks(("id_filtre",)),
    "vocational_success_rates": Checks(("id_filtre",)),
    "general_success_list": Checks(("code_perm", "fiche", "freq", "id_filtre")),
    "vocational_success_list": Checks(("code_perm", "fiche", "freq", "id_filtre")),
    "main_job_yearly": Checks(
        ("matr", "school_year"), not_null=("matr", "school_year", "main_job")
    ),
    "activity_yearly": Checks(("matr", "school_year", "ref_empl")),
    "activity_current": Checks(unique=("matr",)),
    "seniority": Checks(not_null=("school_year", "matr")),
    "retirements": Checks(unique=("matr",), not_null=("matr",)),
    "retirement_curve": Checks(
        unique=("age",),
        not_null=("age", "instantaneous_death_rate", "survival_rate"),
        ranges={"instantaneous_death_rate": (0, 1), "survival_rate": (0, 1)},
    ),
    "retirement_forecasts": Checks(("school_year", "job_group_category")),
    "active_age_report": Checks(
        ("genre", "etat", "job_group_category", "lieu_trav", "stat_eng", "age")
    ),
    "retirement_age_report": Checks(
        (
            "genre",
            "school_year",
            "etat",
            "job_group_category",
            "lieu_trav",
            "stat_eng",
            "retirement_age",
        )
    ),
    "retirement_filters_report": Checks(
        (
            "genre",
            "employment_status_name",
            "engagement_status_name",
            "workplace_name",
            "job_group_category",
            "filter_key",
        )
    ),
    "teacher_qualifications": Checks(
        ("matr", "etat_empl", "workplace", "stat_eng", "corp_empl", "type_qualif"),
        not_null=("matr", "etat_empl", "workplace", "stat_eng", "corp_empl"),
    ),
    "qualification_report": Checks(
        (
            "matricule",
            "nom_legal",
            "tranche_age",
            "lieu_principal",
            "corp_empl",
            "qualification",
            "etat_empl",
            "statut_enseignant",
            "ordre_ens",
            "type_qualif",
        ),
        not_null=(
            "matricule",
            "nom_legal",
            "genre",
            "tranche_age",
            "lieu_principal",
            "corp_empl",
            "etat_empl",
            "statut_enseignant",
        ),
    ),
    "account_splits": Checks(("matr", "no_cheq", "no_seq", "no_cmpt")),
    "paid_hours_by_account": Checks(("an_budg", "no_cheq", "matr", "no_seq", "no_cmpt")),
    "admin_unit_names": Checks(("exer_fin", "current_lieu_trav")),
    "full_time_report": Checks(
        (
            "an_budg",
            "no_per",
            "no_cmpt",
            "cat_emploi",
            "corp_emploi",
            "unite_admin",
            "code_lieu_trav",
            "descr_unite_admin",
            "stat_eng",
            "type_remun",
        )
    ),
    "manager_schools": Checks(
        ("compte_authentification", "ecole"), not_null=("compte_authentification", "ecole")
    ),
    "workplaces": Checks(("lieu_trav",), not_null=("lieu_trav", "lieu_trav_desc")),
    # Seeds.
    "pmnt_zero_keep": Checks(unique=("code_pmnt",), not_null=("code_pmnt", "descr")),
    "ens_qualification": Checks(
        unique=("code",),
        not_null=("code", "descr", "is_qualified"),
        accepted={"is_qualified": [False, True]},
    ),
    "statut_enseignant": Checks(unique=("code",), not_null=("code", "statut")),
    "cibles_etc": Checks(unique=("an_budg",), not_null=("an_budg", "nb_hres_an", "nb_etc")),
    "adjust_nomen_unit_adm": Checks(
        unique=("current_lieu_trav",),
        not_null=("current_lieu_trav", "new_lieu_trav", "new_descr"),
    ),
}


def check_table(name: str, df: DataFrame) -> DataFrame:
    """One row per declared check of the table, with its number of failures."""
    checks = CHECKS[name]
    unique: dict[str, Sequence[str]] = {"key": checks.key} if checks.key else {}
    unique |= {column: [column] for column in checks.unique}
    return quality_report(df, unique, checks.not_null, checks.accepted, checks.ranges)
