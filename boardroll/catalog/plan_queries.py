"""Domain tables and reports run on the derived inputs; one entry per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardroll.catalog.derived import PARAMS, Derived
from boardroll.plans import staff_list, students
from boardroll.plans.board import Board
from boardroll.plans.checks import CHECKS, check_table
from boardroll.sources import SOURCES, Kept, code_labels, project

# Which derived input stands for which source, contract or seed of the jobs.
INPUTS = {
    "i_gpm_e_abs": "src_absences",
    "i_gpm_t_eco": "src_school_years",
    "i_gpm_t_motif_abs": "src_reasons",
    "i_gpm_t_mat_grp": "src_subject_groups",
    "i_gpm_e_dan": "src_pupils",
    "i_gpm_t_cal": "src_calendar",
    "stg_fact_fiche_etapes": "src_terms",
    "i_gpm_t_org_annee": "src_year_spans",
    "dim_mapper_schools": "src_schools",
    "stg_descr_mat": "src_subject_names",
    "i_gpm_e_ele": "src_people",
    "i_e_ri_mentions": "src_mentions",
    "i_t_prog": "src_programmes",
    "spine": "src_spine",
    "stg_type_mesure": "src_measures",
    "i_wl_descr": "src_measure_names",
    "i_e_adr": "src_addresses",
    "stg_populations_adultes": "src_populations",
    "i_e_ele_adultes": "src_adults",
    "i_e_adr_adultes": "src_adult_addresses",
    "i_t_wl_descr_adultes": "src_codes",
    "i_e_freq_adultes": "src_enrolments",
    "i_t_prog_adultes": "src_adult_programmes",
    "i_e_o_orghor_adultes": "src_timetables",
    "i_t_ecocen_adultes": "src_centres",
    "i_pai_tab_corp_empl": "src_job_classes",
    "i_pai_hemp": "src_jobs",
    "i_hcha_pai_dos_empl": "src_job_log",
    "dim_employment_status_yearly": "src_statuses",
    "i_pai_dos_empl": "src_current_jobs",
    "dim_employees": "src_employees",
    "dim_engagement_status_yearly": "src_engagements",
    "dim_mapper_job_group": "src_job_groups",
    "i_pai_dos": "src_files",
    "dim_mapper_workplace": "src_workplaces",
    "etat_empl": "src_status_seed",
    "i_pai_qualif": "src_qualifications",
    "statut_enseignant": "src_teacher_statuses",
    "ens_qualification": "src_qualification_names",
    "secteur": "src_sectors",
    "i_pai_tab_corp_empl_date": "src_dated_classes",
    "i_pai_tab_etat_empl": "src_special_statuses",
    "i_pai_hchq_pmnt_dist_cmpt": "src_splits",
    "i_pai_tab_cal_per": "src_periods",
    "i_pai_hchq": "src_cheques",
    "i_pai_hchq_pmnt": "src_payments",
    "i_pai_tab_pmnt": "src_payment_codes",
    "i_pai_tab_mot_abs": "src_absence_reasons",
    "pmnt_zero_keep": "src_kept_codes",
    "i_fin_nomen_unit_adm": "src_units",
    "adjust_nomen_unit_adm": "src_unit_remap",
    "i_pai_tab_stat_eng": "src_engagement_names",
    "i_identite": "src_accounts",
    "i_pai_tab_lieu_trav": "src_places",
    "emp_actif_report_emp_actif": "src_staff",
}

STAFF_CHOICES = {
    "workplace_name": ["NATION_1", "NATION_2", "NATION_7", "NATION_12"],
    "job_class": ["BUILDING", "MACHINERY", "HOUSEHOLD"],
    "type": ["T0", "T1"],
    "employment_status_name": ["Actif"],
    "is_current": ["Oui"],
    "job_department": ["Dép. 1", "Dép. 2", "Dép. 3"],
}
STAFF_SEARCH = "R#0000"
ADAPTED = "ordre_ens = '3' AND grp_rep NOT IN ('G1') AND classe IN ('A', 'B', 'C', 'D')"


class DerivedInputs(Mapping[str, DataFrame]):
    """The derived inputs under the names the jobs ask for.

    What stands for a source table is first given the table's upstream column names, and
    then read as that source would be: projected, renamed and typed.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._derived = Derived(spark, folder)

    def upstream(self, name: str) -> DataFrame:
        """A source table as its database would hold it; columns not derived are null."""
        table, taken = self._derived[INPUTS[name]], {}
        for column in SOURCES[name].columns:
            if column.name in table.columns:
                taken[column.upstream] = F.col(column.name)
            else:
                taken.setdefault(column.upstream, F.lit(None))
        return table.select(*[value.alias(upstream) for upstream, value in taken.items()])

    def held(self, name: str) -> list[str]:
        """The declared columns of a source table that are derived here."""
        derived = self._derived[INPUTS[name]].columns
        return [c.name for c in SOURCES[name].columns if c.name in derived]

    def __getitem__(self, name: str) -> DataFrame:
        if name in SOURCES:
            return project(self.upstream(name), SOURCES[name])
        return self._derived[INPUTS[name]]

    def __iter__(self):
        return iter(INPUTS)

    def __len__(self) -> int:
        return len(INPUTS)


def comparable(df: DataFrame, places: int = 6) -> DataFrame:
    """Round doubles and decimals, so that two engines agree on the last digits."""
    exact = (T.DoubleType, T.FloatType, T.DecimalType)
    return df.select(
        *[
            F.round(F.col(f.name).cast("double"), places).alias(f.name)
            if isinstance(f.dataType, exact)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _population(board: Board, predicate: str | None) -> DataFrame:
    inputs = board.inputs
    return students.population(
        inputs["i_gpm_e_dan"],
        inputs["i_gpm_t_eco"],
        inputs["i_gpm_e_ele"],
        F.expr(predicate) if predicate else None,
    )


def _staff_slicers(report: DataFrame) -> DataFrame:
    lists = [
        staff_list.slicer_values(report, c).select(F.lit(c).alias("slicer"), F.col(c).alias("value"))
        for c in staff_list.SLICERS
    ]
    all_lists = lists[0]
    for values in lists[1:]:
        all_lists = all_lists.unionByName(values)
    return all_lists


STAFF = "emp_actif_report_emp_actif"

# Jobs that take a site's choice beside their inputs.
CHOSEN: dict[str, Callable[[Board], DataFrame]] = {
    "population_all": lambda b: _population(b, None),
    "population_adapted": lambda b: _population(b, ADAPTED),
    "success_reason_labels": lambda b: code_labels(
        b.adult_headcount_report, "desc_raison_depart", "raison_depart", ["22", "12", "04", "2"]
    ),
    "staff_detail": lambda b: staff_list.staff_detail(b.inputs[STAFF], STAFF_CHOICES, STAFF_SEARCH),
    "staff_count": lambda b: staff_list.staff_count(b.inputs[STAFF], STAFF_CHOICES),
    "staff_slicers": lambda b: _staff_slicers(b.inputs[STAFF]),
}

def _checked(name: str) -> Callable[[Board], DataFrame]:
    """The table's checks; it is kept only if they read it more than once."""
    return lambda board: check_table(name, board.shared(name) if CHECKS[name].passes > 1 else getattr(board, name))


TABLES = [name for name, member in vars(Board).items() if isinstance(member, cached_property)]
CHECKED = [name for name in CHECKS if name in TABLES]
"""Tables whose declared checks are registered, each as a query of its own."""

CHOSEN |= {f"checks_of_{name}": _checked(name) for name in CHECKED}

DATABASES = sorted({source.database for source in SOURCES.values()})


def _profile(database: str) -> Callable[[Board], DataFrame]:
    """Filled values per column of a database's inputs, as read under their upstream names."""

    def profile(board: Board) -> DataFrame:
        parts = []
        for name in [n for n in INPUTS if n in SOURCES and SOURCES[n].database == database]:
            table = board.inputs[name].select(*board.inputs.held(name))
            counted = table.agg(*[F.count(c).alias(c) for c in table.columns])
            names = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values")) for c in table.columns])
            parts.append(counted.select(F.lit(name).alias("input"), F.inline(names)))
        profiled = parts[0]
        for part in parts[1:]:
            profiled = profiled.unionByName(part)
        return profiled

    return profile


CHOSEN |= {f"sources_of_{database}": _profile(database) for database in DATABASES}
PLANS = [*TABLES, *CHOSEN]


def plan_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
        def query(spark: SparkSession, folder: str) -> DataFrame:
            board = Board(DerivedInputs(spark, folder), PARAMS, Kept().save)
            table = CHOSEN[name](board) if name in CHOSEN else getattr(board, name)
            return comparable(table)

        return query

    return {name: run(name) for name in PLANS}
