"""All domain tables wired together, each built from the ones it needs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from boardroll.params import Params
from boardroll.plans import (
    absence_reports,
    absences,
    access,
    addresses,
    adults,
    employment,
    pay,
    qualifications,
    retirement,
    students,
)


class Board:
    """The tables and reports of a school board, lazily built and named as properties.

    ``inputs`` maps source, contract and seed names to DataFrames (``Sources`` is one).
    ``save`` writes a table that several steps read and returns it read back, so that it
    is computed once; without it every plan is lazy and is recomputed where it is reused.
    """

    def __init__(
        self,
        inputs: Mapping[str, DataFrame],
        params: Params,
        save: Callable[[DataFrame, str], DataFrame] | None = None,
    ) -> None:
        self.inputs = inputs
        self.params = params
        self._save = save
        self._saved: dict[str, DataFrame] = {}

    def shared(self, name: str) -> DataFrame:
        """A table read by several steps: written once if the board has a ``save``."""
        if self._save is None:
            return getattr(self, name)
        if name not in self._saved:
            self._saved[name] = self._save(getattr(self, name), name)
        return self._saved[name]

    # Absences.
    @cached_property
    def absence_events(self) -> DataFrame:
        events = self.inputs["i_gpm_e_abs"]
        return absences.absence_events(events, self.inputs["i_gpm_t_eco"], self.params)

    @cached_property
    def absence_reasons(self) -> DataFrame:
        return absences.absence_reasons(self.inputs["i_gpm_t_motif_abs"])

    @cached_property
    def absences_daily(self) -> DataFrame:
        return absences.absences_daily(
            self.absence_events,
            self.inputs["i_gpm_t_mat_grp"],
            self.absence_reasons,
            self.inputs["i_gpm_e_dan"],
            self.inputs["i_gpm_t_cal"],
            self.inputs["stg_fact_fiche_etapes"],
            self.params,
        )

    @cached_property
    def absence_sequences(self) -> DataFrame:
        return absences.absence_sequences(self.absences_daily, self.inputs["i_gpm_t_cal"], self.params)

    @cached_property
    def daily_students(self) -> DataFrame:
        return absences.daily_students(
            self.inputs["i_gpm_e_dan"],
            self.inputs["i_gpm_t_eco"],
            self.inputs["i_gpm_t_org_annee"],
            self.inputs["stg_fact_fiche_etapes"],
            self.params,
        )

    @cached_property
    def daily_grid(self) -> DataFrame:
        return absences.daily_grid(
            self.inputs["i_gpm_t_cal"], self.shared("absences_daily"), self.shared("daily_students"), self.params
        )

    @cached_property
    def padding(self) -> DataFrame:
        return absences.padding(self.daily_grid, self.shared("absences_daily"))

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return absences.daily_metrics(
            self.daily_grid, self.shared("absences_daily"), self.inputs["dim_mapper_schools"], self.params
        )

    @cached_property
    def daily_rate_report(self) -> DataFrame:
        return absence_reports.daily_rate_report(self.shared("daily_metrics"))

    @cached_property
    def term_rate_report(self) -> DataFrame:
        return absence_reports.term_rate_report(self.shared("daily_metrics"))

    @cached_property
    def kind_distribution_report(self) -> DataFrame:
        return absence_reports.kind_distribution_report(
            self.shared("absences_daily"), self.daily_grid, self.inputs["dim_mapper_schools"], self.params
        )

    @cached_property
    def subject_distribution_report(self) -> DataFrame:
        return absence_reports.subject_distribution_report(
            self.shared("absences_daily"),
            self.daily_grid,
            self.inputs["dim_mapper_schools"],
            self.inputs["stg_descr_mat"],
            self.params,
        )

    @cached_property
    def absence_filters_report(self) -> DataFrame:
        return absence_reports.absence_filters_report(self.shared("daily_metrics"), self.inputs["dim_mapper_schools"])

    @cached_property
    def long_absence_report(self) -> DataFrame:
        return absence_reports.long_absence_report(
            self.absence_sequences,
            self.inputs["i_gpm_e_ele"],
            self.inputs["i_gpm_e_dan"],
            self.inputs["dim_mapper_schools"],
            self.params,
        )

    # Pupils.
    @cached_property
    def diplomas(self) -> DataFrame:
        return students.diplomas(self.inputs["i_e_ri_mentions"], self.inputs["i_t_prog"])

    @cached_property
    def yearly_students(self) -> DataFrame:
        return students.yearly_students(
            self.inputs["spine"],
            self.inputs["i_gpm_e_dan"],
            self.inputs["dim_mapper_schools"],
            self.inputs["stg_type_mesure"],
            self.inputs["i_wl_descr"],
            self.params,
        )

    @cached_property
    def diploma_perimeter(self) -> DataFrame:
        return students.diploma_perimeter(self.yearly_students, self.params)

    @cached_property
    def semi_skilled_perimeter(self) -> DataFrame:
        return students.semi_skilled_perimeter(self.yearly_students, self.params)

    @cached_property
    def training_perimeter(self) -> DataFrame:
        return students.training_perimeter(self.yearly_students, self.params)

    @cached_property
    def yearly_addresses(self) -> DataFrame:
        return addresses.yearly_addresses(self.inputs["i_e_adr"], self.params)

    # Adult education.
    @cached_property
    def adult_students(self) -> DataFrame:
        return adults.adult_students(
            self.inputs["stg_populations_adultes"],
            self.inputs["i_e_ele_adultes"],
            self.inputs["i_e_adr_adultes"],
            self.inputs["i_t_wl_descr_adultes"],
        )

    @cached_property
    def adult_enrolments(self) -> DataFrame:
        return adults.adult_enrolments(
            self.inputs["stg_populations_adultes"],
            self.adult_students,
            self.inputs["i_e_freq_adultes"],
            self.inputs["i_t_prog_adultes"],
            self.inputs["i_t_wl_descr_adultes"],
            self.inputs["i_e_o_orghor_adultes"],
            self.inputs["i_t_ecocen_adultes"],
            self.params,
        )

    @cached_property
    def adult_headcount_report(self) -> DataFrame:
        return adults.adult_headcount_report(self.adult_enrolments, self.adult_students)

    @cached_property
    def general_success_rates(self) -> DataFrame:
        return adults.general_success_rates(self.adult_headcount_report, self.params)

    @cached_property
    def vocational_success_rates(self) -> DataFrame:
        return adults.vocational_success_rates(self.adult_headcount_report, self.params)

    @cached_property
    def general_success_list(self) -> DataFrame:
        return adults.general_success_list(self.adult_headcount_report, self.params)

    @cached_property
    def vocational_success_list(self) -> DataFrame:
        return adults.vocational_success_list(self.adult_headcount_report, self.params)

    # Human resources.
    @cached_property
    def job_class_names(self) -> DataFrame:
        return employment.job_class_names(self.inputs["i_pai_tab_corp_empl"])

    @cached_property
    def activity_history(self) -> DataFrame:
        return employment.activity_history(self.inputs["i_pai_hemp"], self.params)

    @cached_property
    def main_job_history(self) -> DataFrame:
        return employment.main_job_history(self.inputs["i_hcha_pai_dos_empl"], self.params)

    @cached_property
    def main_job_yearly(self) -> DataFrame:
        return employment.main_job_yearly(self.main_job_history, self.params)

    @cached_property
    def activity_yearly(self) -> DataFrame:
        return employment.activity_yearly(
            self.shared("activity_history"),
            self.inputs["dim_employment_status_yearly"],
            self.main_job_yearly,
            self.inputs["i_pai_dos_empl"],
            self.params,
        )

    @cached_property
    def activity_current(self) -> DataFrame:
        return employment.activity_current(self.activity_yearly, self.inputs["dim_employees"], self.params)

    @cached_property
    def seniority(self) -> DataFrame:
        return employment.seniority(
            self.shared("activity_history"),
            self.inputs["dim_employment_status_yearly"],
            self.inputs["dim_engagement_status_yearly"],
            self.main_job_history,
            self.inputs["dim_mapper_job_group"],
            self.params,
        )

    @cached_property
    def retirements(self) -> DataFrame:
        return retirement.retirements(
            self.shared("activity_history"), self.inputs["dim_employment_status_yearly"], self.inputs["dim_employees"]
        )

    @cached_property
    def retirement_curve(self) -> DataFrame:
        return retirement.survival_curve(self.inputs["i_pai_dos"], self.shared("retirements"))

    @cached_property
    def retirement_forecasts(self) -> DataFrame:
        return retirement.retirement_forecasts(
            self.shared("activity_current"),
            self.shared("retirements"),
            self.inputs["i_pai_dos"],
            self.inputs["dim_mapper_job_group"],
            self.retirement_curve,
            self.params,
        )

    @cached_property
    def active_age_report(self) -> DataFrame:
        return retirement.active_age_report(
            self.shared("activity_current"),
            self.shared("retirements"),
            self.inputs["dim_employees"],
            self.inputs["dim_mapper_job_group"],
            self.params,
        )

    @cached_property
    def retirement_age_report(self) -> DataFrame:
        return retirement.retirement_age_report(
            self.shared("retirements"), self.inputs["dim_mapper_job_group"], self.inputs["i_pai_dos"], self.params
        )

    @cached_property
    def observed_and_forecast_report(self) -> DataFrame:
        return retirement.observed_and_forecast_report(
            self.retirement_forecasts, self.shared("retirements"), self.inputs["dim_mapper_job_group"], self.params
        )

    @cached_property
    def survival_curve_report(self) -> DataFrame:
        return retirement.survival_curve_report(self.retirement_curve)

    @cached_property
    def retirement_filters_report(self) -> DataFrame:
        return retirement.retirement_filters_report(
            self.active_age_report,
            self.retirement_age_report,
            self.inputs["dim_employment_status_yearly"],
            self.inputs["dim_engagement_status_yearly"],
            self.inputs["dim_mapper_workplace"],
        )

    @cached_property
    def teacher_qualifications(self) -> DataFrame:
        return qualifications.teacher_qualifications(
            self.shared("activity_current"), self.inputs["etat_empl"], self.inputs["i_pai_qualif"], self.params
        )

    @cached_property
    def qualification_report(self) -> DataFrame:
        return qualifications.qualification_report(
            self.teacher_qualifications,
            self.inputs["dim_employees"],
            self.inputs["dim_mapper_workplace"],
            self.inputs["etat_empl"],
            self.job_class_names,
            self.inputs["statut_enseignant"],
            self.inputs["ens_qualification"],
            self.params,
            self.inputs["secteur"],
        )

    # Pay.
    @cached_property
    def employment_perimeter(self) -> DataFrame:
        return pay.employment_perimeter(
            self.inputs["i_pai_hemp"],
            self.inputs["i_pai_tab_corp_empl_date"],
            self.inputs["i_pai_tab_etat_empl"],
            self.params,
        )

    @cached_property
    def account_splits(self) -> DataFrame:
        return pay.account_splits(self.inputs["i_pai_hchq_pmnt_dist_cmpt"], self.params)

    @cached_property
    def paid_hours_by_account(self) -> DataFrame:
        return pay.paid_hours_by_account(
            self.inputs["i_pai_tab_cal_per"],
            self.inputs["i_pai_hchq"],
            self.inputs["i_pai_hchq_pmnt"],
            self.employment_perimeter,
            self.inputs["i_pai_tab_pmnt"],
            self.inputs["i_pai_tab_mot_abs"],
            self.account_splits,
            self.inputs["pmnt_zero_keep"],
            self.params,
        )

    @cached_property
    def admin_unit_names(self) -> DataFrame:
        return pay.admin_unit_names(self.inputs["i_fin_nomen_unit_adm"], self.inputs["adjust_nomen_unit_adm"])

    @cached_property
    def full_time_report(self) -> DataFrame:
        return pay.full_time_report(
            self.paid_hours_by_account,
            self.admin_unit_names,
            self.inputs["dim_mapper_job_group"],
            self.inputs["i_pai_tab_corp_empl"],
            self.inputs["i_pai_tab_stat_eng"],
        )

    # Access and the staff list.
    @cached_property
    def manager_schools(self) -> DataFrame:
        return access.manager_schools(self.inputs["i_identite"])

    @cached_property
    def workplaces(self) -> DataFrame:
        return access.workplaces(self.inputs["i_pai_tab_lieu_trav"])
