"""The domain tables as DuckDB SQL, written apart from the Spark jobs.

Each entry is one CTE; a query is that CTE and everything it names, over the derived
inputs. Where a job takes a shortcut (a collapsed log, a chunked scan, a pre-aggregated
grid) the SQL here takes the long way, so that agreement says something.
"""

from __future__ import annotations

import re

from boardroll.catalog.derived import PARAMS, RULES, duckdb_sql
from boardroll.catalog.plan_queries import CHECKED, DATABASES, INPUTS, STAFF_CHOICES, STAFF_SEARCH
from boardroll.functions import NULL_MARKER
from boardroll.plans.checks import CHECKS
from boardroll.sources import SOURCES

AS_OF = f"DATE '{PARAMS.as_of}'"
YEAR = PARAMS.current_year
PAY_FROM = f"DATE '{PARAMS.pay_from}'"
WEEKDAYS = "['dimanche', 'lundi', 'mardi', 'mercredi', 'jeudi', 'vendredi', 'samedi']"


def sy(day: str, pivot: int = 7) -> str:
    return f"CAST(year({day}) - CASE WHEN month({day}) < {pivot} THEN 1 ELSE 0 END AS INTEGER)"


def weekday(day: str) -> str:
    return f"{WEEKDAYS}[dayofweek({day}) + 1]"


def key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_MARKER}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def weekdays(start: str, end: str) -> str:
    def upto(day: str) -> str:
        n = f"(CAST({day} AS DATE) - DATE '1900-01-01')"
        return f"(({n} // 7) * 5 + least({n} % 7 + 1, 5))"

    return f"({upto(end)} - {upto(start)})"


def dash(column: str) -> str:
    return f"CASE WHEN trim(coalesce({column}, '')) = '' THEN '-' ELSE {column} END"


FILTER_KEY = key("annee", "school_friendly_name", "etape_friendly", "event_kind", "groupe")
SLICER_KEY = key("genre", "job_group_category", "lieu_trav", "stat_eng", "etat")
TERM = "CASE WHEN etape IN ('1', '2', '3') THEN CAST(etape AS INTEGER) ELSE 0 END"
GROUP = "coalesce(CASE WHEN ordre_ens = '4' THEN dist ELSE grp_rep END, '-')"

_FILTERS = {"school_friendly_name": "Tout le CSS", "groupe": "Tout", "etape_friendly": "Tout"}


def _levels(source: str, fixed: str, *dims: str) -> str:
    """Sums of ``source`` at every level: one plain grouping per set of totals, united."""
    parts = []
    for mask in range(2 ** len(dims)):
        shown = [f"'{_FILTERS[d]}' AS {d}" if mask >> k & 1 else d for k, d in enumerate(dims)]
        columns = ", ".join([fixed, *shown])
        parts.append(f"SELECT {columns}, sum(rate * n) AS wn, sum(n) AS n FROM {source} GROUP BY ALL")
    return " UNION ALL ".join(parts)


ABSENCES = {
    "absence_events": f"""
        SELECT date_abs, fiche, id_eco, motif_abs, remarque, id_mat_grp FROM src_absences
        WHERE id_eco IN (SELECT id_eco FROM src_school_years WHERE annee >= {YEAR - PARAMS.years_of_absences})""",
    "absence_reasons": """
        SELECT DISTINCT id_eco, motif_abs, descr AS description_abs,
               CASE WHEN cpt_abs <= 2 THEN 'Absence' END AS category_abs,
               CASE WHEN cpt_abs <= 2 THEN 1 ELSE 0 END AS is_absence
        FROM src_reasons WHERE cpt_abs IS NOT NULL AND cpt_abs <> 3""",
    "day_plan": """
        SELECT id_eco, date_evenement AS date_abs, grille,
               """ + " + ".join(f"CAST(count(per_{i:02d}) > 0 AS INTEGER)" for i in range(1, 21)) + """ AS n_expected
        FROM src_calendar WHERE jour_cycle = 'J' GROUP BY ALL""",
    "missed": f"""
        SELECT e.date_abs, e.fiche, e.id_eco, coalesce(g.mat, '-') AS code_matiere, r.is_absence,
               p.grille, {GROUP} AS groupe, d.n_expected, count(*) AS n,
               min(r.description_abs) AS description, min(e.remarque) AS remarque
        FROM absence_events e
        JOIN absence_reasons r ON r.id_eco = e.id_eco AND r.motif_abs = e.motif_abs
        JOIN src_pupils p ON p.fiche = e.fiche AND p.id_eco = e.id_eco
        JOIN day_plan d ON d.id_eco = e.id_eco AND d.date_abs = e.date_abs AND d.grille = p.grille
        LEFT JOIN src_subject_groups g ON g.id_eco = e.id_eco AND g.id_mat_grp = e.id_mat_grp
        WHERE d.n_expected > 0 GROUP BY ALL""",
    "missed_days": """
        SELECT date_abs, fiche, id_eco, sum(n) * 100.0 / max(n_expected) AS by_day FROM missed GROUP BY ALL""",
    "absences_daily": f"""
        SELECT {sy('m.date_abs')} AS school_year, m.date_abs, {weekday('m.date_abs')} AS jour_semaine, m.fiche, m.id_eco,
               m.groupe, m.code_matiere, m.grille, m.event_kind, 0 AS is_aggregate_kind, m.is_absence,
               m.event_description, m.remarque,
               round(least(m.by_subject, 100.0), 6) AS prct_observed_periods_over_expected,
               round(least(m.by_day, 100.0), 6) AS prct_observed_daily_over_expected,
               t.etape, t.etape_description, t.seq_etape
        FROM (SELECT m.date_abs, m.fiche, m.id_eco, m.groupe, m.code_matiere, max(m.grille) AS grille,
                     CASE WHEN d.by_day >= 100 THEN 'Journée complète' ELSE 'Périodes' END AS event_kind,
                     min(m.is_absence) AS is_absence, min(m.description) AS event_description,
                     min(m.remarque) AS remarque, CAST(sum(m.n * 100.0 / m.n_expected) AS DOUBLE) AS by_subject,
                     CAST(sum(d.by_day) AS DOUBLE) AS by_day
              FROM missed m JOIN missed_days d ON d.date_abs = m.date_abs AND d.fiche = m.fiche AND d.id_eco = m.id_eco
              GROUP BY m.date_abs, m.fiche, m.id_eco, m.groupe, m.code_matiere, d.by_day >= 100) AS m
        LEFT JOIN src_terms t ON t.fiche = m.fiche AND t.id_eco = m.id_eco
             AND m.date_abs >= t.date_debut AND m.date_abs <= t.date_fin""",
    "numbered_days": f"""
        SELECT id_eco, grille, date_evenement AS date_abs,
               row_number() OVER (PARTITION BY id_eco, grille, {sy('date_evenement')} ORDER BY date_evenement) AS day_id
        FROM src_calendar WHERE jour_cycle = 'J' AND date_evenement <= {AS_OF}""",
    "absent_days": """
        SELECT a.*, n.day_id,
               n.day_id - dense_rank() OVER (PARTITION BY a.school_year, a.id_eco, a.fiche, a.event_kind ORDER BY n.day_id) AS run
        FROM absences_daily a JOIN numbered_days n ON n.id_eco = a.id_eco AND n.grille = a.grille AND n.date_abs = a.date_abs""",
    "absence_sequences": """
        SELECT school_year, fiche, id_eco, event_kind,
               last(event_description ORDER BY day_id, code_matiere) AS last_event_description,
               last(remarque ORDER BY day_id, code_matiere) AS last_remarque,
               dense_rank() OVER (PARTITION BY school_year, fiche, id_eco, event_kind ORDER BY run) - 1 AS absence_sequence_id,
               min(date_abs) AS event_start_date, max(date_abs) AS event_end_date,
               CAST(max(day_id) - min(day_id) + 1 AS INTEGER) AS events_sequence_length,
               min(etape) AS etape, min(etape_description) AS etape_description, min(seq_etape) AS seq_etape
        FROM absent_days GROUP BY school_year, fiche, id_eco, event_kind, run""",
    "stays": f"""
        SELECT p.fiche, p.id_eco, {GROUP} AS groupe, coalesce(p.grille, 'unknown') AS grille,
               p.date_debut AS enters, coalesce(p.date_depart, make_date(y.annee + 1, 6, 30)) AS leaves,
               CAST(t.etape AS INTEGER) AS etape, t.date_debut AS opens, t.date_fin AS closes
        FROM src_pupils p JOIN src_school_years y ON y.id_eco = p.id_eco
        JOIN src_terms t ON t.fiche = p.fiche AND t.id_eco = p.id_eco AND t.etape IN ('1', '2', '3')
        WHERE p.date_debut <= {AS_OF}
          AND p.date_debut <= t.date_fin AND coalesce(p.date_depart, make_date(y.annee + 1, 6, 30)) >= t.date_debut""",
    "stay_days": """
        SELECT id_eco, groupe, grille, etape, date_evenement,
               coalesce(min(opens) FILTER (side = 1), min(opens)) AS etape_date_debut,
               coalesce(max(closes) FILTER (side = 1), max(closes)) AS etape_date_fin
        FROM (SELECT *, enters AS date_evenement, 1 AS side FROM stays
              UNION ALL SELECT *, leaves, -1 FROM stays) AS moves GROUP BY ALL""",
    "daily_students": """
        SELECT d.date_evenement, d.id_eco, d.groupe, d.grille, d.etape, d.etape_date_debut, d.etape_date_fin,
               count(DISTINCT s.fiche) FILTER (s.enters <= d.date_evenement)
               - count(DISTINCT s.fiche) FILTER (s.leaves <= d.date_evenement) AS n_students_daily
        FROM stay_days d JOIN stays s ON s.id_eco = d.id_eco AND s.groupe = d.groupe AND s.grille = d.grille AND s.etape = d.etape
        GROUP BY ALL""",
    "report_days": f"""
        SELECT id_eco, grille, date_evenement, max(CASE WHEN jour_cycle = 'J' THEN 1 ELSE 0 END) AS is_school_day
        FROM src_calendar WHERE date_evenement <= {AS_OF} AND year(date_evenement) >= {YEAR - PARAMS.years_in_report}
        GROUP BY ALL""",
    "group_subjects": "SELECT DISTINCT id_eco, groupe, code_matiere FROM absences_daily",
    "grid_cells": """
        SELECT id_eco, groupe, grille, etape, min(etape_date_debut) AS etape_date_debut, max(etape_date_fin) AS etape_date_fin
        FROM daily_students GROUP BY ALL""",
    "known_days": """
        SELECT s.* FROM daily_students s JOIN report_days USING (id_eco, grille, date_evenement)""",
    "daily_grid": f"""
        SELECT d.id_eco, d.grille, d.date_evenement, d.is_school_day, c.groupe, c.etape, c.etape_date_debut, c.etape_date_fin,
               (SELECT count(*) FROM group_subjects g WHERE g.id_eco = d.id_eco AND g.groupe = c.groupe) AS n_subjects,
               k.n_students_daily, {weekday('d.date_evenement')} AS jour_semaine
        FROM report_days d JOIN grid_cells c ON c.id_eco = d.id_eco AND c.grille = d.grille
        ASOF LEFT JOIN known_days k ON k.id_eco = d.id_eco AND k.grille = d.grille AND k.groupe = c.groupe
             AND k.etape = c.etape AND k.date_evenement <= d.date_evenement
        WHERE d.date_evenement BETWEEN c.etape_date_debut AND c.etape_date_fin
          AND EXISTS (SELECT 1 FROM group_subjects g WHERE g.id_eco = d.id_eco AND g.groupe = c.groupe)""",
    "padding": """
        SELECT g.id_eco, g.date_evenement, g.jour_semaine, g.groupe, g.grille, g.is_school_day, kinds.event_kind,
               s.code_matiere, g.etape, g.etape_date_debut, g.etape_date_fin, g.n_students_daily
        FROM daily_grid g JOIN group_subjects s ON s.id_eco = g.id_eco AND s.groupe = g.groupe
        JOIN (SELECT DISTINCT event_kind FROM absences_daily) AS kinds ON true""",
    "absent_cells": f"""
        SELECT id_eco, date_abs AS date_evenement, groupe, grille, {TERM} AS etape, event_kind, count(DISTINCT fiche) AS n_absent
        FROM absences_daily GROUP BY ALL""",
    "absent_subjects": f"""
        SELECT id_eco, date_abs AS date_evenement, groupe, {TERM} AS etape, event_kind, code_matiere, count(DISTINCT fiche) AS n_events_matiere
        FROM absences_daily GROUP BY ALL""",
    "padded_totals": """
        SELECT p.id_eco, p.date_evenement, p.jour_semaine, p.groupe, p.etape, p.event_kind,
               CAST(sum(coalesce(a.n_absent, 0)) AS BIGINT) AS n_events, CAST(sum(p.n_students_daily) AS BIGINT) AS n_students_daily
        FROM padding p LEFT JOIN absent_cells a ON a.id_eco = p.id_eco AND a.date_evenement = p.date_evenement
             AND a.groupe = p.groupe AND a.grille = p.grille AND a.etape = p.etape AND a.event_kind = p.event_kind
        WHERE p.is_school_day = 1 GROUP BY ALL HAVING sum(p.n_students_daily) > 0""",
    "raw_metrics": """
        SELECT e.annee, e.school_friendly_name, p.date_evenement, p.jour_semaine, p.groupe,
               coalesce(s.code_matiere, '-') AS code_matiere,
               'étape : ' || CASE p.etape WHEN 0 THEN 'inconnue' ELSE CAST(p.etape AS VARCHAR) END AS etape_friendly,
               p.event_kind, p.n_events, s.n_events_matiere, p.n_students_daily,
               least(CAST(p.n_events AS DOUBLE) / p.n_students_daily, 1.0) AS absence_rate, p.id_eco, e.eco
        FROM padded_totals p LEFT JOIN absent_subjects s ON s.id_eco = p.id_eco AND s.date_evenement = p.date_evenement
             AND s.groupe = p.groupe AND s.etape = p.etape AND s.event_kind = p.event_kind
        LEFT JOIN src_schools e ON e.id_eco = p.id_eco""",
    "daily_metrics": "SELECT * REPLACE (round(absence_rate, 6) AS absence_rate) FROM raw_metrics",
    "rate_cells": """
        SELECT annee, coalesce(school_friendly_name, 'inconnu') AS school_friendly_name, groupe, etape_friendly, date_evenement,
               jour_semaine, event_kind, max(n_events) AS n_events, max(n_students_daily) AS n, max(absence_rate) AS rate
        FROM raw_metrics GROUP BY ALL""",
    "metric_cells": """
        SELECT annee, coalesce(school_friendly_name, 'inconnu') AS school_friendly_name, groupe, etape_friendly, event_kind,
               absence_rate AS rate, n_students_daily AS n FROM raw_metrics""",
    "daily_rate_report": f"""
        SELECT {FILTER_KEY} AS filter_key, jour_semaine, date_evenement, CAST(total.n_events AS BIGINT) AS n_events,
               round(total.wn / total.n, 6) AS absence_rate, CAST(total.n AS BIGINT) AS n_students_daily,
               round(board.wn / board.n, 6) AS absence_rate_css, round(school.wn / school.n, 6) AS avg_absence_rate_school,
               round(weekday.wn / weekday.n, 6) AS avg_absence_rate_jour
        FROM ({_levels("rate_cells", "annee, date_evenement, jour_semaine, event_kind, sum(n_events) AS n_events", *_FILTERS)}) AS total
        LEFT JOIN ({_levels("rate_cells", "annee, date_evenement, event_kind", "etape_friendly")}) AS board
          USING (annee, date_evenement, event_kind, etape_friendly)
        LEFT JOIN ({_levels("rate_cells", "annee, event_kind", "school_friendly_name", "etape_friendly")}) AS school
          USING (annee, event_kind, school_friendly_name, etape_friendly)
        LEFT JOIN ({_levels("rate_cells", "annee, jour_semaine, event_kind", *_FILTERS)}) AS weekday
          USING (annee, jour_semaine, event_kind, school_friendly_name, groupe, etape_friendly)""",
    "term_rate_report": f"""
        SELECT {FILTER_KEY} AS filter_key, etape_friendly, round(term.wn / term.n, 6) AS avg_absence_rate_etape,
               round(board.wn / board.n, 6) AS avg_absence_rate_etape_css, round(school.wn / school.n, 6) AS avg_absence_rate_school
        FROM ({_levels("metric_cells", "annee, etape_friendly, event_kind", "school_friendly_name", "groupe")}) AS term
        LEFT JOIN ({_levels("metric_cells", "annee, etape_friendly, event_kind")}) AS board USING (annee, etape_friendly, event_kind)
        LEFT JOIN ({_levels("metric_cells", "annee, event_kind", "school_friendly_name", "groupe")}) AS school
          USING (annee, event_kind, school_friendly_name, groupe)""",
    "grid_absences": f"""
        SELECT a.date_abs AS date_evenement, g.jour_semaine, a.groupe, 'étape : ' || CAST(g.etape AS VARCHAR) AS etape_friendly,
               a.event_kind, a.event_description, a.code_matiere, a.id_eco, e.annee, e.school_friendly_name
        FROM absences_daily a
        JOIN daily_grid g ON g.id_eco = a.id_eco AND g.date_evenement = a.date_abs AND g.groupe = a.groupe AND g.grille = a.grille
             AND g.etape = CASE WHEN a.etape IN ('1', '2', '3') THEN CAST(a.etape AS INTEGER) ELSE 0 END AND g.is_school_day = 1
        LEFT JOIN src_schools e ON e.id_eco = a.id_eco
        WHERE a.school_year >= {YEAR - PARAMS.years_in_report}""",
    "named_absences": """
        SELECT * REPLACE (coalesce(school_friendly_name, 'inconnu') AS school_friendly_name) FROM grid_absences""",
    "kind_cube": """
        SELECT annee, coalesce(school_friendly_name, 'Tout le CSS') AS school_friendly_name, coalesce(groupe, 'Tout') AS groupe,
               coalesce(etape_friendly, 'Tout') AS etape_friendly, date_evenement, jour_semaine, event_kind, event_description,
               count(*) AS n_events
        FROM named_absences
        GROUP BY annee, date_evenement, jour_semaine, event_kind, event_description, CUBE (school_friendly_name, groupe, etape_friendly)""",
    "kind_distribution_report": f"""
        SELECT {FILTER_KEY} AS filter_key, date_evenement, jour_semaine, event_description, n_events FROM kind_cube""",
    "described_subjects": """
        SELECT s.annee, n.mat, n.description_abreg FROM src_subject_names n JOIN src_schools s ON s.id_eco = n.id_eco
        QUALIFY row_number() OVER (PARTITION BY s.annee, n.mat ORDER BY n.id_eco DESC) = 1""",
    "subject_cube": """
        SELECT annee, coalesce(school_friendly_name, 'Tout le CSS') AS school_friendly_name, coalesce(groupe, 'Tout') AS groupe,
               coalesce(etape_friendly, 'Tout') AS etape_friendly, date_evenement, jour_semaine, event_kind, code_matiere,
               description_abreg, count(*) AS n_events
        FROM named_absences a JOIN described_subjects d USING (annee) WHERE d.mat = a.code_matiere
        GROUP BY annee, date_evenement, jour_semaine, event_kind, code_matiere, description_abreg,
                 CUBE (school_friendly_name, groupe, etape_friendly)""",
    "subject_distribution_report": f"""
        SELECT {FILTER_KEY} AS filter_key, date_evenement, jour_semaine, code_matiere, description_abreg, n_events FROM subject_cube""",
    "filter_cube": """
        SELECT annee, eco, coalesce(groupe, 'Tout') AS groupe, coalesce(etape_friendly, 'Tout') AS etape_friendly, event_kind
        FROM (SELECT * REPLACE (coalesce(eco, 'inconnu') AS eco) FROM raw_metrics) AS known
        GROUP BY annee, event_kind, CUBE (eco, groupe, etape_friendly)""",
    "named_filters": """
        SELECT c.*, CASE WHEN c.eco IS NULL THEN 'Tout le CSS' ELSE coalesce(s.school_friendly_name, 'inconnu') END AS school_friendly_name
        FROM filter_cube c LEFT JOIN src_schools s ON s.eco = c.eco AND s.annee = c.annee""",
    "absence_filters_report": f"""
        SELECT annee, school_friendly_name, etape_friendly, event_kind, groupe, {FILTER_KEY} AS filter_key, eco FROM named_filters""",
    "long_absence_report": f"""
        SELECT e.school_friendly_name, e.annee_scolaire, s.fiche, w.nom || ' ' || w.pnom AS full_name, {GROUP} AS groupe,
               coalesce(s.etape_description, 'inconnue') AS etape_description, s.event_start_date, s.event_end_date,
               CASE WHEN s.events_sequence_length >= 30 THEN 'plus de 30 jours' WHEN s.events_sequence_length >= 20 THEN 'entre 20 et 29 jours'
                    WHEN s.events_sequence_length >= 10 THEN 'entre 10 et 19 jours' ELSE 'Moins de 10 jours' END AS events_sequence_interval,
               s.events_sequence_length, s.event_kind, s.last_event_description, s.last_remarque, s.id_eco, e.eco
        FROM absence_sequences s JOIN src_people w ON w.fiche = s.fiche
        JOIN src_pupils p ON p.fiche = s.fiche AND p.id_eco = s.id_eco LEFT JOIN src_schools e ON e.id_eco = s.id_eco
        WHERE s.school_year IN ({YEAR - 1}, {YEAR})""",
}

_GRADE = """CASE WHEN ordre_ens = '1' THEN 'Mat 4' WHEN ordre_ens = '2' THEN 'Mat 5'
    WHEN ordre_ens = '3' AND cycle_ref IN ('1', '2', '3') AND annee_cycle_ref IN ('1', '7', '2', '8')
      THEN 'Prim ' || CAST(2 * CAST(cycle_ref AS INTEGER) - CASE WHEN annee_cycle_ref IN ('1', '7') THEN 1 ELSE 0 END AS VARCHAR)
    WHEN ordre_ens = '4' AND cycle_ref = '1' AND annee_cycle_ref IN ('1', '7') THEN 'Sec 1'
    WHEN ordre_ens = '4' AND cycle_ref = '1' AND annee_cycle_ref IN ('2', '8') THEN 'Sec 2'
    WHEN ordre_ens = '4' AND (classe = '3' OR cycle_ref || annee_cycle_ref IN ('21', '27')) THEN 'Sec 3'
    WHEN ordre_ens = '4' AND (classe = '4' OR cycle_ref || annee_cycle_ref IN ('22', '28')) THEN 'Sec 4'
    WHEN ordre_ens = '4' AND (classe IN ('5', '7', '8') OR cycle_ref || annee_cycle_ref IN ('23', '29')) THEN 'Sec 5'
    ELSE '-' END"""

STUDENTS = {
    "diplomas": """
        SELECT m.fiche, m.code_perm, m.eco_cen_off, m.prog_charl,
               CAST(CAST(m.date_exec_sanct[1:4] AS INTEGER) - CASE WHEN m.date_exec_sanct[5:6] < '09' THEN 1 ELSE 0 END AS INTEGER) AS annee,
               CASE WHEN m.ind_reus_sanct_charl = 'O' THEN 1.0::DOUBLE ELSE 0.0 END AS ind_obtention, m.regime_sanct_charl,
               m.date_exec_sanct, m.date_obt_mention,
               CAST(p.type_diplome = 'DES' AS DOUBLE) AS indice_des, CAST(p.type_diplome = 'CFPT' AS DOUBLE) AS indice_cfpt,
               CAST(p.type_diplome = 'CFMS' AS DOUBLE) AS indice_cfms
        FROM src_mentions m JOIN src_programmes p ON p.prog_meq = m.prog_charl""",
    "yearly_students": f"""
        SELECT s.code_perm, s.id_eco, s.annee, s.fiche, s.population, s.eco, p.grp_rep, p.dist, e.school_friendly_name AS nom_ecole,
               p.ordre_ens, p.classe, p.class, p.cycle_ref, p.annee_cycle_ref,
               CASE coalesce(p.plan_interv_ehdaa, '') WHEN '' THEN 'Sans' WHEN '1' THEN 'Avec' ELSE p.plan_interv_ehdaa END AS plan_interv_ehdaa,
               {_GRADE} AS niveau_scolaire, p.difficulte,
               CASE WHEN p.ordre_ens = '3' AND p.cycle_ref || p.annee_cycle_ref || p.classe IN
                         ('17A', '18B', '18C', '27D', '28E', '28F', '37G', '38H', '38I') THEN 1
                    WHEN p.ordre_ens = '4' AND s.population LIKE '%régulier%' AND lag(p.classe) OVER pupil = p.classe THEN 1
                    WHEN p.ordre_ens = '2' AND lag(p.ordre_ens) OVER pupil = '2' THEN 1 ELSE 0 END AS is_doubleur,
               p.age_30_sept, p.type_parcours, p.type_prog_part AS type_programme_particulier,
               p.categ_prog_part AS categorie_programme_particulier, CASE WHEN p.categ_prog_part IS NULL THEN 0 ELSE 1 END AS is_ppp,
               m.type_mesure, coalesce(m.is_francisation, 0) AS is_francisation, d.cf_descr_abreg AS description_type_mesure, p.grille
        FROM src_spine s JOIN src_pupils p ON p.fiche = s.fiche AND p.id_eco = s.id_eco
        JOIN src_schools e ON e.id_eco = s.id_eco
        LEFT JOIN src_measures m ON m.fiche = s.fiche AND m.id_eco = s.id_eco
        LEFT JOIN src_measure_names d ON d.code = m.type_mesure AND d.nom_table = 'type_mesure'
        WHERE s.seqid = 1 AND s.annee >= {YEAR - PARAMS.years_of_students}
        WINDOW pupil AS (PARTITION BY s.fiche ORDER BY s.annee, s.id_eco)""",
    "diploma_perimeter": f"""
        SELECT fiche, id_eco FROM yearly_students WHERE niveau_scolaire = 'Sec 5' AND ordre_ens = '4' AND annee <= {YEAR}""",
    "semi_skilled_perimeter": f"""
        SELECT fiche, id_eco FROM yearly_students WHERE type_parcours = '08' AND ordre_ens = '4' AND annee <= {YEAR}""",
    "training_perimeter": f"""
        SELECT fiche, id_eco FROM yearly_students
        WHERE type_parcours = '07' AND cycle_ref = '2' AND annee_cycle_ref = '3' AND annee <= {YEAR}""",
    "population_all": """
        SELECT DISTINCT w.code_perm, p.id_eco, y.annee FROM src_pupils p
        LEFT JOIN src_school_years y ON y.id_eco = p.id_eco LEFT JOIN src_people w ON w.fiche = p.fiche""",
    "population_adapted": """
        SELECT DISTINCT w.code_perm, p.id_eco, y.annee FROM src_pupils p
        LEFT JOIN src_school_years y ON y.id_eco = p.id_eco LEFT JOIN src_people w ON w.fiche = p.fiche
        WHERE p.ordre_ens = '3' AND p.grp_rep <> 'G1' AND p.classe BETWEEN 'A' AND 'D'""",
    "counted_addresses": """
        SELECT a.* FROM src_addresses a
        WHERE a.date_effect <> a.date_fin AND (a.ind_envoi_meq = 1
          OR NOT EXISTS (SELECT 1 FROM src_addresses b WHERE b.fiche = a.fiche AND b.date_effect <> b.date_fin
                         AND b.date_effect < a.date_effect)
          OR NOT EXISTS (SELECT 1 FROM src_addresses b WHERE b.fiche = a.fiche AND b.date_effect <> b.date_fin
                         AND b.type_adr <> a.type_adr))""",
    "lived_addresses": f"""
        SELECT a.*, coalesce((SELECT min(b.date_effect) - 1 FROM counted_addresses b
                              WHERE b.fiche = a.fiche AND b.date_effect > a.date_effect), {AS_OF}) AS left_on
        FROM counted_addresses a""",
    "yearly_addresses": f"""
        SELECT fiche, annee, last.no_civ AS last_no_civ, last.orient_rue AS last_orient_rue, last.genre_rue AS last_genre_rue,
               last.rue AS last_rue, last.ville AS last_ville, last.code_post AS last_code_post, sept.no_civ AS no_civ_30sept,
               sept.orient_rue AS orient_rue_30sept, sept.genre_rue AS genre_rue_30sept, sept.rue AS rue_30sept,
               sept.ville AS ville__30sept, sept.code_post AS code_post_30sept
        FROM (SELECT a.fiche, CAST(y.y AS INTEGER) AS annee, arg_max(a, a.date_effect) AS last,
                     arg_max(a, a.date_effect) FILTER (make_date(y.y, 9, 30) BETWEEN a.date_effect AND a.left_on) AS sept
              FROM lived_addresses a JOIN (SELECT unnest(generate_series(1980, 2010)) AS y) AS y
                ON y.y >= {sy('a.date_effect')} AND y.y <= {sy('a.left_on', 9)}
              GROUP BY a.fiche, y.y) AS years""",
}


def _age(month: int) -> str:
    return (
        f"CAST(floor((make_date(p.annee, {month}, 30) - CAST(strptime(w.date_naissance, '%Y%m%d') AS DATE)) / 365.25) AS INTEGER)"
    )


def _age_band(age: str) -> str:
    return (
        f"CASE WHEN {age} >= 26 THEN '+ de 26 ans' WHEN {age} >= 22 THEN '22-25 ans' WHEN {age} >= 18 THEN '18-21 ans'"
        f" WHEN {age} >= 16 THEN '16-17 ans' WHEN {age} < 16 THEN '- de 16 ans' END"
    )


def _label(domain: str, code: str) -> str:
    return f"(SELECT max(c.cf_descr) FROM src_codes c WHERE c.nom_table = '{domain}' AND c.code = {code})"


GENERAL_DIMS = [
    "programme", "organisation_horaire", "desc_type_parcours", "service_enseignement", "nom_centre", "genre", "desc_raison_depart",
]
VOCATIONAL_DIMS = [
    "programme", "groupe_horaire", "desc_type_parcours", "condition_admission", "nom_centre", "genre", "desc_raison_depart",
]
_SUCCESS = "coalesce(TRY_CAST(raison_depart AS INTEGER) IN (2, 4, 12, 22), false)"


def _rates(dims: list[str], where: str) -> str:
    dashed = ", ".join(f"{dash(d)} AS {d}" for d in dims)
    labelled = ", ".join(f"coalesce({d}, 'Tous') AS {d}" for d in dims)
    return f"""
        SELECT *, round(nombre_total_by_reussite / nombre_total, 6) AS taux, {key('année', *dims)} AS id_filtre
        FROM (SELECT année, {labelled}, count(*) AS nombre_total, count(*) FILTER (ok) AS nombre_total_by_reussite
              FROM (SELECT année, {_SUCCESS} AS ok, {dashed} FROM adult_headcount_report WHERE etat_formation = 'Terminé' AND {where}) AS rows
              GROUP BY année, CUBE ({', '.join(dims)})) AS cube WHERE nombre_total_by_reussite > 0"""


def _list(dims: list[str], where: str) -> str:
    """One join with the on/off choice of each dimension instead of a mask."""
    pairs = "".join(
        f" JOIN (VALUES (true), (false)) AS t{i}(keep) ON true" for i in range(len(dims))
    )
    shown = ", ".join(
        f"CASE WHEN t{i}.keep THEN {dash('r.' + d)} ELSE 'Tous' END AS shown_{d}" for i, d in enumerate(dims)
    )
    listed = (
        "freq, prenom_nom, code_perm, fiche, population, année, annee_scolaire, eco_cen, bat, ind_transm, ville, interv_age, "
        "interv_age_fp, etat_formation, langue_maternelle, type_diplome, descr_raison_grat_scol, descr_motif_dep"
    )
    return f"""
        SELECT {', '.join(f'{d} AS {d}_bis' for d in dims)}, {key('année', *[f'shown_{d}' for d in dims])} AS id_filtre, {listed}
        FROM (SELECT r.*, {shown} FROM adult_headcount_report r{pairs}
              WHERE etat_formation = 'Terminé' AND {_SUCCESS} AND {where}) AS rows"""


ADULTS = {
    "adult_students": f"""
        SELECT p.code_perm, max(w.nom) AS nom, max(w.prenom) AS prenom,
               max(w.nom) || ', ' || max(w.prenom) || ' (' || p.code_perm || ' )' AS nom_prenom_code_perm,
               max(w.date_naissance) AS date_naissance, max(w.ind_lieu_naissance_n) AS ind_lieu_naissance_n,
               max(w.lang_matern) AS lang_matern, max({_label('X_Lang', 'w.lang_matern')}) AS desc_lang_matern,
               max(a.ville) AS ville, max(a.code_post) AS code_post,
               max(CASE w.genre WHEN 'M' THEN 'Garçon' WHEN 'F' THEN 'Fille' ELSE w.genre END) AS genre
        FROM src_populations p JOIN src_adults w ON w.code_perm = p.code_perm
        LEFT JOIN src_adult_addresses a ON a.fiche = p.fiche AND a.envoimeq = '1' AND a.date_fin = ''
        GROUP BY p.code_perm""",
    "adult_enrolments": f"""
        SELECT p.code_perm, p.fiche, f.client, p.population, p.annee, p.freq, '(' || f.eco_cen || ') - ' || c.descr AS nom_centre,
               {_age_band(_age(6))} AS interv_age, {_age_band(_age(9))} AS interv_age_fp, {_age(6)} AS age_30_juin, {_age(9)} AS age_30_septembre,
               f.org, f.eco_cen, f.bat, f.org_hor,
               CASE f.ind_transm WHEN 0 THEN 'Non-transmissible' WHEN 1 THEN 'Transmissible' END AS ind_transm,
               o.descr AS descr_org_hor, f.date_deb, f.date_fin_sifca, f.activ_form, f.donpers, f.cond_admiss,
               {_label('X_CondAdmiss', 'f.cond_admiss')} AS descr_condadmiss,
               CASE WHEN f.motif_depart <> '10' AND coalesce(f.date_fin_sifca, '') <> '' THEN 'Terminé' ELSE 'En cours' END AS etat_formation,
               f.prog, g.descr_prog, g.type_diplome, f.raison_grat_scol, {_label('X_RaisonGratScol', 'f.raison_grat_scol')} AS descr_raison_grat_scol,
               f.type_parcours, {_label('X_TypeParcours', 'f.type_parcours')} AS descr_type_parcours,
               f.service_enseign, {_label('X_ServiceEnseign', 'f.service_enseign')} AS descr_service_enseign,
               f.motif_depart, {_label('X_MotifDep', 'f.motif_depart')} AS descr_motif_dep,
               f.raison_depart, {_label('X_RaisonDepart', 'f.raison_depart')} AS desc_raison_depart
        FROM src_populations p JOIN adult_students w ON w.code_perm = p.code_perm
        JOIN src_enrolments f ON f.fiche = p.fiche AND f.annee = p.annee AND f.freq = p.freq
        JOIN src_centres c ON c.eco_cen = f.eco_cen
        LEFT JOIN src_adult_programmes g ON g.prog = f.prog
        LEFT JOIN src_timetables o ON o.eco_cen = f.eco_cen AND o.org_hor = f.org_hor
        WHERE p.annee >= {YEAR - PARAMS.years_of_adults}""",
    "adult_headcount_report": f"""
        SELECT e.nom_centre, e.freq, coalesce(w.prenom, '') || ' ' || coalesce(w.nom, '') AS prenom_nom, e.code_perm, e.fiche, e.population,
               e.annee AS année, CAST(e.annee AS VARCHAR) || '-' || CAST(e.annee + 1 AS VARCHAR) AS annee_scolaire, e.eco_cen, e.bat,
               e.ind_transm, w.ville, e.interv_age, e.interv_age_fp,
               CASE WHEN coalesce(e.activ_form, '') <> '' THEN e.activ_form WHEN coalesce(e.donpers, '') <> '' THEN e.donpers ELSE '-' END AS groupe_horaire,
               concat(e.cond_admiss, ' - ', e.descr_condadmiss) AS condition_admission, e.descr_org_hor AS organisation_horaire,
               e.etat_formation, w.genre, w.desc_lang_matern AS langue_maternelle, e.prog,
               coalesce(coalesce(e.prog, '') || ' - ' || e.descr_prog, '-') AS programme, e.type_diplome, e.raison_grat_scol,
               concat(e.raison_grat_scol, ' - ', e.descr_raison_grat_scol) AS descr_raison_grat_scol, e.type_parcours,
               concat(e.type_parcours, ' - ', e.descr_type_parcours) AS desc_type_parcours,
               coalesce(e.service_enseign, '') || ' - ' || e.descr_service_enseign AS service_enseignement, e.service_enseign,
               e.motif_depart, e.descr_motif_dep, e.raison_depart, coalesce(e.raison_depart, '') || ' - ' || e.desc_raison_depart AS desc_raison_depart
        FROM adult_enrolments e JOIN adult_students w ON w.code_perm = e.code_perm""",
    "general_success_rates": _rates(
        GENERAL_DIMS, "population = 'Formation générale des adultes' AND CAST(service_enseign AS INTEGER) NOT IN (6, 8)"
    ),
    "vocational_success_rates": _rates(VOCATIONAL_DIMS, "population = 'Formation professionnelle'"),
    "general_success_list": _list(GENERAL_DIMS, "population = 'Formation générale des adultes'"),
    "vocational_success_list": _list(VOCATIONAL_DIMS, "population = 'Formation professionnelle'"),
    "success_reason_labels": """
        SELECT DISTINCT desc_raison_depart FROM adult_headcount_report WHERE raison_depart IN ('22', '12', '04', '2')""",
}

PEOPLE = {
    "job_class_names": """
        SELECT corp_empl AS code_job, corp_empl || ' - (' || descr || ')' AS code_job_name FROM src_job_classes""",
    "held_jobs": """
        SELECT md5(concat_ws('|', matr, ref_empl, corp_empl, etat, lieu_trav, stat_eng)) AS job, matr, ref_empl, corp_empl, etat,
               lieu_trav, stat_eng, date_eff, max(date_fin) AS date_fin FROM src_jobs GROUP BY ALL""",
    "opening_jobs": f"""
        SELECT a.job, a.date_eff FROM held_jobs a
        WHERE NOT EXISTS (SELECT 1 FROM held_jobs b WHERE b.job = a.job AND b.date_eff < a.date_eff
                          AND {weekdays('b.date_fin', 'a.date_eff')} <= 1
                          AND b.date_eff = (SELECT max(c.date_eff) FROM held_jobs c WHERE c.job = a.job AND c.date_eff < a.date_eff))""",
    "activity_history": f"""
        SELECT a.matr, {sy('o.date_eff')} AS school_year, a.ref_empl, a.corp_empl, a.etat AS etat_empl, a.stat_eng, a.lieu_trav,
               o.date_eff, least(max(a.date_fin), {AS_OF}) AS date_fin
        FROM opening_jobs o JOIN held_jobs a ON a.job = o.job AND a.date_eff >= o.date_eff
        WHERE NOT EXISTS (SELECT 1 FROM opening_jobs p WHERE p.job = o.job AND p.date_eff > o.date_eff AND p.date_eff <= a.date_eff)
        GROUP BY ALL""",
    "log_moves": """
        SELECT * FROM (SELECT *, lag(ref_empl) OVER (PARTITION BY matr ORDER BY date_eff, date_creat, ref_empl) AS before FROM src_job_log) AS l
        WHERE ref_empl <> coalesce(before, '')""",
    "main_job_history": f"""
        SELECT {sy('date_eff')} AS school_year, matr, ref_empl AS main_job, date_eff AS valid_from,
               coalesce(lead(date_eff) OVER (PARTITION BY matr ORDER BY date_eff), {AS_OF}) AS valid_until
        FROM (SELECT * FROM log_moves
              QUALIFY row_number() OVER (PARTITION BY matr, date_eff ORDER BY date_creat DESC, ref_empl DESC) = 1) AS moves""",
    "main_job_yearly": f"""
        SELECT matr, CAST(y AS INTEGER) AS school_year, main_job
        FROM (SELECT *, unnest(generate_series({sy('valid_from')}, {sy('valid_until')})) AS y FROM main_job_history) AS years
        QUALIFY row_number() OVER (PARTITION BY matr, y ORDER BY valid_from DESC) = 1""",
    "active_years": f"""
        SELECT h.matr, h.ref_empl, h.corp_empl, h.etat_empl, h.lieu_trav, h.stat_eng, CAST(y.y AS INTEGER) AS school_year
        FROM activity_history h JOIN src_statuses s ON s.school_year = h.school_year AND s.etat_empl = h.etat_empl AND s.etat_actif = 1
        JOIN (SELECT unnest(generate_series(1990, 2010)) AS y) AS y ON y.y BETWEEN h.school_year AND {sy('h.date_fin')}
        QUALIFY row_number() OVER (PARTITION BY h.matr, y.y, h.ref_empl
            ORDER BY h.date_eff DESC, h.date_fin DESC, h.corp_empl, h.etat_empl, h.lieu_trav, h.stat_eng) = 1""",
    "active_flags": """
        SELECT a.*, CASE WHEN m.main_job IS NULL THEN 0 ELSE 1 END AS logged,
               CASE WHEN EXISTS (SELECT 1 FROM src_current_jobs c WHERE c.matr = a.matr AND c.ref_empl = a.ref_empl AND c.ind_empl_princ = 1)
                    THEN 1 ELSE 0 END AS current
        FROM active_years a LEFT JOIN main_job_yearly m ON m.matr = a.matr AND m.school_year = a.school_year AND m.main_job = a.ref_empl""",
    "activity_yearly": """
        SELECT matr, school_year, ref_empl, corp_empl, etat_empl, lieu_trav, stat_eng,
               CASE WHEN sum(logged) OVER job_year > 0 THEN logged WHEN count(*) OVER job_year = 1 THEN 1
                    WHEN sum(current) OVER job_year > 0 THEN current
                    WHEN ref_empl = max(ref_empl) OVER job_year THEN 1 ELSE 0 END AS is_main_job
        FROM active_flags WINDOW job_year AS (PARTITION BY matr, school_year)""",
    "activity_current": f"""
        SELECT y.matr, y.corp_empl, y.etat_empl, y.lieu_trav, y.stat_eng FROM activity_yearly y JOIN src_employees e ON e.matr = y.matr
        WHERE y.school_year = {YEAR} AND y.is_main_job = 1 AND e.last_pay_date > {AS_OF} - 14""",
    "regular_jobs": """
        SELECT h.matr, g.job_group_category, greatest(h.date_eff, m.valid_from) AS start, least(h.date_fin, m.valid_until) AS stop
        FROM activity_history h
        JOIN src_statuses s ON s.school_year = h.school_year AND s.etat_empl = h.etat_empl AND s.etat_actif = 1
        JOIN src_engagements e ON e.school_year = h.school_year AND e.stat_eng = h.stat_eng AND e.is_reg = 1
        JOIN src_job_groups g ON g.job_group = h.corp_empl
        JOIN main_job_history m ON m.matr = h.matr AND m.main_job = h.ref_empl AND m.valid_from <= h.date_fin AND h.date_eff <= m.valid_until
        WHERE h.date_eff <= h.date_fin AND m.valid_from <= m.valid_until""",
    "job_stretches": f"""
        SELECT *, sum(CASE WHEN {weekdays('before', 'start')} <= 1 THEN 0 ELSE 1 END)
                  OVER (PARTITION BY matr, job_group_category ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS stretch
        FROM (SELECT *, lag(stop) OVER (PARTITION BY matr, job_group_category ORDER BY start, stop) AS before FROM regular_jobs) AS linked""",
    "stretch_years": f"""
        SELECT matr, job_group_category, stretch, CAST(y AS INTEGER) AS school_year, greatest(start, make_date(y, 7, 1)) AS start,
               least(stop, make_date(y + 1, 6, 30)) AS stop
        FROM (SELECT *, unnest(generate_series({sy('start')}, {sy('stop')})) AS y FROM job_stretches) AS years""",
    "seniority": """
        SELECT school_year, matr, job_group_category,
               CAST(sum(stop - start) OVER (PARTITION BY matr, job_group_category, stretch ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_experience,
               stop AS valid_until FROM stretch_years""",
    "retirements": """
        SELECT h.matr, h.etat_empl AS etat, h.corp_empl, h.lieu_trav, h.stat_eng, h.date_eff AS retirement_date,
               CAST(datediff('year', e.birth_date, h.date_eff) AS INTEGER) AS retirement_age
        FROM activity_history h JOIN src_statuses s ON s.etat_empl = h.etat_empl AND s.school_year = h.school_year AND s.empl_retr = 1
        LEFT JOIN src_employees e ON e.matr = h.matr
        QUALIFY row_number() OVER (PARTITION BY h.matr ORDER BY h.date_eff DESC, h.etat_empl, h.corp_empl, h.lieu_trav, h.stat_eng) = 1""",
    "censored": """
        SELECT datediff('year', f.date_nais, f.date_dern_paie) AS age FROM src_files f
        WHERE datediff('year', f.date_nais, f.date_entr) < 60 AND NOT EXISTS (SELECT 1 FROM retirements r WHERE r.matr = f.matr)""",
    "age_counts": """
        SELECT CAST(a.age AS INTEGER) AS age,
               (SELECT count(*) FROM retirements r WHERE greatest(least(r.retirement_age, 70), 50) = a.age) AS n_events,
               (SELECT count(*) FROM censored c WHERE c.age = a.age) AS n_censored
        FROM (SELECT unnest(generate_series(50, 70)) AS age) AS a""",
    "at_risk": """
        SELECT a.*, (SELECT CAST(sum(b.n_events + b.n_censored) AS BIGINT) FROM age_counts b WHERE b.age >= a.age) AS n_survivors FROM age_counts a""",
    "death_rates": "SELECT *, CASE WHEN n_survivors > 0 THEN CAST(n_events AS DOUBLE) / n_survivors END AS rate FROM at_risk",
    "retirement_curve": """
        SELECT age, n_events, n_censored, n_survivors, round(rate, 6) AS instantaneous_death_rate,
               round((SELECT product(1 - coalesce(b.rate, 0)) FROM death_rates b WHERE b.age <= a.age), 6) AS survival_rate FROM death_rates a""",
    "cohorts": f"""
        SELECT {YEAR} - year(f.date_nais) AS age, g.job_group_category, count(*) AS n
        FROM activity_current c LEFT JOIN src_files f ON f.matr = c.matr LEFT JOIN src_job_groups g ON g.job_group = c.corp_empl
        WHERE c.matr NOT IN (SELECT matr FROM retirements) AND {YEAR} - year(f.date_nais) BETWEEN 45 AND 70 GROUP BY ALL""",
    "cohort_steps": """
        SELECT c.*, h.h, (SELECT product(1 - coalesce(d.rate, 0)) FROM death_rates d WHERE d.age BETWEEN c.age AND c.age + h.h) AS staying
        FROM cohorts c JOIN (SELECT unnest(generate_series(-1, 5)) AS h) AS h ON true""",
    "cohort_exits": """
        SELECT b.job_group_category, b.h, CAST(sum(round(b.n - b.n * b.staying) - coalesce(round(a.n - a.n * a.staying), 0)) AS DOUBLE) AS n
        FROM cohort_steps b LEFT JOIN cohort_steps a ON a.age = b.age AND a.job_group_category IS NOT DISTINCT FROM b.job_group_category
             AND a.h = b.h - 1 AND a.age + a.h BETWEEN 50 AND 70
        WHERE b.h >= 0 AND b.age + b.h BETWEEN 50 AND 70 GROUP BY ALL""",
    "retirement_forecasts": f"""
        SELECT make_date({YEAR} + h.h, 7, 1) AS school_year, g.job_group_category, coalesce(e.n, 0.0) AS n_retiring_employees
        FROM (SELECT DISTINCT job_group_category FROM src_job_groups) AS g JOIN (SELECT unnest(generate_series(0, 5)) AS h) AS h ON true
        LEFT JOIN cohort_exits e ON e.job_group_category = g.job_group_category AND e.h = h.h""",
    "active_age_report": f"""
        SELECT genre, job_group_category, lieu_trav, stat_eng, etat, age, count(*) AS n_employees, {SLICER_KEY} AS filter_key
        FROM (SELECT e.genre, coalesce(g.job_group_category, 'Inconnu') AS job_group_category, coalesce(c.lieu_trav, 'Inconnu') AS lieu_trav,
                     coalesce(c.stat_eng, 'Inconnu') AS stat_eng, coalesce(c.etat_empl, 'Inconnu') AS etat,
                     CAST({YEAR} - year(e.birth_date) AS INTEGER) AS age
              FROM activity_current c LEFT JOIN src_employees e ON e.matr = c.matr LEFT JOIN src_job_groups g ON g.job_group = c.corp_empl
              WHERE c.matr NOT IN (SELECT matr FROM retirements)) AS rows GROUP BY genre, job_group_category, lieu_trav, stat_eng, etat, age""",
    "retired_years": f"""
        SELECT f.sexe AS genre, coalesce(g.job_group_category, 'Inconnu') AS job_group_category, coalesce(r.lieu_trav, 'Inconnu') AS lieu_trav,
               coalesce(r.stat_eng, 'Inconnu') AS stat_eng, coalesce(r.etat, 'Inconnu') AS etat, {sy('r.retirement_date')} AS y,
               g.job_group_category AS category, r.retirement_age
        FROM retirements r LEFT JOIN src_files f ON f.matr = r.matr LEFT JOIN src_job_groups g ON g.job_group = r.corp_empl""",
    "retirement_age_report": f"""
        SELECT genre, job_group_category, lieu_trav, stat_eng, etat, make_date(y, 7, 1) AS school_year,
               CASE WHEN y = {YEAR} THEN 1 ELSE 0 END AS is_current_year, retirement_age, count(*) AS n_retirees, {SLICER_KEY} AS filter_key
        FROM retired_years WHERE y >= {YEAR - 10} GROUP BY genre, job_group_category, lieu_trav, stat_eng, etat, y, retirement_age""",
    "observed_and_forecast_report": f"""
        SELECT school_year, job_group_category, NULL::BIGINT AS observed_retiring_employes, n_retiring_employees AS forecast_retiring_employees,
               (SELECT sum(b.n_retiring_employees) FROM retirement_forecasts b
                WHERE b.job_group_category = a.job_group_category AND b.school_year <= a.school_year) AS running_forecast_retiring_employees,
               1 AS is_forecast FROM retirement_forecasts a
        UNION ALL
        SELECT make_date(y, 7, 1), category, count(*), NULL, NULL, 0 FROM retired_years WHERE y >= {YEAR - 10} GROUP BY y, category""",
    "survival_curve_report": "SELECT age, instantaneous_death_rate, survival_rate FROM retirement_curve",
    "age_filters": """
        SELECT genre, job_group_category, lieu_trav, stat_eng, etat, filter_key, max(origin) AS filter_source
        FROM (SELECT genre, job_group_category, lieu_trav, stat_eng, etat, filter_key, 'active' AS origin FROM active_age_report
              UNION ALL SELECT genre, job_group_category, lieu_trav, stat_eng, etat, filter_key, 'retirement' FROM retirement_age_report) AS u GROUP BY ALL""",
    "retirement_filters_report": """
        SELECT a.genre, s.etat_empl AS employment_status_name, e.stat_eng AS engagement_status_name, w.workplace_name,
               a.job_group_category, a.filter_key, a.filter_source
        FROM age_filters a LEFT JOIN src_statuses s ON s.etat_empl = a.etat AND s.is_current = 1
        LEFT JOIN src_engagements e ON e.stat_eng = a.stat_eng AND e.is_current = 1 LEFT JOIN src_workplaces w ON w.workplace = a.lieu_trav""",
    "teacher_qualifications": f"""
        SELECT c.matr, c.etat_empl, c.lieu_trav AS workplace, c.stat_eng, c.corp_empl, q.type_qualif, q.date_expir
        FROM activity_current c JOIN src_status_seed s ON s.etat_empl = c.etat_empl AND s.etat_actif = 1
        LEFT JOIN src_qualifications q ON q.matr = c.matr AND coalesce(q.date_expir, DATE '9999-12-31') >= {AS_OF}
        WHERE c.corp_empl LIKE '3%'
        QUALIFY row_number() OVER (PARTITION BY c.matr, q.type_qualif ORDER BY q.date_expir DESC NULLS LAST) = 1""",
    "qualification_report": f"""
        SELECT t.matr AS matricule, e.legal_name AS nom_legal, CASE e.genre WHEN 'F' THEN 'Femme' ELSE 'Homme' END AS genre,
               CASE WHEN a.age < 25 THEN '24 ans et moins' WHEN a.age < 35 THEN '25 à 34 ans' WHEN a.age < 45 THEN '35 à 44 ans'
                    WHEN a.age < 55 THEN '45 à 54 ans' WHEN a.age < 65 THEN '55 à 64 ans' ELSE '65 ans et plus' END AS tranche_age,
               w.workplace_name AS lieu_principal, j.code_job_name AS corp_empl, CASE WHEN t.type_qualif IS NULL THEN 'Aucune' ELSE q.descr END AS qualification,
               s.descr AS etat_empl, coalesce(q.is_qualified, 0) AS edb, 1 - coalesce(q.is_qualified, 0) AS endb, u.statut AS statut_enseignant,
               x.ordre_Ens AS ordre_ens, x.secteur_Descr AS secteur, t.date_expir, t.type_qualif
        FROM teacher_qualifications t JOIN src_employees e ON e.matr = t.matr
        JOIN (SELECT matr, {PARAMS.as_of.year} - year(birth_date) AS age FROM src_employees) AS a ON a.matr = t.matr
        JOIN src_workplaces w ON w.workplace = t.workplace JOIN src_status_seed s ON s.etat_empl = t.etat_empl
        JOIN job_class_names j ON j.code_job = t.corp_empl JOIN src_teacher_statuses u ON u.code = t.stat_eng
        LEFT JOIN src_sectors x ON x.lieu_trav = t.workplace LEFT JOIN src_qualification_names q ON q.code = t.type_qualif""",
}

PAY = {
    "raw_perimeter": """
        SELECT DISTINCT j.matr, j.date_eff, j.date_fin, j.lieu_trav, j.ref_empl, j.stat_eng, j.sect, j.aff, j.etat AS etat_empl,
               CASE WHEN j.corp_empl[1] = '3' THEN CASE WHEN j.stat_eng IN ('E1', 'E2', 'E3', 'E8', 'E9') THEN 6.4::DOUBLE ELSE c.nb_hres_an / 200.0 END
                    WHEN lower(j.mode) = 'h' AND j.nb_hre_sem <> 0 THEN j.nb_hre_sem / 5.0
                    WHEN j.corp_empl[1] = '2' THEN c.nb_hres_an / 260.9 ELSE c.nb_hres_an / 260.0 END AS hntj,
               CASE WHEN j.corp_empl LIKE '35%' THEN 800.0::DOUBLE ELSE 1080.0 END AS nb_hres_an, j.pourc_post, j.pourc_temp,
               CASE WHEN s.trait_spec = '2' THEN 0.0::DOUBLE WHEN s.trait_spec = '1' AND j.pourc_sal >= 2
                    THEN round(j.pourc_post * j.pourc_temp / 100.0 - j.pourc_sal, 4) ELSE 100.0 END AS pourc_sabbatique_manquant
        FROM src_jobs j JOIN src_special_statuses s ON s.etat_empl = j.etat
        JOIN src_dated_classes c ON c.corp_empl = j.corp_empl AND j.date_eff >= c.date_deb AND j.date_eff <= c.date_fin
        WHERE NOT (length(j.stat_eng) = 2 AND j.stat_eng[1] = '9')""",
    "employment_perimeter": "SELECT * REPLACE (round(hntj, 6) AS hntj) FROM raw_perimeter",
    "account_splits": f"""
        SELECT matr, date_cheq, no_cheq, no_seq, no_cmpt, no_cmpt[1:3] AS lieu_trav_cpt_budg, CAST(sum(mnt_dist) AS DOUBLE) AS mnt_dist
        FROM src_splits WHERE date_cheq >= {PAY_FROM} GROUP BY ALL""",
    "pay_lines": f"""
        SELECT c.an_budg, c.no_per, c.gr_paie, c.no_cheq, d.date_cheq, d.date_deb, d.date_fin, p.date_deb AS date_deb_pmnt,
               p.date_fin AS date_fin_pmnt, p.matr, p.corp_empl AS corp_emploi, e.stat_eng, e.sect, e.aff, e.etat_empl,
               CASE WHEN p.code_pmnt[1:4] IN ('1010', '1011', '1012', '1013', '1014') OR p.code_pmnt = '105001' THEN '1'
                    WHEN p.code_pmnt[1:4] = '1015' THEN '3' ELSE '2' END AS typeremun,
               p.mode, p.no_seq, p.code_pmnt, coalesce(p.lieu_trav, e.lieu_trav) AS lieu_trav,
               CASE p.mode WHEN '1' THEN e.hntj WHEN '5' THEN e.hntj WHEN 'J' THEN e.hntj WHEN 'H' THEN 1 WHEN 'L' THEN 1 WHEN '2' THEN 1
                    WHEN 'M' THEN 1 / 60 WHEN 'G' THEN 1 / 60 WHEN 'E' THEN 1 / 60 WHEN '6' THEN 1 / 60 WHEN 'P' THEN e.nb_hres_an / 1000
                    WHEN 'F' THEN e.nb_hres_an / 720 WHEN 'D' THEN e.nb_hres_an / 800 WHEN '3' THEN e.hntj / 2 WHEN '4' THEN e.hntj * 0.75 END
               * CAST(p.nb_unit AS DOUBLE) AS hours,
               e.pourc_sabbatique_manquant AS missing, e.pourc_post * e.pourc_temp / 100 AS worked, p.mnt + p.mnt_cour_trait_diff AS mnt_tot,
               p.mnt_cour_trait_diff AS deferred
        FROM src_payments p JOIN src_cheques c ON c.matr = p.matr AND c.no_cheq = p.no_cheq AND c.date_cheq = p.date_cheq AND c.etat_cheq = 3
        JOIN src_periods d ON d.gr_paie = c.gr_paie AND d.an_budg = c.an_budg AND d.no_per = c.no_per AND d.date_fin >= {PAY_FROM}
        JOIN raw_perimeter e ON e.matr = p.matr AND e.ref_empl = p.ref_empl AND p.date_deb BETWEEN e.date_eff AND e.date_fin
        WHERE p.corp_empl[1] BETWEEN '1' AND '5' AND trim(p.mode) <> '' AND p.code_pmnt IN (SELECT code_pmnt FROM src_payment_codes)
          AND NOT (p.code_pmnt LIKE '103%' AND p.code_pmnt IN (SELECT code_pmnt_a_exonerer FROM src_absence_reasons))
          AND CASE WHEN p.code_pmnt = '105001' THEN p.code_prov IN ('AY', 'A0') OR (p.code_prov = 'AX' AND p.nb_unit BETWEEN 0 AND 60)
                   WHEN regexp_matches(p.code_pmnt, '^10(1[0-5]|3[5-9])..$')
                        THEN p.code_prov NOT IN ('A5', 'A6', 'AJ', 'AK', 'AL', 'AS', 'AT', 'AU', 'AV', 'AW') ELSE false END""",
    # Through a wide decimal: a double such as 64.725 is a little less in binary.
    "pay_hours": """
        SELECT * EXCLUDE (hours, missing, worked, deferred),
               CAST(CAST(CASE WHEN missing = 0 THEN 0 WHEN missing <> 100 AND date_deb_pmnt <> date_fin_pmnt AND deferred <> 0
                         THEN worked * hours / (worked - missing) ELSE hours END AS DECIMAL(18, 8)) AS DECIMAL(7, 2)) AS nb_hre_remun
        FROM pay_lines""",
    "pay_parts": """
        SELECT h.*, s.no_cmpt, s.lieu_trav_cpt_budg, s.mnt_dist, h.code_pmnt IN (SELECT code_pmnt FROM src_kept_codes) AS kept
        FROM pay_hours h LEFT JOIN account_splits s ON s.matr = h.matr AND s.no_cheq = h.no_cheq AND s.no_seq = h.no_seq""",
    "pay_shares": """
        SELECT *, CASE WHEN mnt_dist = 0 AND kept THEN nb_hre_remun / nullif(count(*) FILTER (kept AND mnt_dist = 0 AND mnt_tot = 0)
                              OVER (PARTITION BY an_budg, no_cheq, matr, no_seq), 0)
                       WHEN mnt_dist = 0 THEN 0 WHEN mnt_tot = 0 OR mnt_tot = mnt_dist THEN nb_hre_remun
                       ELSE nb_hre_remun * mnt_dist / mnt_tot END AS share FROM pay_parts""",
    "raw_hours": """
        SELECT an_budg[1:4] AS annee, an_budg, no_per, gr_paie, no_cheq, date_cheq, date_deb, date_fin, date_deb_pmnt, date_fin_pmnt, matr,
               corp_emploi, stat_eng, sect, aff, etat_empl, typeremun, mode, no_seq, code_pmnt,
               no_cmpt[1:3] || '-' || no_cmpt[4:4] || '-' || no_cmpt[5:9] || '-' || no_cmpt[10:] AS no_cmpt, lieu_trav,
               lieu_trav_cpt_budg AS unite_admin, sum(CAST(share AS DOUBLE)) AS nb_hre_remun_dist, sum(mnt_dist) AS mnt_dist
        FROM pay_shares WHERE no_cmpt IS NOT NULL GROUP BY ALL HAVING sum(CAST(share AS DOUBLE)) <> 0""",
    "paid_hours_by_account": "SELECT * REPLACE (round(nb_hre_remun_dist, 6) AS nb_hre_remun_dist, round(CAST(mnt_dist AS DOUBLE), 6) AS mnt_dist) FROM raw_hours",
    "admin_unit_names": """
        SELECT DISTINCT u.exer_fin, u.code AS current_lieu_trav, coalesce(m.new_lieu_trav, u.code) AS new_lieu_trav,
               lower(coalesce(m.new_descr, u.descr)) AS descr
        FROM src_units u LEFT JOIN src_unit_remap m ON m.current_lieu_trav = u.code""",
    "hour_labels": """
        SELECT h.an_budg[1:4] || '-' || h.an_budg[5:] AS an_budg, CAST(h.no_per AS INTEGER) AS no_per, h.no_cmpt,
               coalesce(g.job_group_category, '-') AS cat_emploi, concat(h.corp_emploi, ' - ', c.descr) AS corp_emploi, h.lieu_trav AS code_lieu_trav,
               u.new_lieu_trav AS unite_admin, concat(u.new_lieu_trav, ' - ', u.descr) AS descr_unite_admin,
               concat(h.stat_eng, ' - ', e.descr_stat_eng) AS stat_eng,
               CASE h.typeremun WHEN '1' THEN 'Traitement régulier' WHEN '2' THEN 'Absences' WHEN '3' THEN 'Temps supplémentaire' ELSE '-' END AS type_remun,
               h.nb_hre_remun_dist AS hours
        FROM raw_hours h LEFT JOIN admin_unit_names u ON u.exer_fin = h.an_budg AND u.current_lieu_trav = h.unite_admin
        LEFT JOIN src_job_groups g ON g.job_group = h.corp_emploi LEFT JOIN src_job_classes c ON c.corp_empl = h.corp_emploi
        LEFT JOIN src_engagement_names e ON e.stat_eng = h.stat_eng""",
    "full_time_report": """
        SELECT * EXCLUDE (hours), round(sum(hours), 6) AS nombre_heures_remun, round(sum(hours / 1826.3), 6) AS equivalent_temps_plein
        FROM hour_labels GROUP BY ALL""",
}


def _in(column: str) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in STAFF_CHOICES[column])})"


_CHOSEN = " AND ".join(_in(c) for c in STAFF_CHOICES)
_STAFF_SLICERS = ("workplace_name", "job_class", "employment_status_name", "type", "is_current", "job_department")

ACCESS = {
    "manager_lists": """
        SELECT * REPLACE (CASE WHEN ecole_principale IS NULL THEN ecoles WHEN trim(coalesce(ecoles, '')) = '' THEN ecole_principale
               WHEN list_contains([trim(s) FOR s IN string_split(ecoles, ',')], trim(ecole_principale)) THEN ecoles
               ELSE ecoles || ',' || ecole_principale END AS ecoles)
        FROM src_accounts WHERE corps_emploi[1] = '1'""",
    "manager_schools": "SELECT *, unnest(string_split(ecoles, ',')) AS ecole FROM manager_lists WHERE ecoles IS NOT NULL",
    "workplaces": "SELECT DISTINCT lieu_trav, descr AS lieu_trav_desc FROM src_places",
    "staff_detail": f"""
        SELECT workplace_name, matr, legal_name, job_class, employment_status_name, type, email_address FROM src_staff
        WHERE {_CHOSEN} AND legal_name ILIKE '%{STAFF_SEARCH}%'""",
    "staff_count": f"SELECT count(matr) AS nbr FROM src_staff WHERE {_CHOSEN}",
    "staff_slicers": " UNION ".join(
        f"SELECT '{c}' AS slicer, {c} AS value FROM src_staff" for c in _STAFF_SLICERS
    ),
}



def _checks(name: str) -> str:
    """Failures of a table's checks, one query each."""
    checks = CHECKS[name]
    parts = [(f"not_null:{c}", f"SELECT 1 FROM {name} WHERE {c} IS NULL") for c in checks.not_null]
    parts += [
        (f"accepted_values:{c}", f"SELECT 1 FROM {name} WHERE {c} NOT IN ({', '.join(map(repr, values))})")
        for c, values in checks.accepted.items()
    ]
    parts += [
        (f"accepted_range:{c}", f"SELECT 1 FROM {name} WHERE {c} < {low} OR {c} > {high}")
        for c, (low, high) in checks.ranges.items()
    ]
    keys = ([("key", checks.key)] if checks.key else []) + [(c, (c,)) for c in checks.unique]
    parts += [
        (f"unique:{label}", f"SELECT 1 FROM {name} GROUP BY {', '.join(key)} HAVING count(*) > 1")
        for label, key in keys
    ]
    return " UNION ALL ".join(
        f"SELECT '{label}' AS check_name, count(*) AS n_failures FROM ({text}) AS failing"
        for label, text in parts
    )


TABLES_SQL = {**ABSENCES, **STUDENTS, **ADULTS, **PEOPLE, **PAY, **ACCESS}
TABLES_SQL |= {f"checks_of_{name}": _checks(name) for name in CHECKED}


def _profile(database: str) -> str:
    """Filled values per declared column, counted on the derived inputs themselves."""
    parts = []
    for name in [n for n in INPUTS if n in SOURCES and SOURCES[n].database == database]:
        declared = ", ".join(f"'{column.name}'" for column in SOURCES[name].columns)
        counts = f"SELECT count(COLUMNS(*)) FROM {INPUTS[name]}"
        parts.append(
            f"SELECT '{name}' AS input, \"column\", n_values"
            f" FROM (UNPIVOT ({counts}) ON COLUMNS(*) INTO NAME \"column\" VALUE n_values) AS counted"
            f" WHERE \"column\" IN ({declared})"
        )
    return " UNION ALL ".join(parts)

TABLES_SQL |= {f"sources_of_{database}": _profile(database) for database in DATABASES}


def compose(name: str) -> str:
    """One statement: the CTEs a table needs, in order, and the table itself."""
    texts = {n: duckdb_sql(n) for n in RULES} | TABLES_SQL
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\w+", text)) & texts.keys():
            if word not in needed:
                needed.add(word)
                visit(texts[word])

    visit(texts[name])
    needed.discard(name)
    ctes = [f"{n} AS ({texts[n].strip()})" for n in texts if n in needed]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + texts[name].strip()


def plan_oracles(names: list[str]) -> dict[str, str]:
    return {name: compose(name) for name in names}
