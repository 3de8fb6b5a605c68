"""School-board inputs derived from the driver's order tables.

A customer is a pupil or an employee, a nation a school, an order a day or a cheque, a line
a missed period or a payment. Every rule is a row-wise or grouped expression over whole
tables, written in the SQL both engines share, so the inputs grow with the tables.

``@each(a, b)@`` stands for one output row per listed value.
"""

from __future__ import annotations

import re
from datetime import date
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from boardroll.params import Params

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

PARAMS = Params(
    as_of=date(2001, 6, 30),
    current_year=2000,
    reference_month=7,
    years_of_absences=5,
    years_of_students=5,
    years_of_adults=2,
    years_in_report=3,
    excluded_services=("06", "08"),
    pay_from=date(1998, 7, 1),
)

_SCHOOL_YEAR = "CAST(year({0}) - CASE WHEN month({0}) < 7 THEN 1 ELSE 0 END AS INT)"
_MATR = "lpad(CAST({0} AS STRING), 6, '0')"


def _sql(text: str) -> str:
    text = re.sub(r"SY\((\w+)\)", lambda m: _SCHOOL_YEAR.replace("{0}", m[1]), text)
    return re.sub(r"MATR\((\w+)\)", lambda m: _MATR.replace("{0}", m[1]), text)


# Most periods of a grid are held on a few days only.
_RARE_PERIODS = ", ".join(
    f"CASE WHEN day(date_evenement) % 29 = {i} THEN 1 END AS per_{i:02d}" for i in range(4, 20)
)

_RULES = {
    # One row per order: a pupil's day at school.
    "src_visits": """
        SELECT o_orderkey AS k, CAST(o_custkey AS INT) AS fiche, c_nationkey AS n,
               CAST(o_orderdate AS DATE) AS day, SY(o_orderdate) AS annee,
               SY(o_orderdate) * 100 + c_nationkey AS id_eco, c_mktsegment AS segment
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "src_school_years": """
        SELECT DISTINCT id_eco, annee, lpad(CAST(n AS STRING), 3, '0') AS eco FROM {src_visits}""",
    "src_schools": """
        SELECT DISTINCT id_eco, lpad(CAST(n AS STRING), 3, '0') AS eco, annee,
               CAST(annee AS STRING) || '-' || CAST(annee + 1 AS STRING) AS annee_scolaire,
               CASE WHEN n_nationkey = 7 THEN NULL ELSE n_name END AS school_friendly_name
        FROM {src_visits} JOIN {nation} ON n = n_nationkey""",
    "src_year_spans": """
        SELECT DISTINCT annee, make_date(annee, 7, 1) AS date_deb,
               make_date(annee + 1, 6, 30) AS date_fin FROM {src_visits}""",
    "src_pupils": """
        SELECT DISTINCT fiche, id_eco,
               CAST(1 + fiche % 3 AS STRING) AS cycle_ref,
               substr('1278391', CAST(1 + (fiche + annee) % 7 AS INT), 1) AS annee_cycle_ref,
               'G' || CAST(fiche % 2 AS STRING) AS grp_rep, 'A' AS statut_don_an,
               CASE segment WHEN 'BUILDING' THEN '2' WHEN 'AUTOMOBILE' THEN '3'
                    WHEN 'MACHINERY' THEN '1' ELSE '4' END AS ordre_ens,
               substr('ABCDEFGHI34578', CAST(1 + (fiche + annee % 2) % 14 AS INT), 1) AS classe,
               'C' || CAST(fiche % 3 AS STRING) AS class,
               CASE WHEN fiche % 17 = 0 THEN NULL ELSE 'D' || CAST(fiche % 2 AS STRING) END AS dist,
               make_date(annee, 7 + fiche % 3, 1 + fiche % 28) AS date_debut,
               CASE WHEN fiche % 4 = 0 THEN make_date(annee + 1, 1 + fiche % 6, 10) END AS date_depart,
               CASE fiche % 3 WHEN 0 THEN NULL WHEN 1 THEN '1' ELSE '2' END AS plan_interv_ehdaa,
               CASE WHEN fiche % 5 = 0 THEN 'D5' END AS difficulte,
               CAST(4 + fiche % 13 AS INT) AS age_30_sept,
               CASE WHEN fiche % 4 = 1 THEN 'CP' END AS categ_prog_part,
               CASE WHEN fiche % 4 = 1 THEN 'TP' END AS type_prog_part,
               CASE fiche % 5 WHEN 0 THEN '07' WHEN 1 THEN '08' ELSE '01' END AS type_parcours,
               CASE WHEN fiche % 53 = 0 THEN NULL WHEN fiche % 2 = 0 THEN 'A' ELSE 'B' END AS grille
        FROM {src_visits}""",
    "src_calendar": """
        SELECT id_eco, date_evenement, grille,
               CASE WHEN day(date_evenement) % 7 = 0 THEN NULL ELSE 'J' END AS jour_cycle,
               CASE WHEN day(date_evenement) % 11 <> 0 THEN 1 END AS per_01,
               CASE WHEN day(date_evenement) % 11 <> 0 AND grille = 'A' THEN 1 END AS per_02,
               CASE WHEN day(date_evenement) % 3 = 1 THEN 1 END AS per_03,
               CASE WHEN day(date_evenement) % 4 = 1 THEN 1 END AS per_20,
               """ + _RARE_PERIODS + """
        FROM (SELECT id_eco, day AS date_evenement, @each('A', 'B')@ AS grille
              FROM (SELECT DISTINCT id_eco, day FROM {src_visits}) AS days) AS cells""",
    "src_absences": """
        SELECT day AS date_abs, fiche, id_eco, l_returnflag || l_linestatus AS motif_abs,
               'r' || CAST(l_linenumber AS STRING) AS remarque, CAST(l_partkey % 4 AS INT) AS id_mat_grp
        FROM {lineitem} JOIN {src_visits} ON l_orderkey = k""",
    "src_subject_groups": """
        SELECT id_eco, id_mat_grp, CASE id_mat_grp WHEN 0 THEN 'FRA' ELSE 'MAT' END AS mat
        FROM (SELECT id_eco, @each(0, 1)@ AS id_mat_grp FROM {src_school_years}) AS groups""",
    "src_subject_names": """
        SELECT id_eco, mat, mat || ' ' || CAST(id_eco % 3 AS STRING) AS description_abreg
        FROM {src_subject_groups}""",
    "src_reasons": """
        SELECT id_eco, motif_abs, 'Motif ' || motif_abs AS descr,
               CASE motif_abs WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3 WHEN 'RF' THEN 4 END AS cpt_abs
        FROM (SELECT id_eco, @each('AF', 'AO', 'NF', 'NO', 'RF')@ AS motif_abs
              FROM {src_school_years}) AS codes""",
    "src_terms": """
        SELECT fiche, id_eco,
               CASE WHEN fiche % 11 = 0 AND t = 1 THEN '9' ELSE CAST(t AS STRING) END AS etape,
               'Bloc ' || CAST(t AS STRING) AS etape_description, t AS seq_etape,
               CASE t WHEN 1 THEN make_date(annee, 7, 1) WHEN 2 THEN make_date(annee, 11, 1)
                      ELSE make_date(annee + 1, 2, 16) END AS date_debut,
               CASE t WHEN 1 THEN make_date(annee, 10, 31) WHEN 2 THEN make_date(annee + 1, 2, 15)
                      ELSE make_date(annee + 1, 6, 30) END AS date_fin
        FROM (SELECT fiche, id_eco, annee, @each(1, 2, 3)@ AS t
              FROM (SELECT DISTINCT fiche, id_eco, annee FROM {src_visits}) AS years) AS terms
        WHERE NOT (fiche % 7 = 0 AND t = 3)""",
    "src_people": """
        SELECT CAST(c_custkey AS INT) AS fiche, c_name AS nom, c_mktsegment AS pnom,
               'CP' || CAST(c_custkey AS STRING) AS code_perm FROM {customer}""",
    "src_spine": """
        SELECT DISTINCT 'CP' || CAST(fiche AS STRING) AS code_perm, id_eco, annee, fiche,
               CASE WHEN fiche % 2 = 0 THEN 'Secondaire régulier' ELSE 'Secondaire adapté' END AS population,
               lpad(CAST(n AS STRING), 3, '0') AS eco,
               CASE WHEN fiche % 19 = 0 THEN 2 ELSE 1 END AS seqid FROM {src_visits}""",
    "src_measures": """
        SELECT DISTINCT fiche, id_eco, 'M' || CAST(fiche % 6 AS STRING) AS type_mesure,
               CAST(fiche % 2 AS INT) AS is_francisation FROM {src_visits} WHERE fiche % 6 < 5""",
    "src_measure_names": """
        SELECT 'M' || CAST(r_regionkey AS STRING) AS code,
               CASE WHEN r_regionkey < 4 THEN 'type_mesure' ELSE 'autre' END AS nom_table,
               r_name AS cf_descr_abreg FROM {region}""",
    "src_mentions": """
        SELECT 'CP' || CAST(o_custkey AS STRING) AS code_perm, CAST(o_custkey AS INT) AS fiche,
               lpad(CAST(o_orderkey % 25 AS STRING), 3, '0') AS eco_cen_off,
               'P' || CAST(o_orderkey % 6 AS STRING) AS prog_charl, o_orderpriority AS regime_sanct_charl,
               CASE WHEN o_orderstatus = 'O' THEN 'O' ELSE 'N' END AS ind_reus_sanct_charl,
               CAST(year(o_orderdate) AS STRING) || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS date_exec_sanct,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_obt_mention FROM {orders}""",
    "src_programmes": """
        SELECT 'p' || CAST(r_regionkey AS STRING) AS prog, 'P' || CAST(r_regionkey AS STRING) AS prog_meq,
               CASE r_regionkey WHEN 0 THEN 'DES' WHEN 1 THEN 'CFPT' WHEN 2 THEN 'CFMS' ELSE 'AUTRE' END AS type_diplome
        FROM {region}""",
    "src_addresses": """
        SELECT CAST(o_custkey AS INT) AS fiche,
               CASE WHEN o_custkey % 3 = 0 OR min(o_orderkey) % 2 = 0 THEN 'P' ELSE 'M' END AS type_adr,
               CAST(o_orderdate AS DATE) AS date_effect,
               CASE WHEN min(o_orderkey) % 10 = 0 THEN CAST(o_orderdate AS DATE)
                    WHEN min(o_orderkey) % 10 = 1 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + 200 END AS date_fin,
               CAST(min(o_orderkey) % 997 AS STRING) AS no_civ, CAST(NULL AS STRING) AS orient_rue,
               'rue' AS genre_rue, min(o_orderpriority) AS rue, min(o_orderstatus) AS ville,
               'H' || CAST(min(o_orderkey) % 89 AS STRING) AS code_post,
               CAST(min(o_orderkey) % 3 % 2 AS INT) AS ind_envoi_meq
        FROM {orders} GROUP BY o_custkey, o_orderdate""",
    # Adult education: an order is an enrolment.
    "src_populations": """
        SELECT 'CP' || CAST(o_custkey AS STRING) AS code_perm, CAST(o_custkey AS INT) AS fiche,
               SY(o_orderdate) AS annee, CAST(o_orderkey AS INT) AS freq,
               CASE WHEN o_custkey % 2 = 0 THEN 'Formation générale des adultes'
                    ELSE 'Formation professionnelle' END AS population FROM {orders}""",
    "src_adults": """
        SELECT CAST(c_custkey AS INT) AS fiche, 'CP' || CAST(c_custkey AS STRING) AS code_perm,
               c_name AS nom, c_mktsegment AS prenom,
               CAST(1955 + c_custkey % 32 AS STRING) || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0')
                   || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') AS date_naissance,
               CAST(c_nationkey AS STRING) AS ind_lieu_naissance_n,
               'L' || CAST(c_custkey % 7 AS STRING) AS lang_matern,
               CASE c_custkey % 5 WHEN 0 THEN 'X' WHEN 1 THEN 'F' WHEN 2 THEN 'F' ELSE 'M' END AS genre
        FROM {customer}""",
    "src_adult_addresses": """
        SELECT CAST(o_custkey AS INT) AS fiche, 'V' || CAST(o_orderkey % 40 AS STRING) AS ville,
               'J' || CAST(o_orderkey % 60 AS STRING) AS code_post,
               CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '0' END AS envoimeq,
               CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '20000101' END AS date_fin FROM {orders}""",
    "src_enrolments": """
        SELECT CAST(o_custkey AS INT) AS fiche, SY(o_orderdate) AS annee,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_deb,
               lpad(CAST(o_orderkey % 25 AS STRING), 3, '0') AS eco_cen,
               'O' || CAST(o_orderkey % 2 AS STRING) AS org, 'B' || CAST(o_orderkey % 4 AS STRING) AS bat,
               o_orderstatus AS client, CAST(o_orderkey AS INT) AS freq,
               'P' || CAST(o_orderkey % 12 AS STRING) AS prog,
               CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL
                    ELSE 'AF' || CAST(o_orderkey % 4 AS STRING) END AS activ_form,
               CASE WHEN o_orderkey % 10 < 2 THEN '' ELSE 'DP' || CAST(o_orderkey % 2 AS STRING) END AS donpers,
               'C' || CAST(o_orderkey % 7 AS STRING) AS cond_admiss,
               '0' || CAST(o_orderkey % 9 AS STRING) AS service_enseign,
               'H' || CAST(o_orderkey % 3 AS STRING) AS org_hor,
               CASE o_orderstatus WHEN 'O' THEN '' WHEN 'F' THEN '20000101' ELSE '20010615' END AS date_fin_sifca,
               CAST(10 + o_orderkey % 4 AS STRING) AS motif_depart,
               CASE o_orderkey % 11 WHEN 0 THEN '22' WHEN 3 THEN '12' WHEN 6 THEN '04' WHEN 9 THEN '2'
                    WHEN 10 THEN 'XX' WHEN 1 THEN NULL ELSE '7' END AS raison_depart,
               'R' || CAST(o_orderkey % 6 AS STRING) AS raison_grat_scol,
               'T' || CAST(o_orderkey % 6 AS STRING) AS type_parcours,
               CAST(o_orderkey % 3 AS INT) AS ind_transm FROM {orders}""",
    "src_adult_programmes": """
        SELECT 'P' || CAST(n_nationkey AS STRING) AS prog, n_name AS descr_prog,
               CASE WHEN n_nationkey % 2 = 0 THEN 'DEP' ELSE 'ASP' END AS type_diplome
        FROM {nation} WHERE n_nationkey < 10""",
    "src_codes": """
        SELECT CASE d WHEN 'X_Lang' THEN 'L' || CAST(k AS STRING)
                      WHEN 'X_ServiceEnseign' THEN '0' || CAST(k AS STRING)
                      WHEN 'X_MotifDep' THEN '1' || CAST(k AS STRING)
                      WHEN 'X_TypeParcours' THEN 'T' || CAST(k AS STRING)
                      WHEN 'X_CondAdmiss' THEN 'C' || CAST(k AS STRING)
                      WHEN 'X_RaisonGratScol' THEN 'R' || CAST(k AS STRING)
                      ELSE CASE k WHEN 0 THEN '22' WHEN 1 THEN '12' WHEN 2 THEN '04' WHEN 3 THEN '7' ELSE '2' END
               END AS code, d AS nom_table, d || ' ' || descr AS cf_descr
        FROM (SELECT r_regionkey AS k, r_name AS descr,
                     @each('X_Lang', 'X_ServiceEnseign', 'X_MotifDep', 'X_TypeParcours', 'X_CondAdmiss', 'X_RaisonGratScol', 'X_RaisonDepart')@ AS d
              FROM {region}) AS domains""",
    "src_centres": """
        SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS eco_cen, n_name AS descr
        FROM {nation} WHERE n_nationkey < 23""",
    "src_timetables": """
        SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS eco_cen, @each('H0', 'H1')@ AS org_hor,
               'Horaire ' || n_name AS descr FROM {nation}""",
    # Human resources: a customer is an employee, an order opens a job interval.
    "src_jobs": """
        SELECT MATR(o_custkey) AS matr, CAST(o_orderdate AS DATE) AS date_eff,
               'S' || CAST(o_custkey % 3 AS STRING) AS sect, 'F' || CAST(o_orderkey % 2 AS STRING) AS aff,
               lpad(CAST(o_custkey % 7 AS STRING), 3, '0') AS lieu_trav,
               CASE o_custkey % 5 WHEN 0 THEN '3500' WHEN 1 THEN '3100' WHEN 2 THEN '2100'
                    WHEN 3 THEN '1100' ELSE '4100' END AS corp_empl,
               CASE WHEN o_orderpriority = '5-LOW' AND o_custkey % 4 = 0 THEN 'R1'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'A2' ELSE 'A1' END AS etat,
               CASE WHEN o_orderkey % 2 = 0 THEN 'H' ELSE 'J' END AS mode,
               CASE o_custkey % 6 WHEN 0 THEN 'E1' WHEN 1 THEN 'R1' WHEN 2 THEN 'T1' WHEN 3 THEN '91'
                    WHEN 4 THEN 'E8' ELSE 'R2' END AS stat_eng,
               CAST(1 + o_orderkey % 2 AS STRING) AS ref_empl,
               CASE WHEN o_orderkey % 20 = 0 THEN make_date(9999, 12, 31)
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 700 AS INT) END AS date_fin,
               CAST(80 + o_orderkey % 2 * 20 AS DOUBLE) AS pourc_post,
               CAST(o_orderkey % 3 * 30 AS DOUBLE) AS pourc_sal, CAST(100 AS DOUBLE) AS pourc_temp,
               CAST(o_orderkey % 4 * 10 AS DOUBLE) AS nb_hre_sem FROM {orders}""",
    "src_statuses": """
        SELECT etat_empl, school_year,
               CASE WHEN etat_empl = 'A1' OR (etat_empl = 'A2' AND school_year % 2 = 0) THEN 1 ELSE 0 END AS etat_actif,
               CASE WHEN etat_empl = 'R1' THEN 1 ELSE 0 END AS empl_retr,
               CASE WHEN school_year = 2000 THEN 1 ELSE 0 END AS is_current
        FROM (SELECT annee AS school_year, @each('A1', 'A2', 'R1')@ AS etat_empl FROM {src_year_spans}) AS s""",
    "src_engagements": """
        SELECT stat_eng, school_year, CASE WHEN stat_eng IN ('R1', 'R2', 'E1') THEN 1 ELSE 0 END AS is_reg,
               CASE WHEN school_year = 2000 THEN 1 ELSE 0 END AS is_current
        FROM (SELECT annee AS school_year, @each('E1', 'R1', 'R2', 'T1')@ AS stat_eng FROM {src_year_spans}) AS s""",
    "src_job_log": """
        SELECT MATR(o_custkey) AS matr, CAST(o_orderdate AS DATE) AS date_eff,
               CAST(1 + o_orderkey % 7 % 3 AS STRING) AS ref_empl,
               CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INT) AS TIMESTAMP) AS date_creat
        FROM {orders} WHERE o_custkey % 3 <> 0""",
    "src_files": """
        SELECT MATR(c_custkey) AS matr,
               make_date(CAST(1929 + c_custkey % 30 AS INT), CAST(1 + c_custkey % 12 AS INT), CAST(1 + c_custkey % 28 AS INT)) AS date_nais,
               make_date(CAST(1978 + c_custkey % 16 AS INT), 9, 1) AS date_entr,
               make_date(CAST(1995 + c_custkey % 7 AS INT), CAST(1 + c_custkey % 6 AS INT), 15) AS date_dern_paie,
               CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS sexe FROM {customer}""",
    "src_employees": """
        SELECT matr, date_nais AS birth_date,
               CASE WHEN date_dern_paie >= make_date(1997, 1, 1) THEN make_date(2001, 6, 25) ELSE date_dern_paie END AS last_pay_date,
               sexe AS genre, 'Nom ' || matr AS legal_name,
               CASE sexe WHEN 'F' THEN 'femme' ELSE 'homme' END AS sex_friendly_name FROM {src_files}""",
    "src_current_jobs": """
        SELECT MATR(c_custkey) AS matr, ref_empl,
               CASE WHEN c_custkey % 5 = CAST(ref_empl AS INT) THEN 1 ELSE 0 END AS ind_empl_princ
        FROM (SELECT c_custkey, @each('1', '2')@ AS ref_empl FROM {customer}) AS jobs""",
    "src_job_classes": """
        SELECT CASE r_regionkey WHEN 0 THEN '3500' WHEN 1 THEN '3100' WHEN 2 THEN '2100'
                    WHEN 3 THEN '1100' ELSE '4100' END AS corp_empl, r_name AS descr,
               CAST(1700 + r_regionkey * 25 AS DOUBLE) AS nb_hres_an, r_regionkey AS r FROM {region}""",
    "src_dated_classes": """
        SELECT corp_empl, descr, nb_hres_an + p AS nb_hres_an,
               CASE p WHEN 0 THEN make_date(1990, 1, 1) ELSE make_date(1998, 1, 1) END AS date_deb,
               CASE p WHEN 0 THEN make_date(1997, 12, 31) ELSE make_date(9999, 12, 31) END AS date_fin
        FROM (SELECT corp_empl, descr, nb_hres_an, @each(0, 1)@ AS p FROM {src_job_classes}) AS dated""",
    "src_job_groups": """
        SELECT corp_empl AS job_group, 'Cat ' || CAST(r % 3 AS STRING) AS job_group_category
        FROM {src_job_classes} WHERE r < 4""",
    "src_workplaces": """
        SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS workplace, n_name AS workplace_name
        FROM {nation} WHERE n_nationkey < 6""",
    "src_status_seed": """
        SELECT DISTINCT etat_empl, 'Etat ' || etat_empl AS descr,
               CASE WHEN etat_empl = 'R1' THEN 0 ELSE 1 END AS etat_actif FROM {src_statuses}""",
    "src_special_statuses": """
        SELECT DISTINCT etat_empl,
               CASE etat_empl WHEN 'A1' THEN '0' WHEN 'A2' THEN '1' ELSE '2' END AS trait_spec FROM {src_statuses}""",
    "src_qualifications": """
        SELECT MATR(o_custkey) AS matr, 'Q' || CAST(o_orderkey % 4 AS STRING) AS type_qualif,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 900 END AS date_expir
        FROM {orders}""",
    "src_qualification_names": """
        SELECT 'Q' || CAST(r_regionkey AS STRING) AS code, r_name AS descr,
               CASE WHEN r_regionkey % 2 = 0 THEN 1 ELSE 0 END AS is_qualified FROM {region} WHERE r_regionkey < 3""",
    "src_teacher_statuses": """
        SELECT DISTINCT stat_eng AS code, 'Statut ' || stat_eng AS statut FROM {src_engagements}""",
    "src_sectors": """
        SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS lieu_trav,
               'Secteur ' || CAST(n_regionkey AS STRING) AS secteur_Descr,
               CAST(n_nationkey % 3 AS STRING) AS ordre_Ens FROM {nation} WHERE n_nationkey < 4""",
    # Pay: an order is a cheque, a line a payment.
    "src_periods": """
        SELECT DISTINCT '1' AS gr_paie,
               CAST(SY(o_orderdate) AS STRING) || CAST(SY(o_orderdate) + 1 AS STRING) AS an_budg,
               lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS no_per,
               make_date(year(o_orderdate), month(o_orderdate), 1) AS date_deb,
               make_date(year(o_orderdate), month(o_orderdate), 27) AS date_fin,
               make_date(year(o_orderdate), month(o_orderdate), 28) AS date_cheq FROM {orders}""",
    "src_cheques": """
        SELECT MATR(o_custkey) AS matr, '1' AS gr_paie, CAST(o_orderkey AS STRING) AS no_cheq,
               CAST(o_orderdate AS DATE) AS date_cheq,
               CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS etat_cheq,
               CAST(SY(o_orderdate) AS STRING) || CAST(SY(o_orderdate) + 1 AS STRING) AS an_budg,
               lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS no_per FROM {orders}""",
    "src_lines": """
        SELECT o_orderkey AS k, o_custkey AS c, l_linenumber AS no_seq, CAST(min(o_orderdate) AS DATE) AS day,
               min(l_partkey) AS p, min(l_returnflag || l_linestatus) AS flags,
               max(l_quantity) AS quantity, max(l_extendedprice) AS price
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, l_linenumber""",
    "src_payments": """
        SELECT MATR(c) AS matr, no_seq,
               CASE flags WHEN 'AF' THEN '101000' WHEN 'AO' THEN '103500' WHEN 'NF' THEN '101500'
                    WHEN 'NO' THEN '105001' WHEN 'RF' THEN '103600' ELSE '999999' END AS code_pmnt,
               CASE c % 5 WHEN 0 THEN '3500' WHEN 1 THEN '3100' WHEN 2 THEN '2100' WHEN 3 THEN '1100' ELSE '9100' END AS corp_empl,
               CASE WHEN p % 3 = 0 THEN NULL ELSE lpad(CAST(p % 7 AS STRING), 3, '0') END AS lieu_trav,
               CASE p % 16 WHEN 0 THEN '1' WHEN 1 THEN '5' WHEN 2 THEN 'J' WHEN 3 THEN 'H' WHEN 4 THEN 'L'
                    WHEN 5 THEN '2' WHEN 6 THEN 'M' WHEN 7 THEN 'G' WHEN 8 THEN 'E' WHEN 9 THEN '6' WHEN 10 THEN 'P'
                    WHEN 11 THEN 'F' WHEN 12 THEN 'D' WHEN 13 THEN '3' WHEN 14 THEN '4' ELSE ' ' END AS mode,
               CAST(quantity AS DECIMAL(12,4)) AS nb_unit, CAST(1 + k % 2 AS STRING) AS ref_empl,
               CAST(k AS STRING) AS no_cheq, day AS date_cheq,
               day + CAST(p % 20 AS INT) AS date_deb, day + CAST(p % 20 + p % 2 AS INT) AS date_fin,
               CASE p % 5 WHEN 0 THEN 'A6' WHEN 1 THEN 'AX' WHEN 2 THEN 'AY' ELSE 'B1' END AS code_prov,
               CASE WHEN p % 9 = 0 THEN CAST(0 AS DECIMAL(14,2)) ELSE CAST(price AS DECIMAL(14,2)) END AS mnt,
               CASE WHEN p % 9 <> 0 AND p % 4 = 0 THEN CAST(10 AS DECIMAL(14,2)) ELSE CAST(0 AS DECIMAL(14,2)) END AS mnt_cour_trait_diff
        FROM {src_lines}""",
    "src_splits": """
        SELECT matr, date_cheq, no_cheq, no_seq,
               lpad(CAST((CAST(no_cheq AS INT) + a) % 7 AS STRING), 3, '0') || '1' || lpad(no_cheq, 5, '0') || '77' || CAST(a AS STRING) AS no_cmpt,
               CASE a WHEN 1 THEN CAST(mnt AS DECIMAL(14,2)) ELSE CAST(mnt_cour_trait_diff AS DECIMAL(14,2)) END AS mnt_dist
        FROM (SELECT matr, date_cheq, no_cheq, no_seq, mnt, mnt_cour_trait_diff, @each(1, 2)@ AS a FROM {src_payments}) AS halves
        WHERE NOT (no_seq = 7 AND a = 2)""",
    "src_payment_codes": """
        SELECT DISTINCT code_pmnt FROM {src_payments} WHERE code_pmnt <> '103500' OR no_seq = 1""",
    "src_absence_reasons": """
        SELECT DISTINCT code_pmnt AS code_pmnt_a_exonerer FROM {src_payments} WHERE code_pmnt IN ('103600', '101500')""",
    "src_kept_codes": """
        SELECT DISTINCT code_pmnt FROM {src_payments} WHERE code_pmnt IN ('101500', '105001')""",
    "src_units": """
        SELECT an_budg AS exer_fin, code, 'Unite ' || code AS descr
        FROM (SELECT DISTINCT an_budg, @each('000', '001', '002', '003', '004', '005')@ AS code FROM {src_periods}) AS units""",
    "src_unit_remap": """
        SELECT lpad(CAST(r_regionkey AS STRING), 3, '0') AS current_lieu_trav, '002' AS new_lieu_trav,
               'Regroupe' AS new_descr FROM {region} WHERE r_regionkey IN (1, 3)""",
    "src_engagement_names": """
        SELECT DISTINCT stat_eng, 'Engagement ' || stat_eng AS descr_stat_eng FROM {src_engagements} WHERE stat_eng <> 'T1'""",
    # Access and staff list.
    "src_accounts": """
        SELECT CAST(s_suppkey AS STRING) AS cle_organisationnelle, 'u' || CAST(s_suppkey AS STRING) AS compte_authentification,
               s_name AS nom, CAST(s_nationkey AS STRING) AS prenom,
               CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN '001, 002' WHEN 3 THEN '003,004' ELSE '002' END AS ecoles,
               CAST(100 + s_suppkey % 2 * 100 AS STRING) AS corps_emploi,
               CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '002' ELSE '009 ' END AS ecole_principale,
               'Poste' AS description_corps_emploi_principal FROM {supplier}""",
    "src_places": """
        SELECT lpad(CAST(c_nationkey AS STRING), 3, '0') AS lieu_trav, n_name AS descr
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "src_staff": """
        SELECT n_name AS workplace_name, CAST(c_custkey AS STRING) AS matr, c_name AS legal_name, c_mktsegment AS job_class,
               CASE WHEN c_custkey % 3 = 0 THEN 'Congé' ELSE 'Actif' END AS employment_status_name,
               'T' || CAST(c_custkey % 2 AS STRING) AS type, CAST(c_custkey AS STRING) || '@example.org' AS email_address,
               CASE WHEN c_custkey % 7 = 0 THEN 'Non' ELSE 'Oui' END AS is_current,
               'Dép. ' || CAST(n_regionkey AS STRING) AS job_department
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
}

RULES = {name: _sql(text) for name, text in _RULES.items()}

# Derived inputs that several others of a query are made of; each is computed once.
_SHARED = ("src_visits", "src_lines")

# Tables that a shared input joins, dealt by order beforehand where they are large: what a task
# sorts, and what it keeps, is then no more than about so many rows.
_DEALT = {"src_lines": {"lineitem": "l_orderkey", "orders": "o_orderkey"}}
_ROWS = 250_000

_EACH = re.compile(r"@each\((.*?)\)@")


def _needs(text: str) -> list[str]:
    return [field for _, field, _, _ in Formatter().parse(text) if field]


def duckdb_sql(name: str) -> str:
    """The rule of a derived input as DuckDB SQL over views and earlier CTEs."""
    text = RULES[name].format(**{n: n for n in _needs(RULES[name])})
    return _EACH.sub(r"unnest([\1])", text)


class Derived:
    """The derived inputs as DataFrames, built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                frame = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
            else:
                text = _EACH.sub(r"explode(array(\1))", RULES[name])
                frame = self._spark.sql(text, **{n: self._needed(n, name) for n in dict.fromkeys(_needs(text))})
            if name == "src_visits" and (parts := self._parts("orders")) > 1:
                frame = frame.repartition(parts, "k")
            self._frames[name] = frame.persist() if name in _SHARED else frame
        return self._frames[name]

    def _needed(self, name: str, by: str) -> DataFrame:
        """An input as ``by`` reads it."""
        keys = _DEALT.get(by, {})
        if name in keys and (parts := max(self._parts(n) for n in keys)) > 1:
            return self[name].repartition(parts, keys[name])
        return self[name]

    def _parts(self, table: str) -> int:
        """Partitions for about ``_ROWS`` rows of a table each; Parquet files know their count."""
        return -(-self[table].count() // _ROWS)
