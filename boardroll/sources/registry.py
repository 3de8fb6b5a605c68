"""Source tables: where they live, which columns are taken, their names and types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Column:
    """An upstream column, its type, and the name that the jobs use for it."""

    upstream: str
    type: str
    renamed: str | None = None

    @property
    def name(self) -> str:
        return self.renamed or self.upstream


@dataclass(frozen=True)
class Source:
    """A table of an upstream database and the columns taken from it."""

    database: str
    table: str
    columns: tuple[Column, ...]


# Upstream table and column names, and the names the jobs use for them.
SOURCES: dict[str, Source] = {
    "i_gpm_e_abs": Source(
        "gpi",
        "gpm_e_abs",
        (
            Column("date_abs", "date"),
            Column("fiche", "int"),
            Column("id_eco", "int"),
            Column("motif_abs", "string"),
            Column("rem", "string", "remarque"),
            Column("id_mat_grp", "int"),
        ),
    ),
    "i_gpm_e_dan": Source(
        "gpi",
        "gpm_e_dan",
        (
            Column("fiche", "int"),
            Column("id_eco", "int"),
            Column("cycle_ref", "string"),
            Column("annee_cycle_ref", "string"),
            Column("grp_rep", "string"),
            Column("statut_don_an", "string"),
            Column("effectif", "string"),
            Column("ordre_ens", "string"),
            Column("classe", "string"),
            Column("class", "string"),
            Column("dist", "string"),
            Column("date_deb", "date"),
            Column("plan_interv_ehdaa", "string"),
            Column("difficulte", "string"),
            Column("age_30_sept", "int"),
            Column("categ_prog_part", "string"),
            Column("type_prog_part", "string"),
            Column("regrp_ehdaa", "string"),
            Column("motif_depart", "string"),
            Column("type_parcours", "string"),
            Column("date_deb", "date", "date_debut"),
            Column("date_depart", "date"),
            Column("grille", "string"),
        ),
    ),
    "i_e_adr": Source(
        "jade",
        "e_adr",
        (
            Column("fiche", "int"),
            Column("typeadr", "string", "type_adr"),
            Column("dateeffect", "date", "date_effect"),
            Column("datefin", "date", "date_fin"),
            Column("nociv", "string", "no_civ"),
            Column("orientrue", "string", "orient_rue"),
            Column("genrerue", "string", "genre_rue"),
            Column("rue", "string"),
            Column("app", "string"),
            Column("ville", "string"),
            Column("prov", "string"),
            Column("codepost", "string", "code_post"),
            Column("envoimeq", "int", "ind_envoi_meq"),
            Column("envoidoc", "int", "ind_envoi_doc"),
            Column("envoitrsp", "int", "ind_envoi_trsp"),
        ),
    ),
    "i_e_ri_mentions": Source(
        "jade",
        "e_ri_mentions",
        (
            Column("codeperm", "string", "code_perm"),
            Column("fiche", "int"),
            Column("ecocenoff", "string", "eco_cen_off"),
            Column("progcharl", "string", "prog_charl"),
            Column("typediplomecharl", "string", "type_diplome_charl"),
            Column("regimesanctcharl", "string", "regime_sanct_charl"),
            Column("indreussanctcharl", "string", "ind_reus_sanct_charl"),
            Column("dateobtmention", "string", "date_obt_mention"),
            Column("dateexecsanct", "string", "date_exec_sanct"),
        ),
    ),
    "i_t_prog": Source(
        "jade",
        "t_prog",
        (
            Column("prog", "string"),
            Column("progmeq", "string", "prog_meq"),
            Column("descrprog", "string", "descr_prog"),
            Column("regimesanct", "string", "regime_sanct"),
            Column("typediplome", "string", "type_diplome"),
        ),
    ),
    "i_e_adr_adultes": Source(
        "jade_adultes",
        "e_adr",
        (
            Column("fiche", "int"),
            Column("typeadr", "string"),
            Column("genrerue", "string"),
            Column("rue", "string"),
            Column("app", "string"),
            Column("ville", "string"),
            Column("casierpost", "string"),
            Column("prov", "string"),
            Column("codepost", "string", "code_post"),
            Column("pays", "string"),
            Column("envoimeq", "string"),
            Column("datefin", "string", "date_fin"),
        ),
    ),
    "i_e_ele_adultes": Source(
        "jade_adultes",
        "e_ele",
        (
            Column("fiche", "int"),
            Column("codeperm", "string", "code_perm"),
            Column("nom", "string"),
            Column("pnom", "string", "prenom"),
            Column("datenaiss", "string", "date_naissance"),
            Column("indlieunaisselen", "string", "ind_lieu_naissance_n"),
            Column("langmatern", "string", "lang_matern"),
            Column("sexe", "string", "genre"),
        ),
    ),
    "i_e_freq_adultes": Source(
        "jade_adultes",
        "e_freq",
        (
            Column("fiche", "int"),
            Column("annee", "int"),
            Column("datedeb", "string", "date_deb"),
            Column("datefin", "string", "date_fin"),
            Column("statut", "string"),
            Column("org", "string"),
            Column("ecocen", "string", "eco_cen"),
            Column("bat", "string"),
            Column("client", "string"),
            Column("freq", "int"),
            Column("prog", "string"),
            Column("activform", "string", "activ_form"),
            Column("donpers", "string"),
            Column("condadmiss", "string", "cond_admiss"),
            Column("serviceenseign", "string", "service_enseign"),
            Column("orghor", "string", "org_hor"),
            Column("typeactiv", "string", "type_activ"),
            Column("datefinsifca", "string", "date_fin_sifca"),
            Column("motifdep", "string", "motif_depart"),
            Column("raisondepart", "string", "raison_depart"),
            Column("raisongratscol", "string", "raison_grat_scol"),
            Column("typeparcours", "string", "type_parcours"),
            Column("indtransm", "int", "ind_transm"),
        ),
    ),
    "i_e_o_orghor_adultes": Source(
        "jade_adultes",
        "o_orghor",
        (
            Column("ecocen", "string", "eco_cen"),
            Column("orghor", "string", "org_hor"),
            Column("descr", "string"),
        ),
    ),
    "i_t_ecocen_adultes": Source(
        "jade_adultes",
        "t_ecocen",
        (
            Column("ecocen", "string", "eco_cen"),
            Column("descr", "string"),
            Column("vpdclient", "string"),
            Column("cal", "string"),
        ),
    ),
    "i_t_motif_adultes": Source(
        "jade_adultes",
        "t_motif",
        (
            Column("motif", "string"),
            Column("descr", "string"),
            Column("indabsjus", "string", "ind_abs_jus"),
        ),
    ),
    "i_t_prog_adultes": Source(
        "jade_adultes",
        "t_prog",
        (
            Column("prog", "string"),
            Column("progmeq", "string", "prog_meq"),
            Column("descrprog", "string", "descr_prog"),
            Column("descrproglong", "string", "descr_prog_long"),
            Column("regimesanct", "string", "regime_sanct"),
            Column("typediplome", "string", "type_diplome"),
        ),
    ),
    "i_t_wl_descr_adultes": Source(
        "jade_adultes",
        "wl_descr",
        (
            Column("code", "string"),
            Column("cf_descr", "string"),
            Column("nom_table", "string"),
        ),
    ),
    "i_pai_hchq": Source(
        "paie",
        "pai_hchq",
        (
            Column("matr", "string"),
            Column("gr_paie", "string"),
            Column("no_cheq", "string"),
            Column("date_cheq", "date"),
            Column("etat_cheq", "int"),
            Column("an_budg", "string"),
            Column("no_per", "string"),
        ),
    ),
    "i_pai_hchq_pmnt": Source(
        "paie",
        "pai_hchq_pmnt",
        (
            Column("matr", "string"),
            Column("no_seq", "int"),
            Column("code_pmnt", "string"),
            Column("corp_empl", "string"),
            Column("lieu_trav", "string"),
            Column("mode", "string"),
            Column("nb_unit", "decimal(12,4)"),
            Column("ref_empl", "string"),
            Column("no_cheq", "string"),
            Column("date_cheq", "date"),
            Column("date_deb", "date"),
            Column("date_fin", "date"),
            Column("code_prov", "string"),
            Column("mnt", "decimal(14,2)"),
            Column("mnt_cour_trait_diff", "decimal(14,2)"),
            Column("no_cmpt_cour_trait_diff", "string"),
        ),
    ),
    "i_pai_hchq_pmnt_dist_cmpt": Source(
        "paie",
        "pai_hchq_pmnt_dist_cmpt",
        (
            Column("matr", "string"),
            Column("date_cheq", "date"),
            Column("no_cheq", "string"),
            Column("no_seq", "int"),
            Column("no_cmpt", "string"),
            Column("mnt_dist", "decimal(14,2)"),
        ),
    ),
    "i_pai_hemp": Source(
        "paie",
        "pai_hemp",
        (
            Column("matr", "string"),
            Column("date_eff", "date"),
            Column("sect", "string"),
            Column("aff", "string"),
            Column("lieu_trav", "string"),
            Column("corp_empl", "string"),
            Column("etat", "string"),
            Column("mode", "string"),
            Column("stat_eng", "string"),
            Column("type", "string"),
            Column("ref_empl", "string"),
            Column("date_fin", "date"),
            Column("pourc_post", "double"),
            Column("pourc_sal", "double"),
            Column("pourc_temp", "double"),
            Column("nb_hre_sem", "double"),
        ),
    ),
    "i_pai_qualif": Source(
        "paie",
        "pai_cand_qualif",
        (
            Column("matr", "string"),
            Column("type_qualif", "string"),
            Column("date_expir", "date"),
        ),
    ),
    "i_pai_tab_cal_per": Source(
        "paie",
        "pai_tab_cal_per",
        (
            Column("gr_paie", "string"),
            Column("an_budg", "string"),
            Column("no_per", "string"),
            Column("date_deb", "date"),
            Column("date_fin", "date"),
            Column("date_cheq", "date"),
            Column("nb_jour_pay", "int"),
            Column("an_fisc", "string"),
        ),
    ),
    "i_pai_tab_corp_empl": Source(
        "paie",
        "pai_tab_corp_empl",
        (
            Column("descr", "string"),
            Column("corp_empl", "string"),
            Column("nb_hres_an", "double"),
        ),
    ),
    "i_pai_tab_corp_empl_date": Source(
        "paie",
        "pai_tab_corp_empl_date",
        (
            Column("corp_empl", "string"),
            Column("descr", "string"),
            Column("date_deb", "date"),
            Column("date_fin", "date"),
            Column("nb_hres_an", "double"),
            Column("corp_empl_percos", "string"),
        ),
    ),
    "i_pai_tab_etat_empl": Source(
        "paie",
        "pai_tab_etat_empl",
        (
            Column("descr", "string"),
            Column("etat_empl", "string"),
            Column("trait_spec", "string"),
        ),
    ),
    "i_pai_tab_mot_abs": Source(
        "paie",
        "pai_tab_mot_abs",
        (
            Column("mot_abs", "string"),
            Column("descr", "string"),
            Column("code_pmnt_a_exonerer", "string"),
        ),
    ),
    "i_pai_tab_pmnt": Source(
        "paie",
        "pai_tab_pmnt",
        (
            Column("code_pmnt", "string"),
            Column("descr", "string"),
        ),
    ),
    "i_fin_nomen_unit_adm": Source(
        "dofin",
        "fin_nomen_unit_adm",
        (
            Column("exer_fin", "string"),
            Column("code", "string"),
            Column("descr", "string"),
        ),
    ),
}

_PERIODS = ", ".join(f"per_{i:02d} string" for i in range(1, 21))

# Columns of inputs that a site or a parent project supplies.
CONTRACTS: dict[str, str] = {
    "i_gpm_t_eco": "id_eco int, annee int, eco string",
    "i_gpm_t_cal": f"id_eco int, date_evenement date, grille string, jour_cycle string, {_PERIODS}",
    "i_gpm_t_mat_grp": "id_eco int, id_mat_grp int, mat string",
    "i_gpm_t_motif_abs": "id_eco int, motif_abs string, descr string, cpt_abs int",
    "i_gpm_t_org_annee": "annee int, date_deb date, date_fin date",
    "i_gpm_e_ele": "fiche int, nom string, pnom string, code_perm string",
    "stg_fact_fiche_etapes": (
        "fiche int, id_eco int, etape string, etape_description string, seq_etape int, "
        "date_debut date, date_fin date"
    ),
    "dim_mapper_schools": (
        "id_eco int, eco string, annee int, annee_scolaire string, "
        "school_friendly_name string"
    ),
    "stg_descr_mat": "id_eco int, mat string, description_abreg string",
    "spine": (
        "code_perm string, id_eco int, annee int, fiche int, population string, "
        "eco string, seqid int"
    ),
    "stg_type_mesure": "fiche int, id_eco int, type_mesure string, is_francisation int",
    "i_wl_descr": "code string, nom_table string, cf_descr_abreg string",
    "stg_populations_adultes": "code_perm string, fiche int, annee int, freq int, population string",
    "i_hcha_pai_dos_empl": "matr string, date_eff date, ref_empl string, date_creat timestamp",
    "i_pai_dos": "matr string, date_nais date, date_entr date, date_dern_paie date, sexe string",
    "i_pai_dos_empl": "matr string, ref_empl string, ind_empl_princ int",
    "dim_employees": (
        "matr string, birth_date date, last_pay_date date, genre string, "
        "legal_name string, sex_friendly_name string"
    ),
    "dim_employment_status_yearly": "etat_empl string, school_year int, etat_actif int, empl_retr int, is_current int",
    "dim_engagement_status_yearly": "stat_eng string, school_year int, is_reg int, is_current int",
    "dim_mapper_job_group": "job_group string, job_group_category string",
    "dim_mapper_workplace": "workplace string, workplace_name string",
    "i_pai_tab_stat_eng": "stat_eng string, descr_stat_eng string",
    "i_pai_tab_lieu_trav": "lieu_trav string, descr string",
    "i_identite": (
        "cle_organisationnelle string, compte_authentification string, nom string, "
        "prenom string, ecoles string, corps_emploi string, ecole_principale string, "
        "description_corps_emploi_principal string"
    ),
}

# Declared columns of the CSV seeds.
SEEDS: dict[str, str] = {
    "pmnt_zero_keep": "code_pmnt string, descr string",
    "pmnt_exclude_etc": "code_pmnt string, descr string",
    "ens_qualification": "code string, descr string, is_qualified boolean",
    "statut_enseignant": "code string, statut string",
    "secteur": "lieu_trav string, secteur_Id string, secteur_Descr string, ordre_Ens string",
    "cibles_etc": "an_budg string, nb_hres_an double, nb_etc double",
    "adjust_nomen_unit_adm": "current_lieu_trav string, new_lieu_trav string, new_descr string",
    "etat_empl": (
        "etat_empl string, descr string, empl_retr int, empl_cong int, cong_lt int, "
        "etat_actif int, valid_from date, valid_until date"
    ),
    "stat_eng": "stat_eng string, descr string, is_reg int, valid_from date, valid_until date",
}


def project(df: DataFrame, source: Source) -> DataFrame:
    """Take, rename and type the columns of a source table; anything else is pruned."""
    known = {c.lower() for c in df.columns}
    missing = [c.upstream for c in source.columns if c.upstream.lower() not in known]
    if missing:
        raise ValueError(f"{source.database}.{source.table} lacks {', '.join(missing)}")
    return df.select(*[F.col(c.upstream).cast(c.type).alias(c.name) for c in source.columns])
