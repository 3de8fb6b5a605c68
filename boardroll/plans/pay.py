"""Pay: hours paid per cheque line and account, and full-time equivalents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardroll.functions import concat_blank, insert_at, is_blank, paid_hours, ratio
from boardroll.operators import Buckets, allocate, in_lanes, join_codes, laned, point_in_interval_join, unlaned
from boardroll.operators.dealing import LANE
from boardroll.params import Params
from boardroll.sources import flag_codes

# Job-class prefixes, engagement codes and hours of work.
TEACHER_PREFIX, PROFESSIONAL_PREFIX, HOURLY_TEACHER_PREFIX = "3", "2", "35"
SPECIAL_ENGAGEMENTS, SPECIAL_DAY = ("E1", "E2", "E3", "E8", "E9"), 6.4
DAYS_PER_WEEK = 5.0
TEACHER_DAYS, PROFESSIONAL_DAYS, SUPPORT_DAYS = 200.0, 260.9, 260.0
HOURLY_TEACHER_HOURS, TEACHER_HOURS = 800.0, 1080.0
IGNORED_ENGAGEMENT = "^9.$"
FULL_TIME_HOURS = 1826.3
PAID_PREFIXES = ("1", "2", "3", "4", "5")
ISSUED = 3

# Payment codes that are paid hours, by kind of pay.
REGULAR, ABSENCE, OVERTIME = "1", "2", "3"
REGULAR_CODES, ABSENCE_CODES, OVERTIME_CODES = "^101[0-4]..$", "^103[5-9]..$", "^1015..$"
SPECIAL_CODE = "105001"
EXEMPTED_PREFIX = "103"
IGNORED_ORIGINS = ("A5", "A6", "AJ", "AK", "AL", "AS", "AT", "AU", "AV", "AW")
SMALL_ORIGIN, SMALL_UNITS, OTHER_ORIGINS = "AX", (0.0, 60.0), ("AY", "A0")
PAY_LABELS = {
    REGULAR: "Traitement régulier",
    ABSENCE: "Absences",
    OVERTIME: "Temps supplémentaire",
}
ACCOUNT_DASHES = (4, 6, 12)

# Rows without an employee are spread by these.
_JOB, _LINE = ("date_eff", "ref_empl"), ("no_cheq", "no_seq")


def employment_perimeter(
    jobs: DataFrame, job_classes: DataFrame, statuses: DataFrame, params: Params
) -> DataFrame:
    """Job intervals with hours per day and the part of a deferred sabbatical not paid."""
    dated = job_classes.select("corp_empl", "date_deb", "date_fin", "nb_hres_an").withColumnsRenamed(
        {"nb_hres_an": "class_hours", "date_fin": "class_end"}
    )
    special = statuses.select(F.col("etat_empl").alias("etat"), "trait_spec")
    classed = point_in_interval_join(
        jobs.filter(~F.col("stat_eng").rlike(IGNORED_ENGAGEMENT)),
        dated,
        ["corp_empl"],
        "date_eff",
        "date_deb",
        "class_end",
        buckets=Buckets(last=params.as_of),
    )
    # By employee, as what the jobs are joined to later; the rest of this happens in place.
    rows = join_codes(laned(classed, "matr", otherwise=_JOB), special, "etat", "matr", *_JOB)
    job = F.col("corp_empl")
    weekly = (F.lower("mode") == "h") & (F.col("nb_hre_sem") != 0)
    per_day = (
        F.when(~job.startswith(TEACHER_PREFIX) & weekly, F.col("nb_hre_sem") / DAYS_PER_WEEK)
        .when(
            job.startswith(TEACHER_PREFIX) & F.col("stat_eng").isin(*SPECIAL_ENGAGEMENTS),
            F.lit(SPECIAL_DAY),
        )
        .when(job.startswith(TEACHER_PREFIX), F.col("class_hours") / TEACHER_DAYS)
        .when(job.startswith(PROFESSIONAL_PREFIX), F.col("class_hours") / PROFESSIONAL_DAYS)
        .otherwise(F.col("class_hours") / SUPPORT_DAYS)
    )
    per_year = F.when(
        job.startswith(HOURLY_TEACHER_PREFIX), F.lit(HOURLY_TEACHER_HOURS)
    ).otherwise(F.lit(TEACHER_HOURS))
    worked = F.col("pourc_post") * F.col("pourc_temp") / 100.0
    missing = (
        F.when(
            (F.col("trait_spec") == "1") & (F.col("pourc_sal") >= 2.0),
            F.round(worked - F.col("pourc_sal"), 4),
        )
        .when(F.col("trait_spec") == "2", F.lit(0.0))
        .otherwise(F.lit(100.0))
    )
    known = rows.select(
        "matr",
        "date_eff",
        "date_fin",
        "lieu_trav",
        "ref_empl",
        "stat_eng",
        "sect",
        "aff",
        F.col("etat").alias("etat_empl"),
        per_day.alias("hntj"),
        per_year.alias("nb_hres_an"),
        "pourc_post",
        "pourc_temp",
        missing.alias("pourc_sabbatique_manquant"),
        LANE,
    )
    return unlaned(known.distinct(), "matr", otherwise=_JOB)


def account_splits(splits: DataFrame, params: Params) -> DataFrame:
    """Amount of each cheque line per account; the workplace is the account's prefix."""
    kept = splits.filter(F.col("date_cheq") >= F.lit(params.pay_from))
    summed = (
        laned(kept.select("matr", "date_cheq", *_LINE, "no_cmpt", "mnt_dist"), "matr", otherwise=_LINE)
        .groupBy("matr", "date_cheq", "no_cheq", "no_seq", "no_cmpt", LANE)
        .agg(F.sum("mnt_dist").alias("mnt_dist"))
        .select(
            "matr",
            "date_cheq",
            "no_cheq",
            "no_seq",
            "no_cmpt",
            F.left("no_cmpt", F.lit(3)).alias("lieu_trav_cpt_budg"),
            "mnt_dist",
            LANE,
        )
    )
    return unlaned(summed, "matr", otherwise=_LINE)


def pay_kind(code: Column) -> Column:
    """Kind of pay of a payment code; null for a code that is not paid hours."""
    return (
        F.when(code.rlike(REGULAR_CODES) | (code == SPECIAL_CODE), REGULAR)
        .when(code.rlike(ABSENCE_CODES), ABSENCE)
        .when(code.rlike(OVERTIME_CODES), OVERTIME)
    )


def _counted_payments(
    payments: DataFrame, payment_codes: DataFrame, absence_reasons: DataFrame
) -> DataFrame:
    """Payment lines that are paid hours; all but the join to the codes that count reach the scan."""
    code, origin = F.col("code_pmnt"), F.col("code_prov")
    special = code == SPECIAL_CODE
    counted = (
        ((code != SPECIAL_CODE) & ~origin.isin(*IGNORED_ORIGINS))
        | (special & (origin == SMALL_ORIGIN) & F.col("nb_unit").between(*SMALL_UNITS))
        | (special & origin.isin(*OTHER_ORIGINS))
    )
    exempted = absence_reasons.select(F.col("code_pmnt_a_exonerer").alias("code_pmnt")).filter(
        F.col("code_pmnt").startswith(EXEMPTED_PREFIX)
    )
    paid = payment_codes.select("code_pmnt").join(exempted, "code_pmnt", "left_anti")
    lines = (
        payments.filter(F.left("corp_empl", F.lit(1)).isin(*PAID_PREFIXES))
        .filter(~is_blank("mode"))
        .withColumn("typeremun", pay_kind(code))
        .filter(F.col("typeremun").isNotNull() & counted)
    )
    # An inner join, as Spark would move a semi join to before the dealing.
    return join_codes(laned(lines, "matr"), paid.distinct(), "code_pmnt", "matr", "no_cheq", "no_seq")


def paid_hours_by_account(
    periods: DataFrame,
    cheques: DataFrame,
    payments: DataFrame,
    perimeter: DataFrame,
    payment_codes: DataFrame,
    absence_reasons: DataFrame,
    splits: DataFrame,
    kept_zero_codes: DataFrame,
    params: Params,
) -> DataFrame:
    """Hours paid per cheque line, shared over the accounts that bear it.

    Hours of a deferred-pay sabbatical are scaled up to the work they stand for.
    ``kept_zero_codes`` lists the payments whose hours count although no money was paid.

    Cheques, payments, jobs and splits are each dealt once, by employee, and all else happens in place: a
    line meets every job of its place and day, and such rows are too many to be shuffled.
    """
    calendar = periods.filter(F.col("date_fin") >= F.lit(params.pay_from)).select(
        "gr_paie", "an_budg", "no_per", F.col("date_cheq").alias("period_cheq"),
        F.col("date_deb").alias("period_start"), F.col("date_fin").alias("period_end"),
    )
    paid = cheques.filter(F.col("etat_cheq") == ISSUED).select(
        "matr", "no_cheq", "date_cheq", "gr_paie", "an_budg", "no_per"
    )
    issued = laned(paid, "matr").join(in_lanes(calendar), ["gr_paie", "an_budg", "no_per", LANE])
    # Lines meet cheques of their day, so others than these days' need not be dealt.
    days = issued.agg(F.struct(F.min("date_cheq").alias("first"), F.max("date_cheq").alias("last"))).scalar()
    lines = (
        _counted_payments(
            payments.filter(F.col("date_cheq").between(days["first"], days["last"])), payment_codes, absence_reasons
        )
        .select(
            "matr", "no_cheq", "date_cheq", "no_seq", "code_pmnt", "ref_empl", "typeremun",
            "mode", "nb_unit", "mnt", "mnt_cour_trait_diff",
            F.col("corp_empl").alias("corp_emploi"), F.col("lieu_trav").alias("line_place"),
            F.col("date_deb").alias("date_deb_pmnt"), F.col("date_fin").alias("date_fin_pmnt"), LANE,
        )
        .join(issued, ["matr", "no_cheq", "date_cheq", LANE])
    )
    placed = point_in_interval_join(
        lines,
        laned(perimeter, "matr", otherwise=_JOB),
        ["matr", "ref_empl", LANE],
        "date_deb_pmnt",
        "date_eff",
        "date_fin",
        buckets=Buckets(last=params.as_of),
    )
    hours = paid_hours("mode", "nb_unit", "hntj", "nb_hres_an")
    missing = F.col("pourc_sabbatique_manquant")
    worked = F.col("pourc_post") * F.col("pourc_temp") / 100.0
    partly_paid = (missing != 0) & (missing != 100)
    scaled = (
        F.when(
            partly_paid
            & (F.col("date_deb_pmnt") != F.col("date_fin_pmnt"))
            & (F.col("mnt_cour_trait_diff") != 0),
            ratio(worked * F.col("hours"), worked - missing),
        )
        .when(missing == 0, F.lit(0.0))
        .otherwise(F.col("hours"))
    )
    measured = placed.withColumn("hours", hours).select(
        F.left("an_budg", F.lit(4)).alias("annee"),
        "an_budg",
        "no_per",
        "gr_paie",
        "no_cheq",
        F.col("period_cheq").alias("date_cheq"),
        F.col("period_start").alias("date_deb"),
        F.col("period_end").alias("date_fin"),
        "date_deb_pmnt",
        "date_fin_pmnt",
        "matr",
        "corp_emploi",
        "stat_eng",
        "sect",
        "aff",
        "etat_empl",
        "typeremun",
        "mode",
        "no_seq",
        "code_pmnt",
        F.coalesce("line_place", "lieu_trav").alias("lieu_trav"),
        scaled.cast("decimal(7,2)").alias("hours"),
        (F.col("mnt") + F.col("mnt_cour_trait_diff")).alias("mnt_tot"),
        LANE,
    )
    # Lines without an account are not reported, so an inner join keeps all that counts.
    accounts = laned(splits, "matr", otherwise=_LINE).select(
        "matr", "no_cheq", "no_seq", "no_cmpt", "lieu_trav_cpt_budg", "mnt_dist", LANE
    )
    split = measured.join(accounts, ["matr", "no_cheq", "no_seq", LANE])
    shared = allocate(
        flag_codes(split, kept_zero_codes, "code_pmnt", "kept", "matr", "no_cheq", "no_seq", "no_cmpt"),
        ["an_budg", "no_cheq", "matr", "no_seq", LANE],
        quantity="hours",
        part="mnt_dist",
        total="mnt_tot",
        keep_zero=F.col("kept"),
        name="nb_hre_remun_dist",
    ).drop("kept", "hours", "mnt_tot")
    grain = [c for c in shared.columns if c not in ("nb_hre_remun_dist", "mnt_dist")]
    rows = (
        shared.groupBy(*grain)
        .agg(F.sum("nb_hre_remun_dist").alias("nb_hre_remun_dist"), F.sum("mnt_dist").alias("mnt_dist"))
        .filter(F.col("lieu_trav_cpt_budg").isNotNull() & (F.col("nb_hre_remun_dist") != 0))
        .withColumn("no_cmpt", insert_at("no_cmpt", "-", *ACCOUNT_DASHES))
        .withColumnRenamed("lieu_trav_cpt_budg", "unite_admin")
    )
    return unlaned(rows, "matr")


def admin_unit_names(units: DataFrame, remap: DataFrame | None = None) -> DataFrame:
    """Administrative units per fiscal year; an optional table renames and merges some."""
    rows = units.select("exer_fin", F.col("code").alias("current_lieu_trav"), "descr")
    if remap is None:
        new_code, new_name = F.col("current_lieu_trav"), F.col("descr")
    else:
        rows = rows.join(
            remap.select("current_lieu_trav", "new_lieu_trav", "new_descr"),
            "current_lieu_trav",
            "left",
        )
        new_code = F.coalesce("new_lieu_trav", "current_lieu_trav")
        new_name = F.coalesce("new_descr", "descr")
    return rows.select(
        "exer_fin",
        "current_lieu_trav",
        new_code.alias("new_lieu_trav"),
        F.lower(new_name).alias("descr"),
    ).distinct()


# Labels of the full-time report that need no lookup.
_PLACED = ("code_lieu_trav", "an_budg", "no_per", "type_remun")


def full_time_report(
    hours: DataFrame,
    units: DataFrame,
    job_groups: DataFrame,
    job_classes: DataFrame,
    engagements: DataFrame,
) -> DataFrame:
    """Paid hours and full-time equivalents by period, account and labels.

    Hours are summed over the codes first and the lookups joined to that result. A label
    made of a code and a name is ' - ' when neither is known.

    The hours are dealt once, by the labels that no lookup is needed for: rows of a label, and
    so of a code, are then in one place, and the lookups come there.
    """
    kind = F
    for code, label in PAY_LABELS.items():
        kind = kind.when(F.col("typeremun") == code, F.lit(label))
    coded = ["an_budg", "no_per", "no_cmpt", "corp_emploi", "unite_admin", "lieu_trav", "stat_eng", "typeremun"]
    known = {
        "_year": concat_blank(F.left("an_budg", F.lit(4)), F.lit("-"), F.right("an_budg", F.lit(4))),
        "_period": F.col("no_per").cast("int"),
        "_kind": kind.otherwise(F.lit("-")),
    }
    placed = laned(
        hours.select(*coded, "nb_hre_remun_dist").withColumns(known), "no_cmpt", "lieu_trav", *known, otherwise=["lieu_trav", *known]
    )
    summed = placed.groupBy(*coded, *known, LANE).agg(F.sum("nb_hre_remun_dist").alias("hours"))
    named_units = units.select(
        F.col("exer_fin").alias("an_budg"),
        F.col("current_lieu_trav").alias("unite_admin"),
        F.col("new_lieu_trav").alias("new_unit"),
        F.col("descr").alias("unit_name"),
    )
    category = job_groups.select(F.col("job_group").alias("corp_emploi"), "job_group_category")
    classes = job_classes.select(F.col("corp_empl").alias("corp_emploi"), F.col("descr").alias("job_name"))
    statuses = engagements.select("stat_eng", "descr_stat_eng")
    dash = F.lit(" - ")
    named = summed.join(in_lanes(named_units), ["an_budg", "unite_admin", LANE], "left")
    for lookup, code in ((category, "corp_emploi"), (classes, "corp_emploi"), (statuses, "stat_eng")):
        named = join_codes(named, lookup, code, how="left")
    labelled = named.select(
        F.col("_year").alias("an_budg"),
        F.col("_period").alias("no_per"),
        "no_cmpt",
        F.coalesce("job_group_category", F.lit("-")).alias("cat_emploi"),
        concat_blank("corp_emploi", dash, "job_name").alias("corp_emploi"),
        F.col("lieu_trav").alias("code_lieu_trav"),
        F.col("new_unit").alias("unite_admin"),
        concat_blank("new_unit", dash, "unit_name").alias("descr_unite_admin"),
        concat_blank("stat_eng", dash, "descr_stat_eng").alias("stat_eng"),
        F.col("_kind").alias("type_remun"),
        "hours",
        LANE,
    )
    labels = [c for c in labelled.columns if c != "hours"]
    rows = labelled.groupBy(*labels).agg(
        F.sum("hours").alias("nombre_heures_remun"),
        (F.sum("hours") / FULL_TIME_HOURS).alias("equivalent_temps_plein"),
    )
    return unlaned(rows, "no_cmpt", *_PLACED, otherwise=_PLACED)
