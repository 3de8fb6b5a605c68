"""Quality rules: base statistics, and robust multivariate outliers per language and source.

Statistics are computed per text with array functions, and transformed into a vector of
four: the logarithm of the number of words, the mean word length, the logarithm of symbols
per thousand word characters, and the share of words in repeated windows. For each
language and source the location and scatter of these vectors are estimated by the minimum
covariance determinant: from four starts (medians with quartile ranges; mean with variances;
scatter of spatial signs; scatter of tanh), concentration steps re-estimate from the
``core`` share of vectors that lie closest until the determinant settles, and the start
with the smallest determinant wins. Last the vectors within the 97.5 % point of a chi-square
give the estimate. Equal vectors count once, so copies of one text cannot fill the core. A
document is rejected if its squared Mahalanobis distance, scaled so that the median is that
of a chi-square, exceeds ``cutoff``.

``FLOORS`` are added to the variances (a regularised estimate), since most texts have no
symbol and no repetition at all. A group under ``least`` different vectors is judged by the
pool of the small groups of its language; if that is still smaller, by all of the language,
and if that is, by all rows of the table. So every row is judged by some estimate.

Only DataFrame and SQL functions are used. All estimates cover all rows. Groups meet in
partial aggregates and the small table of estimates is joined back without a hint, so a
source with a third of all rows is neither gathered nor a bottleneck.

Defined results: a null text has no words and fails the base rule; a null language or
source is a group of its own; repeated rows are judged alike.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardroll.llm.common import stage, text_of

_BLANK = r"[\x20\x09-\x0D]"
_SYMBOLS = "[#*$%&|<>]"
_WINDOW = 8  # a power of two: window hashes are joined from halves
P = 4
FLOORS = (0.25, 0.25, 0.5, 0.05)
"""Standard deviations that the scatter has at least, per part of the vector."""
SALTS = 32
CHI_MEDIAN = 3.3567
"""Median of a chi-square with four degrees of freedom."""
CHI_MOST = 11.1433
"""97.5 % point of a chi-square with four degrees of freedom."""
SETTLED = 1e-4
CUTOFF = 100.0
"""Squared distance from which a text is rejected. A chi-square exceeds it once in 1e20; the
statistics of prose have far heavier tails, and clean texts are to be kept."""


def _joined(name: str, width: int) -> Column:
    """Hashes of windows twice as wide as those of ``width`` words in ``name``."""
    rest = F.greatest(F.size(name) - width, F.lit(0))
    halves = F.slice(name, F.lit(1), rest), F.slice(name, F.lit(width + 1), rest)
    return F.zip_with(*halves, lambda left, right: F.xxhash64(left, right))


def base_statistics(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id, ``carry``, n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    body = text_of(docs)
    blanks = F.lit(" \t\n\x0b\x0c\r")
    trimmed = F.btrim(body, blanks)
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{_BLANK}+"))
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, blanks) != "")
    split = docs.select("doc_id", *carry, body.alias("body"), words.alias("words"), lines.alias("lines"))
    counted = split.select(
        "doc_id",
        *carry,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("windows"),
    )
    for width in (1, 2, 4):  # hashes of windows of 2, 4 and 8 words, each from two halves
        counted = counted.withColumn("windows", _joined("windows", width))
    # Windows sorted by hash show their repeats side by side; the places of these, sorted
    # again, give the words covered. Texts without a repeat skip all of it.
    kept = ["doc_id", *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    sorted_windows = F.sort_array(F.when(repeats, placed).otherwise(F.slice(placed, 1, 0)))
    beside = F.expr(
        "filter(placed, (x, k) -> (k > 0 AND placed[k - 1].h = x.h)"
        " OR (k + 1 < size(placed) AND placed[k + 1].h = x.h))"
    )
    covered = F.expr(
        "aggregate(places, named_struct('last', -8, 'words', 0L), (s, p) ->"
        " named_struct('last', p, 'words', s.words + least(8, p - s.last))).words"
    )
    return (
        counted.select(*kept, sorted_windows.alias("placed"))
        .select(*kept, F.sort_array(beside["i"]).alias("places"))
        .select(*kept, covered.alias("n_repeat_words"))
    )


def _vector() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(F.col("n_words").cast("double")).alias("x0"),
        (F.col("word_chars") / n).alias("x1"),
        F.log1p(1000 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))).alias("x2"),
        (F.col("n_repeat_words") / n).alias("x3"),
    ]


def _cells() -> list[tuple[int, int]]:
    return [(j, i) for i, j in combinations_with_replacement(range(P), 2)]


def _factor(estimates: DataFrame) -> DataFrame:
    """Adds the Cholesky factor l{j}{i} of the scatter s{j}{i} and its log determinant."""
    out = estimates
    for i in range(P):
        for j in range(i, P):
            rest = F.col(f"s{j}{i}")
            for k in range(i):
                rest = rest - F.col(f"l{j}{k}") * F.col(f"l{i}{k}")
            entry = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{i}{i}")
            out = out.withColumn(f"l{j}{i}", entry)
    return out.withColumn("logdet", sum(2 * F.log(f"l{i}{i}") for i in range(P)))


def _distance() -> Column:
    """Squared Mahalanobis distance of x from m by forward substitution with l."""
    solved: list[Column] = []
    for j in range(P):
        rest = F.col(f"x{j}") - F.col(f"m{j}")
        for k in range(j):
            rest = rest - F.col(f"l{j}{k}") * solved[k]
        solved.append(rest / F.col(f"l{j}{j}"))
    return sum(y * y for y in solved)


def _moments(names: list[str], core: Column) -> list[Column]:
    """Mean and scatter, with floors, of the vectors in ``core``."""
    x = [F.when(core, F.col(n)) for n in names]
    means = [F.avg(x[j]).alias(f"m{j}") for j in range(P)]
    cells = [F.covar_pop(x[j], x[i]) + F.lit(FLOORS[i] ** 2 if i == j else 0.0) for j, i in _cells()]
    return means + [c.alias(f"s{j}{i}") for c, (j, i) in zip(cells, _cells(), strict=True)]


def _diagonal(middles: list[Column], spreads: list[Column]) -> list[Column]:
    means = [c.alias(f"m{j}") for j, c in enumerate(middles)]
    cells = [
        (spreads[i] * spreads[i] + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"s{j}{i}") for j, i in _cells()
    ]
    return means + cells


def _beside(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """Each vector beside its group's estimates.

    Both sides also meet on ``salt``, which deals a large group over ``SALTS`` tasks; the
    aggregates above then combine within tasks before their own shuffle.
    """
    salted = estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return vectors.join(salted, ["grp", "salt"])


def _signs(first: DataFrame, vectors: DataFrame) -> list[DataFrame]:
    """Starts from the medians with the scatter of spatial signs, and with that of tanh."""
    scale = [F.greatest((F.col(f"q{j}")[2] - F.col(f"q{j}")[0]) / 1.349, F.lit(FLOORS[j])).alias(f"c{j}") for j in range(P)]
    middles = [F.col(f"q{j}")[1].alias(f"m{j}") for j in range(P)]
    centred = stage(first.select("grp", *middles, *scale), "centres")
    z = [((F.col(f"x{j}") - F.col(f"m{j}")) / F.col(f"c{j}")).alias(f"z{j}") for j in range(P)]
    z = _beside(vectors, centred).select("grp", *z)
    norm = F.greatest(sum(F.col(f"z{j}") * F.col(f"z{j}") for j in range(P)), F.lit(1e-9))
    signs = [F.avg(P * F.col(f"z{j}") * F.col(f"z{i}") / norm).alias(f"u{j}{i}") for j, i in _cells()]
    tanhs = [F.covar_pop(F.tanh(f"z{j}"), F.tanh(f"z{i}")).alias(f"t{j}{i}") for j, i in _cells()]
    found = stage(z.groupBy("grp").agg(*signs, *tanhs).join(centred, "grp"), "sign-starts")
    return [
        found.select(
            "grp", F.lit(start).alias("start"), *[f"m{j}" for j in range(P)],
            *[
                (F.col(f"{kind}{j}{i}") * F.col(f"c{j}") * F.col(f"c{i}") + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"s{j}{i}")
                for j, i in _cells()
            ],
        )
        for start, kind in ((2, "u"), (3, "t"))
    ]


def estimate(vectors: DataFrame, core: float = 0.5, steps: int = 50) -> DataFrame:
    """Robust location m*, Cholesky factor l* and median distance per ``grp``.

    ``vectors`` has grp, x0 to x3, and a salt from 0 to ``SALTS - 1`` dealt at random.
    ``steps`` only bounds the search: a start is left as soon as its determinant settles.
    The core of ``n`` vectors has at least ``(n + P + 1) / 2`` of them.
    """
    names = [f"x{j}" for j in range(P)]
    vectors = stage(vectors.select("grp", "salt", *names).dropDuplicates(["grp", *names]), "vectors")
    quartiles = [F.percentile_approx(n, [0.25, 0.5, 0.75], 1000).alias(f"q{j}") for j, n in enumerate(names)]
    spread = [F.avg(n).alias(f"a{j}") for j, n in enumerate(names)] + [
        F.stddev_pop(n).alias(f"d{j}") for j, n in enumerate(names)
    ]
    first = stage(vectors.groupBy("grp").agg(*quartiles, *spread), "starts")
    medians = _diagonal(
        [F.col(f"q{j}")[1] for j in range(P)], [(F.col(f"q{j}")[2] - F.col(f"q{j}")[0]) / 1.349 for j in range(P)]
    )
    means = _diagonal([F.col(f"a{j}") for j in range(P)], [F.col(f"d{j}") for j in range(P)])
    now = first.select("grp", F.lit(0).alias("start"), *medians).unionByName(
        first.select("grp", F.lit(1).alias("start"), *means)
    )
    for more in _signs(first, vectors):
        now = now.unionByName(more)
    # The first determinants are not those of a core, so nothing settles in the first step.
    now = stage(_factor(now).withColumn("logdet", F.lit(float("inf"))), "estimates")
    shares = [core + k * (1 - core) / 10 for k in range(11)]
    wanted = F.least(F.lit(1.0), core + (P + 1) / (2 * F.count(F.lit(1))))
    place = F.ceil((wanted - core) * 10 / (1 - core) - 0.2).cast("int") if core < 1 else F.lit(0)
    kept = ["grp", "start", "logdet", *[f"m{j}" for j in range(P)], *[f"l{j}{i}" for j, i in _cells()]]
    done = None
    for step in range(steps):
        near = _beside(vectors, now).select("grp", "start", _distance().alias("d2"))
        limit = near.groupBy("grp", "start").agg(
            F.percentile_approx("d2", shares, 1000).alias("limits"), F.greatest(place, F.lit(0)).alias("place")
        )
        limit = limit.select("grp", "start", F.element_at("limits", F.col("place") + 1).alias("limit"))
        limit = stage(now.join(limit, ["grp", "start"]), "limits")
        near = _beside(vectors, limit).select("grp", "start", "limit", *names, _distance().alias("d2"))
        fresh = _factor(near.groupBy("grp", "start").agg(*_moments(names, F.col("d2") <= F.col("limit"))))
        before = now.select("grp", "start", F.col("logdet").alias("before"))
        fresh = stage(fresh.join(before, ["grp", "start"]).select(*kept, "before"), "estimates")
        settled = F.col("before") - F.col("logdet") < SETTLED if step + 1 < steps else F.lit(True)
        part = fresh.where(settled).select(*kept)
        done = part if done is None else done.unionByName(part)
        now = fresh.where(~settled).select(*kept)
        if now.isEmpty():
            break
    best = done.groupBy("grp").agg(F.min(F.struct("logdet", "start", *kept[3:])).alias("best"))
    best = _with_middle(vectors, stage(best.select("grp", "best.*").drop("start", "logdet"), "best"))
    near = _beside(vectors, best).select("grp", "middle", *names, _distance().alias("d2"))
    inner = F.col("d2") * CHI_MEDIAN <= CHI_MOST * F.col("middle")
    whole = _factor(near.groupBy("grp").agg(*_moments(names, inner)))
    return _with_middle(vectors, stage(whole.select("grp", *kept[3:]), "reweighted"))


def _with_middle(vectors: DataFrame, best: DataFrame) -> DataFrame:
    """Adds the median distance of each group."""
    middle = _beside(vectors, best).select("grp", _distance().alias("d2"))
    middle = middle.groupBy("grp").agg(F.percentile_approx("d2", 0.5, 1000).alias("middle"))
    return stage(best.join(middle, "grp"), "estimates")


def judge(docs: DataFrame, cutoff: float = CUTOFF, least: int = 50, core: float = 0.5, steps: int = 50) -> DataFrame:
    """Base statistics, base_failed, kept and the scaled squared ``distance`` of every row."""
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    source = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rows = stage(
        base_statistics(docs.select("doc_id", "text", lang.alias("lang"), source.alias("source")), "lang", "source"),
        "statistics",
    )
    told = rows.select("lang", "source", *_vector()).distinct()
    told = stage(told, "different")
    counts = stage(told.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")), "counts")
    small = F.col("rows") < least
    pools = counts.groupBy("lang").agg(F.sum("rows").alias("all_rows"), F.sum(F.when(small, F.col("rows"))).alias("pooled"))
    own, pool = F.to_json(F.struct("lang", "source")), F.to_json(F.struct(F.col("lang").alias("pool")))
    language, table = F.to_json(F.struct(F.col("lang").alias("all"))), F.lit("{}")
    grp = (
        F.when(~small, own).when(F.col("pooled") >= least, pool).when(F.col("all_rows") >= least, language).otherwise(table)
    )
    names = stage(counts.join(pools, "lang").select("lang", "source", grp.alias("grp")), "groups")
    # A group of all of a language, or of the table, also learns from rows that others judge.
    wide = names.select("lang", "source", F.explode(F.array(language, table)).alias("grp"))
    wide = wide.join(names.select("grp").distinct(), "grp", "left_semi")
    teach = stage(names.unionByName(wide.select("lang", "source", "grp")).distinct(), "teach")
    salt = F.pmod(F.xxhash64(*[f"x{j}" for j in range(P)]), F.lit(SALTS)).cast("int").alias("salt")
    vectors = told.join(teach, ["lang", "source"]).select("grp", salt, *[f"x{j}" for j in range(P)])
    found = estimate(vectors, core, steps)
    named = stage(names.join(found, "grp"), "group-estimates")
    far = _distance() * CHI_MEDIAN / F.greatest(F.col("middle"), F.lit(1.0))
    judged = rows.join(named, ["lang", "source"], "left").select("*", *_vector())
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    distance = F.coalesce(far, F.lit(0.0))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (distance <= cutoff)).alias("kept"), distance.alias("distance"),
    )
