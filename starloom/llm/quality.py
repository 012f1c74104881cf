"""Quality rules: text statistics, plain limits, and robust multivariate outliers per language and source (op6).

Each document's statistics become a vector of five transformed values: log word count, log mean word length, and
the logs of symbols, repeated lines and repeated words per 100 words. For every (language, source) a
minimum-covariance-determinant estimate is found by concentration steps: starting from medians and absolute
deviations, the share ``support`` of documents with the smallest Mahalanobis distances gives the next mean and
covariance, until the steps are used up. The scale is made consistent by the median distance. A document whose
squared distance exceeds ``cutoff`` is rejected.

Documents that fail the plain limits are judged by them alone and do not enter the estimates. Groups
with fewer than ``least`` documents are pooled by language, and what is still too small is pooled once more; if even
that pool is too small, its documents are kept. Each variance has a floor, so a statistic that is zero in nearly all
documents of a group does not reject the first one that has any.

Only DataFrame functions are used. Whole groups never meet in a task: an estimate is a set of sums and a
percentile sketch, combined before the shuffle.

Defined cases: null or empty texts have zero counts and fail the limits; null languages and sources are groups of
their own; repeated rows get the same verdict; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import BLANKS, cut_lineage, let, load, small_side

LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"
WIDTH = 5

SUPPORT = 0.75
STEPS = 3
LEAST_ROWS = 60
#: Floors of the standard deviations of the five values, in their own units.
FLOORS = (0.5, 0.12, 0.5, 0.5, 0.5)
#: The chi-squared distribution with five degrees of freedom: its median, and its quantile at 1 - 1e-7.
CHI2_MEDIAN, CUTOFF = 4.3515, 41.0
#: Quantiles of a group are found with a rank error of one in this number.
ACCURACY = 10_000
#: Estimates of up to this many groups (some 200 bytes each) are broadcast; more are joined by shuffles.
MOST_POOLS = 50_000


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def _repeated_words(words: Column) -> Column:
    """Words inside ``WIDTH``-word windows that occur twice or more. Windows are compared by 64-bit hashes; the
    ones with an equal neighbour in sorted order are repeated, and consecutive repeated windows overlap."""
    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def from_pairs(p: Column) -> Column:
            repeated = F.filter(
                F.transform(p, lambda x, i: F.when(
                    ((i > 0) & (F.get(p, i - 1)["h"] == x["h"])) | (F.get(p, i + 1)["h"] == x["h"]), x["i"])),
                lambda at: at.isNotNull())
            start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WIDTH).alias("last"))
            return F.aggregate(
                F.array_sort(repeated), start,
                lambda a, at: F.struct((a["n"] + F.least(at - a["last"], F.lit(WIDTH))).cast("long").alias("n"), at.alias("last")),
                lambda a: a["n"])
        return let(pairs, from_pairs)

    def windows_of(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WIDTH),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WIDTH)]))
    none = F.lit(0).cast("long")
    hashed = let(F.transform(words, lambda w: F.xxhash64(w)),
                 lambda h: F.when(F.size(h) < WIDTH + 1, none).otherwise(
                     let(windows_of(h), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), none).otherwise(covered(g)))))
    return hashed


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = let(_words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        _repeated_words(w).alias("n_repeat_words")))
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return docs.select(
        "doc_id", "lang", "source", counted.alias("c"), lines.alias("n_dup_lines"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    ).select("doc_id", "lang", "source", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def _vector() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p("n_words"), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
            *[F.log1p(100.0 * F.col(c) / n) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]]


X = [f"x{i}" for i in range(5)]


def _grouped(points: DataFrame, least: int) -> DataFrame:
    """Add ``pool``: the (language, source), language or common group whose estimate judges the row; null if none
    is large enough."""
    def label(level: str, *cols: str) -> Column:
        return F.to_json(F.struct(F.lit(level).alias("level"), *cols))
    fine = points.withColumn("fine", label("source", "lang", "source")).withColumn("wide", label("lang", "lang"))
    sizes = fine.groupBy("fine", "wide").count()
    small = sizes.where(F.col("count") < least)
    by_lang = small.groupBy("wide").agg(F.sum("count").alias("wide_count"))
    left = by_lang.where(F.col("wide_count") < least).agg(F.sum("wide_count")).first()[0] or 0
    # At most one row per (language, source): it decides which pool a small group joins.
    pools = (sizes.join(by_lang, "wide", "left")
             .select("fine", F.when(F.col("count") >= least, F.col("fine")).when(F.col("wide_count") >= least, F.col("wide"))
                     .when(F.lit(left >= least), F.lit("all")).alias("pool")))
    return fine.drop("wide").join(small_side(cut_lineage(pools), MOST_POOLS), "fine").drop("fine")


def _start(points: DataFrame) -> DataFrame:
    """Medians and scaled absolute deviations of each pool, as a diagonal first estimate."""
    centre = points.groupBy("pool").agg(*[F.percentile_approx(x, 0.5, ACCURACY).alias(f"m{i}") for i, x in enumerate(X)])
    centre = cut_lineage(centre)
    spread = (points.join(small_side(centre, MOST_POOLS), "pool").groupBy("pool")
              .agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, ACCURACY).alias(f"s{i}") for i, x in enumerate(X)]))
    est = centre.join(spread, "pool")
    whiten = {(i, j): (1.0 / F.greatest(1.4826 * F.col(f"s{i}"), F.lit(FLOORS[i])) if i == j else F.lit(0.0))
              for i in range(5) for j in range(i + 1)}
    return cut_lineage(est.select("pool", *[f"m{i}" for i in range(5)],
                                  *[v.cast("double").alias(f"w{i}{j}") for (i, j), v in whiten.items()]))


def _distance(points: DataFrame, est: DataFrame) -> DataFrame:
    """Add d2, the squared Mahalanobis distance: the rows of the whitening matrix times the centred vector."""
    rows = [reduce(lambda a, b: a + b, [F.col(f"w{i}{j}") * (F.col(X[j]) - F.col(f"m{j}")) for j in range(i + 1)]) for i in range(5)]
    return points.join(small_side(est, MOST_POOLS), "pool").withColumn("d2", reduce(lambda a, b: a + b, [r * r for r in rows]))


def _refit(points: DataFrame, est: DataFrame, support: float) -> DataFrame:
    """One concentration step: moments of each pool's closest documents, and the whitening matrix (the inverse of
    the covariance's Cholesky factor), column by column."""
    measured = _distance(points, est)
    limit = cut_lineage(measured.groupBy("pool").agg(F.percentile_approx("d2", support, ACCURACY).alias("limit")))
    near = measured.join(small_side(limit, MOST_POOLS), "pool").where(F.col("d2") <= F.col("limit"))
    # Sums are taken around the previous centre, where they lose no digits.
    c = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(X)]
    sums = near.groupBy("pool").agg(
        F.count("*").alias("n"), *[F.first(f"m{i}").alias(f"o{i}") for i in range(5)],
        *[F.sum(c[i]).alias(f"s{i}") for i in range(5)],
        *[F.sum(c[i] * c[j]).alias(f"s{i}{j}") for i in range(5) for j in range(i + 1)])
    df = cut_lineage(sums)
    df = df.select("pool", *[(F.col(f"o{i}") + F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(5)],
                   *[(F.col(f"s{i}{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / (F.col("n") * F.col("n"))
                      + F.lit(FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i in range(5) for j in range(i + 1)])
    for i in range(5):
        for j in range(i + 1):
            done = [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)]
            rest = reduce(lambda a, b: a - b, done, F.col(f"c{i}{j}"))
            df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    for i in range(5):
        for j in range(i, -1, -1):
            if i == j:
                value = 1.0 / F.col(f"l{i}{i}")
            else:
                value = -reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)]) / F.col(f"l{i}{i}")
            df = df.withColumn(f"w{i}{j}", value)
    return cut_lineage(df.select("pool", *[f"m{i}" for i in range(5)],
                                 *[f"w{i}{j}" for i in range(5) for j in range(i + 1)]))


def robust_outliers(stats: DataFrame, support: float = SUPPORT, steps: int = STEPS, least: int = LEAST_ROWS,
                    cutoff: float = CUTOFF) -> DataFrame:
    """``stats`` with base_failed, distance (null where none is judged) and kept."""
    stats = cut_lineage(stats.withColumn("base_failed", base_failed()))
    vectors = stats.select("*", *[v.cast("double").alias(x) for v, x in zip(_vector(), X, strict=True)])
    points = cut_lineage(_grouped(vectors.where(~F.col("base_failed")), least))
    judged = points.where(F.col("pool").isNotNull())
    est = _start(judged)
    for _ in range(steps):
        est = _refit(judged, est, support)
    measured = _distance(judged, est)
    scale = cut_lineage(measured.groupBy("pool").agg(
        F.greatest(F.percentile_approx("d2", 0.5, ACCURACY) / CHI2_MEDIAN, F.lit(1.0)).alias("scale")))
    out = measured.join(small_side(scale, MOST_POOLS), "pool").withColumn("distance", F.sqrt(F.col("d2") / F.col("scale")))
    columns = stats.columns
    rest = stats.where(F.col("base_failed")).withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    unjudged = points.where(F.col("pool").isNull()).withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(True)})
    kept = out.withColumn("kept", F.col("distance") <= F.lit(cutoff ** 0.5))
    names = [*columns, "distance", "kept"]
    return kept.select(names).unionByName(rest.select(names)).unionByName(unjudged.select(names))


def op6_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = robust_outliers(text_statistics(load(spark, sf_dir, "documents")))
    return verdict.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "kept", "lang", "source", "distance")


#: The estimates are iterative: no SQL. Tests compare the counts and verdicts with a plain numpy version.
SQL = None
