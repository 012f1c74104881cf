"""Mixing sources to target weights along a curriculum whose weights change over training time (op3).

Every source gets a target number of words: a share of ``epochs`` times all words by weight, at most
``max_repeat`` times what it has, the excess reshared by weight. Its words are consumed in a fixed random order of
its documents, epoch after epoch, until the target is met; a word's place in that stream is the source's
*demand* so far. The source's weight schedule, integrated over training time, gives the demand it wants by each
moment; inverting that integral turns a document's place in the stream into its training position in [0, 1], and
a range sort by position interleaves the sources.

Everything is DataFrame algebra. The running demand is a two-level prefix sum: sums per (source, hash
bucket), a window over a source's buckets, and a window within each bucket, so that a source with a third of all rows
is spread over hundreds of tasks. The number of buckets grows with the table.

Defined cases: a null text counts 0 words and is taken 0 times; null is a source of its own, last in order; an
empty table gives an empty result; repeated rows are mixed as separate documents. The document at which a
target is met is taken in part (``words`` of it), so a source's taken words equal its target, rounded.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import WORD, cut_lineage, free_name, load

WEIGHTS = (5, 2, 1)
EPOCHS = 1.5
MAX_REPEAT = 2
#: Relative weight of each weight class at equally spaced moments of training, linear in between: broad
#: sources fade in, the lightest fade out.
SCHEDULES = ((0.5, 1.0, 1.5), (1.0, 1.0, 1.0), (1.5, 1.0, 0.5))
ROWS_PER_BUCKET = 50_000
LEAST_BUCKETS = 256


def source_targets(sizes: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: its words, weight class and target. ``sizes`` has source and size."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on, so the unpartitioned windows hold as many rows as there are sources.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weighted = (totals
                .withColumn("weight_class", ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
                .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("weight_class") + 1))
                .withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(epochs)))
                .withColumn("most", F.col("source_size") * F.lit(float(max_repeat))))
    # Sources reach their cap in order of cap / weight; ahead of each one, what is left is shared by weight.
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("goal") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    # The level rises while sources reach their cap and falls from the first that does not: its maximum is the
    # water level of all uncapped sources.
    filled = (weighted.withColumn("level", level).withColumn("level", F.max("level").over(everything))
              .withColumn("even", F.col("level") * F.col("weight")))
    return filled.select("source", "source_size", "weight_class", F.least("most", "even").alias("target"))


def training_time(demand: Column, schedule: tuple[float, ...]) -> Column:
    """The moment at which a source following ``schedule`` has consumed the share ``demand`` of its target: the
    inverse of the schedule's integral, which is quadratic between two knots."""
    h = 1.0 / (len(schedule) - 1)
    area = sum((a + b) / 2 * h for a, b in zip(schedule, schedule[1:], strict=False))
    v = [x / area for x in schedule]
    done, out = 0.0, None
    for k, (a, b) in enumerate(zip(v, v[1:], strict=False)):
        rest = demand - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * (b - a) / h) * rest, F.lit(0.0)))
        here = F.lit(k * h) + F.lit(2.0) * rest / F.greatest(F.lit(a) + root, F.lit(1e-12))
        done += (a + b) / 2 * h
        out = F.when(demand <= done, here) if out is None else out.when(demand <= done, here)
    return F.least(F.greatest(out.otherwise(F.lit(1.0)), F.lit(0.0)), F.lit(1.0))


def _sized(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select("doc_id", "source", size.alias("size"), F.substring(key, 1, 16).alias("shuffled"), *more)


def _place(docs: DataFrame, whole_rows: bool, weights, epochs: float, max_repeat: int, schedules, seed: int) -> DataFrame:
    sizes = cut_lineage(_sized(docs, seed))
    rows = sizes.count()
    # Leading bits of the shuffled key: buckets in order hold the keys in order, whatever their number.
    bits = min(32, math.ceil(math.log2(max(LEAST_BUCKETS, rows / ROWS_PER_BUCKET))))
    bucket = F.shiftright(F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long"), 32 - bits).alias("bucket")
    targets = source_targets(sizes, weights, epochs, max_repeat)
    per_bucket = sizes.groupBy("source", bucket).agg(F.sum("size").alias("bucket_size"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0))).alias("o")
    plan = offsets.join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        F.col("o.source").alias("o_source"), F.col("bucket").alias("o_bucket"), "ahead", "source_size", "weight_class", "target")
    sized = _sized(docs, seed, F.struct("*").alias("row")) if whole_rows else sizes
    within = (Window.partitionBy("source", "bucket").orderBy("shuffled", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (sized.withColumn("bucket", bucket).withColumn("inside", F.sum("size").over(within) - F.col("size"))
              .join(plan, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
              .withColumn("start", F.col("ahead") + F.col("inside")))
    goal = F.round("target").cast("long")
    copies = []
    for copy in range(max_repeat):
        first = F.col("start") + F.lit(copy) * F.col("source_size")
        words = F.greatest(F.least(F.col("size"), goal - first), F.lit(0))
        demand = F.when(F.col("target") > 0, (first + words / 2) / F.col("target")).otherwise(F.lit(0.0))
        position = F.lit(0.0)
        for k, schedule in enumerate(schedules):
            position = F.when(F.col("weight_class") % len(schedules) == k, training_time(demand, schedule)).otherwise(position)
        copies.append(F.struct(F.lit(copy).alias("copy"), words.alias("words"), position.alias("position")))
    return placed.withColumn("placements", F.filter(F.array(*copies), lambda p: p["words"] > 0))


def curriculum_mix(docs: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, max_repeat: int = MAX_REPEAT,
                   schedules=SCHEDULES, seed: int = 11) -> DataFrame:
    """Plan the mix: doc_id, source, size, source_size, target, taken and ``placements``, an array of
    (copy, words, position) with one entry per epoch that takes the document."""
    placed = _place(docs, False, weights, epochs, max_repeat, schedules, seed)
    taken = F.aggregate("placements", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "placements")


def training_order(mix: DataFrame) -> DataFrame:
    """Range-sort by (first) training position; what is never taken comes last."""
    return mix.orderBy(F.get("placements", F.lit(0))["position"].asc_nulls_last(), "doc_id")


def training_rows(docs: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, max_repeat: int = MAX_REPEAT,
                  schedules=SCHEDULES, seed: int = 11) -> DataFrame:
    """The training stream itself: one row per placement with all columns of ``docs``, range-sorted by position, and
    mix_copy, mix_words (the row's first words that are used) and mix_position."""
    placed = _place(docs, True, weights, epochs, max_repeat, schedules, seed)
    names = {new: free_name(f"mix_{new}", docs.columns) for new in ("copy", "words", "position")}
    return (placed.select("row", F.explode("placements").alias("p")).orderBy("p.position", "row.doc_id", "p.copy")
            .select("row.*", *[F.col(f"p.{k}").alias(v) for k, v in names.items()]))


def op3_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = training_order(curriculum_mix(load(spark, sf_dir, "documents")))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


#: DuckDB SQL for op3, over any table expression named in place of {docs}.
SQL_TEMPLATE = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS shuffled
  FROM {docs}),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight,
         CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS goal, source_size * 2.0::DOUBLE AS most
  FROM totals),
levels AS (
  SELECT *, (goal - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (SELECT source, source_size, least(most, max(level) OVER () * weight) AS target FROM levels),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY shuffled, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sizes)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(least(size, CAST(round(target) AS BIGINT) - start), 0)
            + greatest(least(size, CAST(round(target) AS BIGINT) - start - source_size), 0) AS BIGINT) AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""
SQL = SQL_TEMPLATE.format(docs="documents")
