"""URL filters: host and path rules, and gradient-boosted trees on lexical features for the rest (op8).

A rule names a host (with its subdomains) and a path prefix; the longest fitting rule decides. The URLs that a rule
decides are the labelled ones, and trees learned from a bounded sample of them judge all others by lexical
features: lengths, depth, digit and symbol ratios, character entropy, parameters, and statistics of the host's
suffix over the whole table (its rows, hosts, host lengths and path digits; never its labels).

Parsing, rules and features are column expressions; the suffix statistics are counted over all rows, combined
before the shuffle, and joined to narrow rows. Training uses MLlib's trees on at most about ``TRAIN_ROWS`` rows.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule, and is judged by the trees with
zero features. If no URL, or only one kind, is labelled, the unlabelled get that kind's verdict, or ``allow``. Repeated
rows get the same verdict. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import bounded_sample, cut_lineage, let, load

#: The rules of the registered query: (host, path prefix, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Rules become part of the plan up to this number.
MOST_RULES = 2_000
TRAIN_ROWS = 20_000
TREES, DEPTH = 20, 4
BLOCK_AT = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Add host (A-Z lower-cased) and path; both empty without ``://``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract("rest", r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("rest", rest).withColumns({"host": host, "path": path}).drop("rest")


def longest_rule(rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict as columns over host and path, null if none fits. A host's suffixes are
    looked up in a map of rules, so the work grows with the host's labels, not with the rules."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: join them as a table instead")
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    by_host: dict[str, list] = {}
    for host, path, verdict in rules:
        by_host.setdefault(host, []).append((path, verdict))
    table = F.create_map(*[x for host, found in by_host.items() for x in (
        F.lit(host), F.array(*[F.struct(F.lit(len(host) + len(path)).alias("n"), F.lit(host + path).alias("rule"),
                                        F.lit(path).alias("path"), F.lit(verdict).alias("verdict")) for path, verdict in found]))])
    labels = F.split("host", r"\.")
    suffixes = let(labels, lambda x: F.transform(F.sequence(F.lit(1), F.size(x)),
                                                 lambda i: F.array_join(F.slice(x, i, F.size(x)), ".")))
    fitting = F.filter(F.flatten(F.filter(F.transform(suffixes, lambda s: table[s]), lambda r: r.isNotNull())),
                       lambda r: F.col("path").startswith(r["path"]))
    best = F.array_max(fitting)
    return best["rule"], best["verdict"]


def _share(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits per character of the text's own character distribution."""
    # Of n characters, those that occur k times in all: log n - sum(k log k) / n. In order, equal characters are runs, and the i-th of
    # a run adds i log i - (i - 1) log(i - 1), so one pass over the sorted text is enough.
    chars = F.sort_array(F.split(text, ""))

    def x_log_x(x: Column) -> Column:
        return F.when(x > 1, x * F.log2(F.greatest(x, F.lit(1)))).otherwise(F.lit(0.0))

    def step(state: Column, c: Column) -> Column:
        run = F.when(c == state["c"], state["run"] + 1).otherwise(F.lit(1))
        return F.struct(c.alias("c"), run.alias("run"), (state["total"] + x_log_x(run) - x_log_x(run - 1)).alias("total"))

    def bits(c: Column) -> Column:
        start = F.struct(F.lit("").alias("c"), F.lit(0).alias("run"), F.lit(0.0).alias("total"))
        return F.greatest(F.log2(F.size(c)) - F.aggregate(c, start, step, lambda s: s["total"]) / F.size(c), F.lit(0.0))
    return F.when(F.length(text) > 0, let(chars, bits)).otherwise(F.lit(0.0))


def _features() -> dict[str, Column]:
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    features = {
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "query_length": F.length(query), "depth": F.regexp_count("path", F.lit("/")), "labels": F.regexp_count("host", F.lit(r"\.")),
        "hyphens": F.regexp_count("host", F.lit("-")),
        "parameters": F.regexp_count(query, F.lit("=")), "fragment": F.instr(url, "#") > 0, "secure": url.startswith("https:"),
        "url_digits": _share(url, "[0-9]"), "host_digits": _share(F.col("host"), "[0-9]"), "path_digits": _share(F.col("path"), "[0-9]"),
        "symbols": _share(url, "[A-Za-z0-9/.:]"), "host_entropy": _entropy(F.col("host")), "path_entropy": _entropy(F.col("path")),
    }
    return {k: v.cast("double") for k, v in features.items()}


def judge_urls(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH,
               block_at: float = BLOCK_AT) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the trees' chance of block; null where a rule decides)."""
    rule, verdict = longest_rule(rules)
    features = _features()
    parsed = with_host_and_path(pages.select("page_id", "url")).withColumns({"rule": rule, "decided": verdict})
    rows = parsed.select("page_id", "host", "path", "rule", "decided", *[v.alias(k) for k, v in features.items()],
                         F.regexp_extract("host", r"([^.]*)$", 1).alias("suffix"))
    rows = cut_lineage(rows)
    suffixes = rows.groupBy("suffix").agg(
        F.log1p(F.count("*")).alias("suffix_rows"), F.log1p(F.approx_count_distinct("host")).alias("suffix_hosts"),
        F.avg("host_length").alias("suffix_host_length"), F.avg("path_digits").alias("suffix_digits"))
    full = rows.join(suffixes, "suffix").drop("suffix")
    names = [*features, *suffixes.columns[1:]]
    kinds = {r["decided"]: r["count"] for r in rows.where(F.col("decided").isNotNull()).groupBy("decided").count().collect()}
    out = ["page_id", "host", "path", "rule"]
    if len(kinds) < 2:
        rest = next(iter(kinds), "allow")
        return full.select(*out, F.coalesce("decided", F.lit(rest)).alias("verdict"), F.lit(None).cast("double").alias("score"))

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    labelled = full.where(F.col("decided").isNotNull()).withColumn("label", (F.col("decided") == "block").cast("double"))
    # Half of the bound for either verdict, over distinct URLs: neither can be missing, and none is drawn more than once.
    distinct = cut_lineage(labelled.dropDuplicates(["host", "path", *names]))
    sizes = {r["decided"]: r["count"] for r in distinct.groupBy("decided").count().collect()}
    train = None
    for decided, n in sorted(sizes.items()):
        part = bounded_sample(distinct.where(F.col("decided") == decided), n, train_rows // 2, "host", "path", *names, seed=8)
        train = part if train is None else train.unionByName(part)
    train = cut_lineage(assembler.transform(train).select("features", "label").repartition(4))
    model = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, maxBins=64, seed=5, stepSize=0.2).fit(train)
    model.setPredictionCol("").setRawPredictionCol("")
    scored = model.transform(assembler.transform(full)).withColumn("p", vector_to_array("probability")[1])
    judged = F.when(F.col("p") >= block_at, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(*out, F.coalesce("decided", judged).alias("verdict"),
                         F.when(F.col("decided").isNull(), F.col("p")).alias("score"))


def op8_url_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(load(spark, sf_dir, "pages"))


#: The verdicts of URLs without a rule are learned: no SQL. Tests hold host, path and rule against a plain loop and
#: the trees against held-out labels.
SQL = None
