"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Features: lengths, depth, digit ratio, character entropy, parameter counts, and how often URLs of the
same host suffix were blocked among the labelled ones. The trees are Spark's own, trained on a bounded
seeded sample of the labelled URLs.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import cut, lower_ascii, registered, row_but, table

# Host, path and verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "hyphens", "digit_ratio",
            "entropy", "parameters", "has_fragment", "suffix_rate", "suffix_count")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a URL without ``://``."""
    start = F.locate("://", url)
    tail = F.coalesce(F.when(start > 0, F.substring(url, start + 3, F.length(url))), F.lit(""))
    host = lower_ascii(F.regexp_extract(tail, r"^[^/?#]*", 0))
    return host, F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    name = verdict = None
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(F.lit(None) if name is None else name)
        verdict = F.when(fits, F.lit(says)).otherwise(F.lit(None) if verdict is None else verdict)
    return name, verdict


def _occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical_features(url: Column, host: Column, path: Column) -> list[Column]:
    """All features but those of the suffix."""
    text = F.coalesce(url, F.lit(""))
    length = F.length(text).cast("double")
    chars = F.split(text, "")
    # Entropy from the counts of each distinct character.
    entropy = F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda total, c: total + F.when(c == "", 0.0).otherwise(
            F.size(F.filter(chars, lambda x: x == c)) / length
            * -F.log2(F.size(F.filter(chars, lambda x: x == c)) / length)))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return [
        length.alias("url_length"), F.length(host).cast("double").alias("host_length"),
        F.length(path).cast("double").alias("path_length"), _occurrences(path, "/").alias("depth"),
        _occurrences(host, r"\.").alias("labels"), _occurrences(host, "-").alias("hyphens"),
        F.when(length > 0, _occurrences(text, "[0-9]") / length).otherwise(0.0).alias("digit_ratio"),
        F.when(length > 0, entropy).otherwise(0.0).alias("entropy"),
        F.when(query == "", 0.0).otherwise(_occurrences(query, "&") + 1).alias("parameters"),
        F.contains(text, F.lit("#")).cast("double").alias("has_fragment"),
    ]


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def suffix_rates(labelled: DataFrame, strength: float = 20.0) -> DataFrame:
    """(suffix, suffix_rate, suffix_count) of labelled URLs; rates are pulled towards one half."""
    return labelled.groupBy("suffix").agg(
        ((F.sum("label") + strength / 2) / (F.count("*") + strength)).alias("suffix_rate"),
        F.log1p(F.count("*").cast("double")).alias("suffix_count"))


def _with_suffix(df: DataFrame, rates: DataFrame) -> DataFrame:
    rates = rates.withColumnRenamed("suffix", "of")
    return (df.join(rates, F.col("suffix") == F.col("of"), "left").drop("of")
            .fillna(0.5, ["suffix_rate"]).fillna(0.0, ["suffix_count"]))


def train_url_model(
    labelled: DataFrame, rates: DataFrame, sample: int = 20_000, trees: int = 12, depth: int = 4, seed: int = 5
) -> GBTClassificationModel | None:
    """Boosted trees on ``sample`` different labelled URLs (all, if fewer), the first by a hash of the URL.

    ``labelled`` has the features, ``suffix``, ``url`` and ``label`` (1: block). A URL counts once, however
    often it is repeated, so the sample has at most ``sample`` rows. None if it holds one class only.
    """
    # The label and features of a URL depend on it alone.
    chosen = cut(labelled.dropDuplicates(["url"]).orderBy(F.xxhash64("url"), "url").limit(sample), "url-sample")
    if len(chosen.select("label").distinct().collect()) < 2:
        return None
    train = cut(VectorAssembler(inputCols=list(FEATURES), outputCol="features")
                .transform(_with_suffix(chosen, rates)).select("features", "label"), "url-train")
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth,
                         maxBins=32, seed=seed).fit(train)


def filter_urls(pages: DataFrame, rules: tuple = RULES, sample: int = 20_000, default: str = "allow") -> DataFrame:
    """The pages with ``judged``: host, path, rule and verdict.

    The rules' verdicts are the labels from which the trees learn; pages without a rule get the trees'.

    - Null url, or none with ``://``: host and path are empty, no rule fits, the trees judge.
    - If rules give no verdict or one verdict only, nothing can be learnt and ``default`` stands.
    - Rows are judged one by one: repeated rows, repeated and null ids are kept. An empty table gives
      an empty result. Other columns pass through unchanged.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(row_but(pages, "judged"), "url", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumn("rule", rule).withColumn("says", verdict)
    featured = ruled.select(
        "row", "url", "host", "path", "rule", "says", suffix_of(F.col("host")).alias("suffix"),
        *lexical_features(F.col("url"), F.col("host"), F.col("path")))
    labelled = featured.filter("says is not null").drop("row", "host", "path", "rule").withColumn(
        "label", (F.col("says") == "block").cast("double"))
    rates = cut(suffix_rates(labelled), "url-suffixes")
    model = train_url_model(labelled, rates, sample)
    if model is None:
        judged = featured.withColumn("model_says", F.lit(default))
    else:
        scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features")
                                 .transform(_with_suffix(featured, rates)))
        judged = scored.withColumn("model_says", F.when(F.col("prediction") == 1, "block").otherwise("allow"))
    return judged.select("row.*", F.struct(
        "host", "path", "rule", F.coalesce("says", "model_says").alias("verdict")).alias("judged"))


@registered("op2_url_filter")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL."""
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "judged.*")
