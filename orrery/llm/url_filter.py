"""URL filters: allow and block rules first, gradient-boosted trees on lexical features for the rest.

URLs that a rule decides are the labelled ones, unless labels are given: the trees learn from a bounded sample of them. Features:
length, path depth, share of digits, character entropy, parameter counts, hyphens, host labels, and, for
the top-level domain and the first path segment, smoothed block rates among labelled URLs.

Results for odd inputs: a null URL or one without ``://`` has an empty host and path and fits no rule, and is
allowed; repeated URLs get equal verdicts; if the labelled URLs are missing or all alike, every other URL gets
their verdict (allow if there are none); an empty table gives no rows; input columns named like a result are
replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.components import store
from orrery.llm.expressions import shielded


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, a slash and the start of a path."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host):]


RESULTS = ("host", "path", "rule", "block_score", "verdict")
FEATURES = (
    "length", "host_length", "path_length", "depth", "digit_share", "entropy", "parameters",
    "query_length", "hyphens", "host_labels", "suffix_rate", "segment_rate",
)
#: Labelled rows that a smoothed block rate is shrunk by.
SMOOTHING = 20


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first ``://``, up to the marks that end them."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    ascii_lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return ascii_lower, F.when(path.startswith("/"), path).otherwise("")


def apply_rules(df: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Host, path and the longest rule that fits (null if none does); of equal length the first listed wins."""
    host, path = split_url(F.col(url))
    rows = df.drop(*RESULTS).withColumns({"host": host, "path": path})
    matched = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        fits = F.col("path").startswith(rule.path) & (
            (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        )
        matched = F.when(fits, rule.pattern).otherwise(matched)
    return rows.withColumn("rule", matched)


def _entropy(value: Column) -> Column:
    """Bits per character."""
    n = F.length(value)
    chars = F.filter(F.array_distinct(F.split(value, "")), lambda c: c != "")
    surprise = F.aggregate(
        F.transform(chars, lambda c: (n - F.length(F.replace(value, c, F.lit("")))).cast("double")),
        F.lit(0.0), lambda total, k: total - k / n * F.log2(k / n),
    )
    return F.when(n > 0, surprise).otherwise(0.0)


def lexical(df: DataFrame, url: str) -> DataFrame:
    """Features of the URL itself, without those learned from labels."""
    whole = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(whole, r"\?([^#]*)", 1)
    n = F.length(whole)
    features = {
        "length": n,
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "depth": F.length(F.regexp_replace("path", "[^/]", "")),
        "digit_share": F.length(F.regexp_replace(whole, "[^0-9]", "")) / F.greatest(n, F.lit(1)),
        "entropy": _entropy(whole),
        "parameters": F.when(query != "", F.length(F.regexp_replace(query, "[^&]", "")) + 1).otherwise(0),
        "query_length": F.length(query),
        "hyphens": F.length(F.regexp_replace(whole, "[^-]", "")),
        "host_labels": F.when(F.col("host") != "", F.length(F.regexp_replace("host", r"[^.]", "")) + 1)
        .otherwise(0),
    }
    return df.withColumns(
        {
            **{f"_f_{k}": v.cast("double") for k, v in features.items()},
            "_f_suffix": F.regexp_extract("host", r"[^.]*$", 0),
            "_f_segment": F.regexp_extract("path", r"^/([^/]*)", 1),
        }
    )


def _rates(sample: DataFrame, key: str, mean: float, most: int) -> dict[str, float]:
    """Smoothed block rates of the ``most`` frequent values of a column; a bounded number of rows."""
    rows = (
        sample.groupBy(key).agg(F.count("*").alias("n"), F.sum("_label").alias("blocked"))
        .orderBy(F.desc("n"), key).limit(most).collect()
    )
    return {r[key]: (r["blocked"] + SMOOTHING * mean) / (r["n"] + SMOOTHING) for r in rows}


def _rate(column: str, rates: dict[str, float], mean: float) -> Column:
    if not rates:
        return F.lit(mean)
    table = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(column)), F.lit(mean))


@dataclass(frozen=True)
class UrlModel:
    """Block rates of suffixes and first path segments, and the trees; without trees the mean decides."""

    mean: float
    suffixes: dict[str, float]
    segments: dict[str, float]
    trees: PipelineModel | None

    def features(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                "_f_suffix_rate": _rate("_f_suffix", self.suffixes, self.mean),
                "_f_segment_rate": _rate("_f_segment", self.segments, self.mean),
            }
        )


def train_url_model(
    labelled: DataFrame, url: str = "url", label: str = "label", *, sample_rows: int = 4000,
    trees: int = 12, depth: int = 4, most_values: int = 200, seed: int = 7,
) -> UrlModel:
    """Fit on about ``sample_rows`` distinct labelled URLs (label 1: block), chosen by a hash of the URL.

    ``labelled`` has the columns host and path. Rows of one URL count once, however many there are, with the larger
    label. The rates hold at most ``most_values`` values each. The sample is written in parallel and trained on from there.
    """
    rows = labelled.select(url, "host", "path", F.col(label).cast("double").alias("_label")).dropna()
    size = rows.agg(F.approx_count_distinct(url)).first()[0]
    if size > sample_rows:
        share = int(sample_rows / size * (1 << 31))
        rows = rows.where(F.pmod(F.xxhash64(url), F.lit(1 << 31)) < share)
    once = rows.groupBy(url, "host", "path").agg(F.max("_label").alias("_label"))
    sample = lexical(store(once, "urls"), url).coalesce(1).cache()
    try:
        n, mean = sample.agg(F.count("*"), F.avg("_label")).first()
        if not n or mean in (0.0, 1.0):
            return UrlModel(mean or 0.0, {}, {}, None)
        model = UrlModel(
            mean, _rates(sample, "_f_suffix", mean, most_values),
            _rates(sample, "_f_segment", mean, most_values), None,
        )
        assembler = VectorAssembler(inputCols=[f"_f_{f}" for f in FEATURES], outputCol="_f_vector")
        boosted = GBTClassifier(
            featuresCol="_f_vector", labelCol="_label", predictionCol="_f_prediction",
            maxIter=trees, maxDepth=depth, seed=seed, stepSize=0.3, checkpointInterval=-1,
        ).setProbabilityCol("_f_probability").setRawPredictionCol("_f_raw")
        fitted = Pipeline(stages=[assembler, boosted]).fit(model.features(sample))
        return UrlModel(model.mean, model.suffixes, model.segments, fitted)
    finally:
        sample.unpersist()


@shielded
def filter_urls(
    df: DataFrame, rules: Sequence[Rule], url: str = "url", *, model: UrlModel | None = None,
    max_score: float = 0.5, sample_rows: int = 4000,
) -> DataFrame:
    """All columns of ``df``, host, path, the rule that decided (or null), ``block_score`` and ``verdict``.

    Without a model, one is trained on the URLs that the rules decide.
    """
    rows = apply_rules(df, rules, url)
    by_rule = F.lit(None).cast("string")
    for rule in rules:
        by_rule = F.when(F.col("rule") == rule.pattern, rule.verdict).otherwise(by_rule)
    if model is None:
        labelled = rows.where(F.col("rule").isNotNull()).withColumn("label", (by_rule == "block").cast("int"))
        model = train_url_model(labelled, url, sample_rows=sample_rows)
    kept = [*[c for c in df.columns if c not in RESULTS], "host", "path", "rule"]
    rows = model.features(lexical(rows, url))
    if model.trees is None:
        rows = rows.withColumn("block_score", F.lit(model.mean))
    else:
        rows = model.trees.transform(rows).withColumn(
            "block_score", F.get(vector_to_array("_f_probability"), F.lit(1))
        )
    judged = F.when(F.col("host") == "", "allow").when(F.col("block_score") > max_score, "block").otherwise("allow")
    return rows.select(*kept, "block_score", F.coalesce(by_rule, judged).alias("verdict"))
