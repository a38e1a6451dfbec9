"""Quality rules per document and per host, in DataFrame functions only.

A document fails its own rules if it is short or repeats itself. Failures are counted per host; a beta prior
is fitted to the hosts' failure rates by moments, each host's rate is shrunk towards it, and a host whose
shrunk rate lies above a limit takes its remaining documents with it.

Results for odd inputs: a null text has no words and fails; a null host is a host of its own; repeated rows
count as often as they occur and get equal verdicts; an empty table gives no rows; input columns named like
a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.expressions import let, shielded
from orrery.session import scratch

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
HOST = ("host_rows", "host_failed", "host_rate", "host_kept", "kept")


def words(text: Column) -> Column:
    """Words separated by the characters [\\x20\\x09-\\x0D]; none of a null."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _repeat_words(words_: Column) -> Column:
    """Words within three-word windows that occur twice or more in their text.

    Windows are sorted by a 64-bit hash with their place; equal neighbours are repeats. Their places in
    order then cover up to three words each, less what the window before has covered.
    """
    windows = let(
        words_,
        lambda all_words: F.transform(
            F.slice(all_words, 1, F.greatest(F.size(all_words) - 2, F.lit(0))),
            lambda w, i: F.struct(
                F.xxhash64(w, F.get(all_words, i + 1), F.get(all_words, i + 2)).alias("h"), i.alias("i")
            ),
        ),
    )
    return let(
        windows,
        lambda found: F.when(
            F.size(F.array_distinct(F.transform(found, lambda w: w["h"]))) == F.size(found), F.lit(0)
        ).otherwise(let(F.sort_array(found), _covered)),
    )


def _covered(ordered: Column) -> Column:
    """Walk the sorted windows once; a window counts if the hash before or after it is the same."""
    same = F.lit(False)
    repeats = F.filter(
        ordered,
        lambda w, i: F.coalesce(F.get(ordered, i - 1)["h"] == w["h"], same)
        | F.coalesce(F.get(ordered, i + 1)["h"] == w["h"], same),
    )
    return F.aggregate(
        F.sort_array(F.transform(repeats, lambda w: w["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")),
        lambda s: s["n"],
    )


def base_rules(
    df: DataFrame, text: str = "text", *, min_words: int = 50, max_repeat_percent: int = 50,
) -> DataFrame:
    """All columns of ``df`` with the base measures and ``base_failed``."""
    body = F.coalesce(F.col(text), F.lit(""))
    symbols = F.regexp_replace(body, r"[^#*$%&|<>]+", "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n_words, repeats = F.col("n_words"), F.col("n_repeat_words")
    rows = df.drop(*BASE).withColumns({"_orrery_words": words(F.col(text)), "_orrery_lines": lines})
    rows = rows.withColumns(
        {
            "n_words": F.size("_orrery_words").cast("long"),
            "word_chars": F.length(F.array_join("_orrery_words", "")).cast("long"),
            "n_symbols": F.length(symbols).cast("long"),
            "n_dup_lines": (F.size("_orrery_lines") - F.size(F.array_distinct("_orrery_lines"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("_orrery_words")).cast("long"),
        }
    ).drop("_orrery_words", "_orrery_lines")
    return rows.withColumn(
        "base_failed", (n_words < min_words) | (100 * repeats > max_repeat_percent * n_words)
    )


def host_verdicts(failed: DataFrame, host: str, *, max_rate: float = 0.5, min_prior: float = 1.0) -> DataFrame:
    """One row per host: rows, failures, shrunk failure rate, and whether the host is kept.

    The prior's strength follows from the spread of the hosts' rates beyond what chance gives (moments of a
    beta-binomial); if they spread no more than that, every host gets the common rate.
    """
    hosts = failed.groupBy(F.col(host).alias("_orrery_host")).agg(
        F.count("*").alias("host_rows"), F.count_if("base_failed").alias("host_failed")
    )
    mean, strength = _prior(hosts, min_prior)
    shrunk = (F.col("host_failed") + strength * mean) / (F.col("host_rows") + strength)
    return hosts.withColumn("host_rate", F.lit(mean) if strength == float("inf") else shrunk).withColumn(
        "host_kept", F.col("host_rate") <= max_rate
    )


def _prior(hosts: DataFrame, min_prior: float) -> tuple[float, float]:
    """Mean and strength of the beta prior, from one row of sums."""
    rate = F.col("host_failed") / F.col("host_rows")
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("host_rows").cast("double").alias("rows"),
        F.sum("host_failed").cast("double").alias("failed"),
        F.sum(F.col("host_rows").cast("double") * F.col("host_rows")).alias("squares"),
        F.sum(F.col("host_rows") * rate * rate).alias("rates"),
    ).first()
    if not sums.rows:
        return 0.0, float("inf")
    mean = sums.failed / sums.rows
    if not 0 < mean < 1:
        return mean, float("inf")
    within = sums.hosts - 1
    between = (sums.rates - sums.rows * mean**2) / (mean * (1 - mean)) - within
    weight = sums.rows - sums.squares / sums.rows - within
    if between <= 0 or weight <= 0:
        return mean, float("inf")
    return mean, max(weight / between - 1, min_prior)


@shielded
def quality_rules(
    df: DataFrame, text: str = "text", host: str = "source", *, min_words: int = 50,
    max_repeat_percent: int = 50, max_rate: float = 0.5,
) -> DataFrame:
    """The columns of ``df`` but its text, the base measures, the host's figures and ``kept``.

    The measures are taken once and written without the text to the shared folder; the counts per host and
    the result both read them there.
    """
    spark = df.sparkSession
    measured = base_rules(
        df.drop(*HOST), text, min_words=min_words, max_repeat_percent=max_repeat_percent
    ).drop(text)
    path = scratch(spark, "quality")
    measured.write.parquet(path)
    rows = spark.read.schema(measured.schema).parquet(path)
    hosts = host_verdicts(rows, host, max_rate=max_rate)
    return (
        rows.join(hosts, F.col(host).eqNullSafe(F.col("_orrery_host")), "left")
        .drop("_orrery_host")
        .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
    )
