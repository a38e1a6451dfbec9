"""From raw documents to packed training sequences: five stages, each written and read again by the next.

Results for odd inputs: null, empty and letterless texts go in the first stage; rows without an id, or sharing it with other
texts, are documents of their own in the second and are drawn by id, or by text without one, in the fourth; null languages and
sources are values of their own; very long texts pass whole and are cut by packing only; columns beside those of documents
are dropped; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import language_id, ngram_jaccard, packing, pii, queries
from orrery.session import scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: How far from even odds (0) to certainty (1) the likeliest language's share must be: 0.35 with four languages.
CLEAR = 2 / 15

ORACLE_SQL = None


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of which no language gets a clear share of the likelihood, go; those that name a
    language of which nothing could be learned stay."""
    model = queries.language_model(docs)
    judged = language_id.identify_language(docs, model, into="_pred", score="_score")
    k = len(model.languages)
    clear = F.col("_score") >= 1 / k + CLEAR * (1 - 1 / k) - 1e-12 if k else F.lit(True)
    other = F.coalesce(~F.col("lang").isin(model.languages), F.lit(False)) if k else F.lit(True)
    kept = judged.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}") & (clear | other))
    return kept.withColumn(
        "lang", F.coalesce("lang", F.nullif("_pred", F.lit(language_id.UNKNOWN)))
    ).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays; of its repeated rows one. Each
    distinct text without an id is a document of its own."""
    return ngram_jaccard.keep_representatives(docs).select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    found = pii.find_pii(docs, into="_pii")
    return found.withColumn("text", pii.redact(F.col("text"), F.col("_pii"))).withColumn(
        "n_chars", F.length("text").cast("long")
    ).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of whole documents whose tokens meet the target shares."""
    return queries.mixed(docs).where("sampled").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify),
    ("n-gram Jaccard join", one_of_each_group),
    ("PII", redact),
    ("mixing sources", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
