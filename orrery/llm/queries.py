"""The registered queries of this subpackage over the driver's tables, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import (
    conversation_trie, fingerprints, language_id, ngram_jaccard, oracles, packing, pii, quality_classifier,
    quality_rules, source_mixing, substring_dedup, token_alignment, toxicity, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = substring_dedup.dedup_substrings(load(spark, sf_dir, "documents"))
    return deduped.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


#: Topics by what a text looks like.
TOPICS = (
    ("licensed", "Licensed under"), ("tabular", r" \| "), ("shouting", r"\p{Lu}{3,}!!"), ("marked up", r"[%$&*#]{3}"),
)


#: The share of all tokens that a sample is to have.
SAMPLED = 0.5


def mixed(docs: DataFrame) -> DataFrame:
    """Large sources weigh less than their size, languages a little less, topics as they are; half of the tokens are kept."""
    rows = docs.withColumns(
        {
            "n_tokens": source_mixing.count_tokens(F.col("text")),
            "topic": source_mixing.topic_by_rules(F.col("text"), TOPICS, "prose"),
        }
    )
    return source_mixing.mix_sources(
        rows, by_source=source_mixing.Targets(alpha=0.7), by_language=source_mixing.Targets(alpha=0.9),
        by_topic=source_mixing.Targets(), expected_share=SAMPLED,
    )


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixed(docs).drop("text")


#: The rules of the task.
URL_RULES = (
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
)


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "block_score"
    )


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry no path: the rates of a path are those of a language within a source."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    model = quality_classifier.train_quality_model(docs, load(spark, sf_dir, "labels"))
    return quality_classifier.classify_quality(docs, model)


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(load(spark, sf_dir, "documents"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "source", "host_rows", "host_failed",
    )


def held_out(doc_id: F.Column) -> F.Column:
    """Every third document by checksum of its id; one without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    """Learned from documents that have an id, are not held out and name their language."""
    learn = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return language_id.train_language_model(learn)


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return language_id.identify_language(rows, language_model(docs)).drop("text")


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(load(spark, sf_dir, "documents"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [k.name for k in pii.KINDS if k.base]
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs)
    return found.select(
        "doc_id",
        *[F.size(pii.of_kinds(F.col("pii"), [k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(pii.written(pii.of_kinds(F.col("pii"), base)).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("pii")).alias("spans"),
        F.transform("pii", lambda s: s["score"]).alias("scores"),
    )


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are not held out are learned from: their texts, and their labels where they say toxic."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_toxicity_model(docs, load(spark, sf_dir, "labels"), learn=~held_out(F.col("_id")))
    return toxicity.score_toxicity(docs.withColumn("held_out", held_out(F.col("doc_id"))), model)


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align_tokenizers(load(spark, sf_dir, "documents"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


#: Conversations are rebuilt on the first one of a hundred ids, by at most five of its turns.
GROUP, HEADS = 100, 6


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(load(spark, sf_dir, "conversations"), group=GROUP, heads=HEADS)
