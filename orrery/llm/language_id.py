"""Language identification: whole words first, then ever shorter character n-grams for unseen words.

A known word adds its log frequency in each language. An unseen word, between boundary marks, is scored by
the longest n-grams of it that any language knows: five characters, else four, down to one; their mean log frequency counts
as the word. A word of which nothing is known adds nothing.

Results for odd inputs: a null text, an empty one or one without a letter is ``und`` with score 0; repeated
rows get equal results; rows with a null language are not learned from; without any labelled row every text
is ``und``; ties go to the language that sorts first; input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from orrery.llm.components import store
from orrery.llm.text import chunks

NGRAMS = (5, 4, 3, 2, 1)
NOT_LETTERS = r"[^\pL]+"
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies per language. ``tables[0]`` holds words, ``tables[n]`` n-grams of n characters."""

    languages: list[str]
    tables: dict[int, dict[str, int]] = field(repr=False)
    scores: np.ndarray = field(repr=False)

    def word(self, word: str) -> int | list[int]:
        """The rows of ``scores`` whose mean is the word's score."""
        known = self.tables[0].get(word)
        if known is not None:
            return known
        marked = f" {word} "
        for n in NGRAMS:
            table = self.tables[n]
            found = [
                table[g] for g in (marked[i : i + n] for i in range(len(marked) - n + 1)) if g in table
            ]
            if found:
                return found
        return []

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and its share of the likelihood for each text."""
        rows, words = _letter_words(texts)
        total = np.zeros((len(texts), len(self.languages)))
        coded = words.dictionary_encode()
        distinct = np.zeros((len(coded.dictionary), len(self.languages)))
        whole_at, whole = [], []
        for i, word in enumerate(coded.dictionary.to_pylist()):
            found = self.word(word)
            if isinstance(found, int):
                whole_at.append(i)
                whole.append(found)
            elif found:
                distinct[i] = self.scores[found].mean(axis=0)
        distinct[whole_at] = self.scores[whole]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(rows, distinct[codes, k], minlength=len(texts))
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        seen = np.bincount(rows, minlength=len(texts)) > 0
        share = np.exp(total - total.max(axis=1, keepdims=True))
        best = total.argmax(axis=1)
        score = np.where(seen, 1 / share.sum(axis=1), 0.0)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, seen)], score


def _letter_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The runs of letters of each text in lower case, and the text each belongs to."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    lists = pc.split_pattern(pc.replace_substring_regex(lower, NOT_LETTERS, " "), " ")
    rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    words = pc.list_flatten(lists)
    keep = pc.not_equal(words, "")
    return rows[keep.to_numpy(zero_copy_only=False)], words.filter(keep)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (n = 0) and n-grams with their number of occurrences, per language and chunk."""
    for batch in batches:
        for part in chunks(batch, "text"):
            for lang in pc.unique(part.column("lang")).to_pylist():
                texts = part.filter(pc.equal(part.column("lang"), lang)).column("text")
                counted = pc.value_counts(_letter_words(texts)[1])
                tally: dict[tuple[int, str], int] = {}
                for item in counted.to_pylist():
                    word, times = item["values"], item["counts"]
                    tally[0, word] = times
                    marked = f" {word} "
                    for n in NGRAMS:
                        for i in range(len(marked) - n + 1):
                            key = (n, marked[i : i + n])
                            tally[key] = tally.get(key, 0) + times
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(tally), pa.string()),
                        "n": pa.array([n for n, _ in tally], pa.int32()),
                        "gram": pa.array([g for _, g in tally], pa.string()),
                        "times": pa.array(list(tally.values()), pa.int64()),
                    }
                )


def train_language_model(
    labelled: DataFrame, text: str = "text", lang: str = "lang", *,
    sample_rows: int = 6000, least_rows: int = 500, max_words: int = 10_000, max_grams: int = 5_000,
) -> LanguageModel:
    """Learn from about ``sample_rows`` distinct labelled texts, chosen by hash, and of a language that has fewer of
    these from about ``least_rows``, or all it has; each language is learned from one text at least. A text counts once
    for a language, however many rows hold it.

    The model keeps the ``max_words`` most frequent words and ``max_grams`` most frequent n-grams of each length
    per language, which bounds what reaches the driver and each task.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    spread = F.pmod(F.xxhash64("text"), F.lit(1 << 31))
    per_language = store(
        rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("rows"), F.min(spread).alias("first")),
        "languages",
    )
    size = per_language.agg(F.sum("rows")).first()[0] or 0
    if size > sample_rows:
        share = F.greatest(F.lit(sample_rows / size), F.lit(least_rows) / F.col("rows")) * (1 << 31)
        edges = per_language.select("lang", F.greatest(share, F.col("first") + 1).alias("edge"))
        rows = rows.join(edges, "lang").where(spread < F.col("edge")).select("lang", "text")
    # Repeats meet by their hash, as one row of each task.
    rows = store(rows.groupBy("lang", F.xxhash64("text").alias("key")).agg(F.any_value("text").alias("text")).drop("key"), "texts")
    counts = (
        rows.mapInArrow(_count, "lang string, n int, gram string, times long")
        .groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    )
    totals = counts.groupBy("lang", "n").agg(F.sum("times").alias("total"), F.count("*").alias("distinct"))
    rank = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("times"), "gram"))
    kept = (
        counts.withColumn("rank", rank)
        .where(F.col("rank") <= F.when(F.col("n") == 0, max_words).otherwise(max_grams))
        .select("lang", "n", "gram", "times")
    )
    return _build(totals.toArrow().to_pylist(), kept.toArrow())


def _build(totals: list[dict], kept: pa.Table) -> LanguageModel:
    languages = sorted({t["lang"] for t in totals})
    at = {lang: k for k, lang in enumerate(languages)}
    tables: dict[int, dict[str, int]] = {n: {} for n in (0, *NGRAMS)}
    cells: list[tuple[int, int, int]] = []
    level: list[int] = []
    for lang, n, gram, times in zip(*(kept.column(c).to_pylist() for c in ("lang", "n", "gram", "times"))):
        row = tables[n].setdefault(gram, len(level))
        if row == len(level):
            level.append(n)
        cells.append((row, at[lang], times))
    counts = np.zeros((len(level), len(languages)))
    for row, k, times in cells:
        counts[row, k] = times
    size = np.ones((max(NGRAMS) + 1, len(languages)))
    for t in totals:
        size[t["n"], at[t["lang"]]] = t["total"] + 0.5 * t["distinct"]
    scores = np.log(counts + 0.5) - np.log(size)[np.array(level, int)]
    return LanguageModel(languages, tables, scores)


def identify_language(
    df: DataFrame, model: LanguageModel, text: str = "text", *, into: str = "lang_pred", score: str = "score",
) -> DataFrame:
    """All columns of ``df`` and the predicted language with its score from 0 to 1."""
    spark = df.sparkSession
    df = df.drop(into, score)
    shared = spark.sparkContext.broadcast(model)
    schema = StructType([*df.schema.fields, StructField(into, StringType()), StructField(score, DoubleType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                langs, scores = shared.value.predict(part.column(text))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=schema.names,
                )

    return df.mapInArrow(label, schema)
