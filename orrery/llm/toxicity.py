"""Toxicity from confirmed toxic examples and unlabelled text, by non-negative positive-unlabelled learning.

No text is ever taken for a clean one: the classifiers see toxic examples and unlabelled texts, of which a share ``prior``
is toxic too. The risk of calling texts clean is therefore that of the unlabelled ones less the part that the toxic ones
among them make up; where this difference falls below zero the classifier has begun to learn single texts by heart, and
the step is taken back instead. The share is estimated from the same two samples, if it is not given: no
cut of the scores can have less of all texts beyond it than the toxic ones beyond it make up. One half of the samples
tells how much each word speaks for toxic texts (words are hashed into a fixed number of buckets, none is left out), and
the other half trains a classifier on what the words of its texts say; and the other way round. A score is the mean of
the two classifiers' log odds.

Both samples are bounded in rows and hold distinct texts, picked by hash. They are written in parallel, as buckets and
not as texts, and trained on by the driver. Every document is scored by its whole text.

Results for odd inputs: a null text is an empty one, which gets the score of a text without known words; repeated rows
score alike, and repeated labels of an id count once (toxic if any says so); labels that are null or of no document are not learned
from, nor are documents without an id, which are scored all the same; without a toxic example every score is 0; an empty table
gives no rows; input columns named like a result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.text import chunks, split_words
from orrery.session import scratch

BUCKETS = 1 << 18
#: The most rows in a sample of toxic examples, and of unlabelled texts, give or take the chance of a hash.
EXAMPLES = 4000
UNLABELLED = 12_000
RESULTS = ("score", "predicted")
#: Standard errors by which a word's evidence is taken nearer to none.
ERRORS = 2.5
_SPREAD = 1 << 31

# Letters stay, A-Z in lower case; other ASCII bytes are spaces. Bytes of other alphabets count as letters.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[65:91] += 32
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct words as buckets, and the text each belongs to."""
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    found = split_words(_LETTERS[data[offsets[0] : offsets[-1]]], offsets - offsets[0])
    keys = np.unique(found.row.astype(np.int64) * BUCKETS + (found.hashes() % np.uint64(BUCKETS)).astype(np.int64))
    return keys // BUCKETS, (keys % BUCKETS).astype(np.int32)


@dataclass(frozen=True)
class Rows:
    """Texts as their buckets, one after the other; ``end`` closes each."""

    words: np.ndarray
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.end)

    def take(self, rows: np.ndarray) -> Rows:
        begin = np.append(0, self.end[:-1])[rows]
        size = self.end[rows] - begin
        end = np.cumsum(size)
        return Rows(self.words[np.repeat(begin - (end - size), size) + np.arange(size.sum())], end)

    def spread(self) -> np.ndarray:
        """In how many texts each bucket occurs."""
        return np.bincount(self.words, minlength=BUCKETS).astype(float)


def word_evidence(toxic: Rows, unlabelled: Rows) -> np.ndarray:
    """Per bucket the log ratio of its share of toxic and of all texts, ``ERRORS`` standard errors nearer to none, so that a
    word seen in a few texts says little."""
    p, u = toxic.spread() + 0.5, unlabelled.spread() + 0.5
    ratio = np.log(p / (len(toxic) + 1)) - np.log(u / (len(unlabelled) + 1))
    return (np.sign(ratio) * np.maximum(np.abs(ratio) - ERRORS * np.sqrt(1 / p + 1 / u), 0)).astype(np.float32)


def measures(rows: Rows, evidence: np.ndarray) -> np.ndarray:
    """Per text: the strongest word, the sums of words that speak for and against, and the number of words."""
    size = np.diff(rows.end, prepend=0)
    own, row = evidence[rows.words].astype(float), np.repeat(np.arange(len(rows)), size)
    most = np.zeros(len(rows))
    np.maximum.at(most, row, own)
    sums = [np.log1p(np.bincount(row, np.maximum(k * own, 0), minlength=len(rows))) for k in (1, -1)]
    return np.column_stack([most, *sums, np.log1p(size)])


@dataclass(frozen=True)
class Classifier:
    """Log odds of a text from the measures of its words."""

    evidence: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def odds(self, rows: Rows) -> np.ndarray:
        z = (measures(rows, self.evidence) - self.mean) / self.scale
        return np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)


def risk_parts(odds_p: np.ndarray, odds_u: np.ndarray, prior: float) -> tuple[float, float]:
    """The logistic risk of calling toxic texts clean, and of calling clean texts toxic as it follows from all texts."""
    loss = lambda z: np.logaddexp(0, -z)
    clean = loss(-odds_u).mean() - prior * loss(-odds_p).mean()
    return prior * float(loss(odds_p).mean()), float(clean)


def fit(
    toxic: Rows, unlabelled: Rows, evidence: np.ndarray, prior: float, *, epochs: int = 200, batches: int = 10,
    rate: float = 0.05, ridge: float = 1e-4, seed: int = 0,
) -> Classifier:
    """Minimise the non-negative risk by Adam over small batches of both samples."""
    p, u = measures(toxic, evidence), measures(unlabelled, evidence)
    mean, scale = u.mean(axis=0), np.maximum(u.std(axis=0), 1e-3)
    p, u = (np.column_stack([(x - mean) / scale, np.ones(len(x))]) for x in (p, u))
    theta, first, second = np.zeros((3, u.shape[1]))
    theta[-1] = math.log(prior / (1 - prior))
    chance, step = np.random.default_rng(seed), 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for _ in range(epochs):
        orders = [np.array_split(chance.permutation(len(x)), batches) for x in (p, u)]
        for rows_p, rows_u in zip(*orders):
            if not len(rows_p) or not len(rows_u):
                continue
            bp, bu = p[rows_p], u[rows_u]
            odds_p, odds_u = bp @ theta, bu @ theta
            as_toxic = prior * (sigmoid(odds_p) - 1) @ bp / len(bp)
            as_clean = sigmoid(odds_u) @ bu / len(bu) - prior * sigmoid(odds_p) @ bp / len(bp)
            gradient = as_toxic + as_clean if risk_parts(odds_p, odds_u, prior)[1] >= 0 else -as_clean
            gradient[:-1] += ridge * theta[:-1]
            step += 1
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient**2 - second)
            theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Classifier(evidence, mean, scale, theta)


def estimate_prior(toxic: np.ndarray, every: np.ndarray, least: float = 0.1) -> float:
    """The smallest ratio of the share of all texts to that of toxic ones beyond a cut, over cuts with at least a
    share ``least`` of the toxic ones beyond them; both shares are taken a standard error on the safe side."""
    cuts = np.unique(toxic)
    beyond = lambda x: 1 - np.searchsorted(np.sort(x), cuts) / len(x)
    p, u = beyond(toxic), beyond(every)
    ratio = (u + np.sqrt(u * (1 - u) / len(every))) / np.maximum(p - np.sqrt(p * (1 - p) / len(toxic)), 1e-9)
    ratio = ratio[p >= least]
    return float(np.clip(ratio.min(initial=1.0), 1e-4, 0.9))


@dataclass(frozen=True)
class ToxicityModel:
    classifiers: tuple[Classifier, ...]
    prior: float

    def scores(self, rows: Rows) -> np.ndarray:
        odds = np.mean([c.odds(rows) for c in self.classifiers], axis=0)
        return 1 / (1 + np.exp(-odds))


def _as_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            rows, words = text_words(part.column("text"))
            offsets = np.append(0, np.cumsum(np.bincount(rows, minlength=part.num_rows))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(words))
            yield pa.RecordBatch.from_arrays([part.column("key"), lists], names=["key", "words"])


def _sample(texts: DataFrame, rows: int, purpose: str) -> list[Rows]:
    """About ``rows`` distinct texts, picked by hash, in two halves."""
    spark = texts.sparkSession
    keyed = texts.select(F.xxhash64("text").alias("key"), "text")
    distinct = keyed.agg(F.approx_count_distinct("key")).first()[0]
    if distinct > rows:
        keyed = keyed.where(F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(_SPREAD)) < int(rows / distinct * _SPREAD))
    path = scratch(spark, purpose)
    # The buckets of a text replace it before repeats meet, and repeats meet as one row of each task.
    once = keyed.mapInArrow(_as_buckets, "key long, words array<int>").groupBy("key").agg(F.any_value("words").alias("words"))
    once.write.parquet(path)
    table = spark.read.schema("key long, words array<int>").parquet(path).toArrow().combine_chunks().sort_by("key")
    if not table.num_rows:
        return [Rows(np.zeros(0, np.int32), np.zeros(0, np.int64))] * 2
    lists = table.column("words").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    found = Rows(lists.flatten().to_numpy(), np.cumsum(sizes))
    half = table.column("key").to_numpy() & 1
    return [found.take(np.flatnonzero(half == k)) for k in (0, 1)]


def train_toxicity_model(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", *,
    learn: Column | None = None, prior: float | None = None, examples: int = EXAMPLES, unlabelled: int = UNLABELLED,
) -> ToxicityModel | None:
    """Learn from at most about ``examples`` documents labelled toxic and ``unlabelled`` others of any kind.

    ``learn``, over the id, says which rows may be used. Only ids of examples are sent to the tasks, a bounded number.
    """
    usable = F.col("_id").isNotNull() if learn is None else F.col("_id").isNotNull() & learn
    marked = labels.select(F.col(doc_id).alias("_id"), F.col(toxic).alias("_toxic")).where(usable)
    marked = marked.where(F.col("_toxic") == 1).select("_id").distinct()
    n = marked.count()
    if n > 2 * examples:
        marked = marked.where(F.pmod(F.xxhash64("_id"), F.lit(_SPREAD)) < int(2 * examples / n * _SPREAD))
    texts = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(usable)
    confirmed = _sample(texts.join(F.broadcast(marked), "_id"), examples, "toxic")
    every = _sample(texts, unlabelled, "texts")
    if not all(map(len, confirmed)) or not all(map(len, every)):
        if not any(map(len, confirmed)):
            return None
        # Too few for two halves.
        both = [max(x, key=len) for x in (confirmed, every)]
        confirmed, every = [both[0]] * 2, [both[1]] * 2
    halves = [
        (confirmed[1 - k], every[1 - k], word_evidence(confirmed[k], every[k])) for k in (0, 1)
    ]
    if prior is None:
        rough = [fit(*half, 0.2, seed=k) for k, half in enumerate(halves)]
        prior = float(np.mean([estimate_prior(m.odds(p), m.odds(u)) for m, (p, u, _) in zip(rough, halves)]))
    return ToxicityModel(tuple(fit(*half, prior, seed=k) for k, half in enumerate(halves)), prior)


def score_toxicity(
    df: DataFrame, model: ToxicityModel | None, text: str = "text", *, threshold: float = 0.7
) -> DataFrame:
    """The columns of ``df`` but its text, ``score`` (0 to 1, higher for toxic) and ``predicted`` (1 from ``threshold`` on)."""
    df = df.drop(*[c for c in RESULTS if c != text])
    others = [f for f in df.schema.fields if f.name != text]
    schema = df.select(*[F.col(f"`{f.name}`") for f in others]).schema.add("score", "double").add("predicted", "integer")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                scores = np.zeros(part.num_rows)
                if shared.value is not None:
                    rows, words = text_words(part.column(text))
                    scores = shared.value.scores(Rows(words, np.cumsum(np.bincount(rows, minlength=part.num_rows))))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in others), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                    names=schema.names,
                )

    return df.mapInArrow(score, schema)
