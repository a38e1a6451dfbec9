"""Quality of documents: a classifier's evidence, corrected by what is known of their host and path.

Two logistic classifiers (good quality; toxic) read style measures and the evidence of words, both learned from a
bounded sample of labelled documents. Grouped sums of the probabilities of all documents give each host
and each path of a host a posterior: a host with few documents is shrunk towards the corpus, a path towards its
host. How strongly follows from the documents themselves: by moments, from how far the means of hosts (of paths within their
hosts) lie apart beyond what the spread of single documents explains. A document's score adds to the log odds of its own evidence how far
its path's odds lie from the corpus's, both without the document itself. Toxic documents are dropped whatever their score. Documents carry no URL: by default their source stands in
for the host and their language within the source for the path.

Results for odd inputs: a null or empty text has the measures of an empty text; null hosts and paths are values
of their own; repeated rows count as often as they occur and score alike; labels that are null or of no
document are not learned from; without labels of both classes the classifier says the share of the only one;
an empty table gives no rows; input columns named like a result are replaced.
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

from orrery.llm.components import store
from orrery.llm.expressions import shielded
from orrery.llm.text import chunks, find_words
from orrery.session import scratch

MEASURES = 8
RESULTS = ("p_good", "p_toxic", "host_rate", "path_rate", "score", "kept")


def measures(texts: pa.Array) -> np.ndarray:
    """Per text: size, distinct words, symbols, capitals, digits, word length, repeated lines, non-letters."""
    texts = pc.fill_null(texts, "")
    found = find_words(texts, lower=True)
    n = np.bincount(found.row, minlength=found.rows).astype(float)
    pairs = np.stack([found.row.astype(np.uint64), found.hashes()], axis=1)
    distinct = np.bincount(np.unique(pairs, axis=0)[:, 0].astype(int), minlength=found.rows) if len(pairs) else n * 0
    size = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1).astype(float)
    count = lambda p: pc.count_substring_regex(texts, p).to_numpy(zero_copy_only=False)
    lines = [[x for x in t.split("\n") if x.strip()] for t in texts.to_pylist()]
    repeated = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in lines])
    some = np.maximum(n, 1)
    return np.stack(
        [
            np.log1p(n), distinct / some, count(r"[#*$%&|<>!]") / some, count("[A-Z]") / size,
            count("[0-9]") / size, size / some / 10, repeated, count(r"[^\pL\s]") / size,
        ],
        axis=1,
    )


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each text's distinct runs of letters in lower case, and the text each belongs to."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    lists = pc.split_pattern(pc.replace_substring_regex(lower, r"[^\pL]+", " "), " ")
    rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.list_flatten(lists).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(coded.dictionary), 1)
    keys = np.unique(rows * width + codes)
    return keys // width, coded.dictionary.take(pa.array(keys % width))


@dataclass(frozen=True)
class Logistic:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.spread) @ self.weights + self.bias, -30, 30)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Logistic:
    """Newton steps; with one class only, the bias alone."""
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    if y.min() == y.max():
        return Logistic(mean, spread, np.zeros(x.shape[1]), math.log(rate / (1 - rate)))
    z = np.column_stack([(x - mean) / spread, np.ones(len(y))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, spread, w[:-1], float(w[-1]))


@dataclass(frozen=True)
class QualityModel:
    """``words``: per word the log odds that speak for toxic and for bad texts."""

    words: dict[str, tuple[float, float]]
    good: Logistic
    toxic: Logistic

    def odds(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x = np.column_stack([measures(texts), word_evidence(self.words, texts)])
        return self.good.odds(x), self.toxic.odds(x)


def word_evidence(words: dict[str, tuple[float, float]], texts: pa.Array) -> np.ndarray:
    """Sums of the words' log odds, tamed by a logarithm, and the largest of them."""
    rows, found = distinct_words(texts)
    coded = found.dictionary_encode()
    table = np.array([words.get(w, (0.0, 0.0)) for w in coded.dictionary.to_pylist()]).reshape(-1, 2)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    sums = [np.bincount(rows, table[codes, k], minlength=len(texts)) for k in range(2)]
    most = np.zeros((len(texts), 2))
    for k in range(2):
        np.maximum.at(most[:, k], rows, table[codes, k])
    return np.column_stack([*(np.sign(s) * np.log1p(np.abs(s)) for s in sums), most])


def train_quality_model(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", *, quality: str = "quality",
    toxic: str = "toxic", sample_rows: int = 4000, max_words: int = 4000, min_texts: int = 5,
) -> QualityModel | None:
    """Learn from about ``sample_rows`` labelled documents, chosen by a hash of the id.

    One half gives the words' odds (of at most ``max_words`` words), the other the classifiers, so that the
    words' evidence is not taken from the texts it is weighed on. Only the sample's labels are broadcast.
    """
    spark = docs.sparkSession
    labelled = labels.select(
        F.col(doc_id).alias("_id"), F.col(quality).cast("int").alias("good"), F.col(toxic).cast("int").alias("toxic")
    ).dropna()
    size = labelled.count()
    draw = F.pmod(F.xxhash64("_id"), F.lit(1 << 31))
    if size > sample_rows:
        labelled = labelled.where(draw < int(sample_rows / size * (1 << 31)))
    labelled = labelled.withColumn("half", F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(2)).cast("int"))
    path = scratch(spark, "labelled")
    docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(
        F.broadcast(labelled), "_id"
    ).select("text", "good", "toxic", "half").write.parquet(path)
    sample = spark.read.schema("text string, good int, toxic int, half int").parquet(path)
    sizes = sample.where("half = 0").agg(
        F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("good") == 0).alias("bad")
    ).first()
    counts = (
        sample.where("half = 0").mapInArrow(_word_counts, "word string, n long, toxic long, bad long")
        .groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "bad")]).where(F.col("n") >= min_texts)
    )
    weights = {
        c: _log_odds(F.col(c), F.col("n"), sizes[c], sizes["n"]) for c in ("toxic", "bad")
    }
    table = (
        counts.withColumns({f"w_{c}": w for c, w in weights.items()})
        .orderBy(F.desc(F.greatest(F.abs("w_toxic"), F.abs("w_bad"))), "word").limit(max_words).toArrow()
    )
    words = {r["word"]: (r["w_toxic"], r["w_bad"]) for r in table.to_pylist()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                x = np.column_stack([measures(part.column("text")), word_evidence(words, part.column("text"))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x)), part.column("good"), part.column("toxic")], names=["x", "good", "toxic"]
                )

    rows = sample.where("half = 1").mapInArrow(read, "x array<double>, good int, toxic int").toArrow()
    if not rows.num_rows:
        return None
    x = np.array(rows.column("x").to_pylist())
    y = {c: rows.column(c).to_numpy().astype(float) for c in ("good", "toxic")}
    return QualityModel(words, fit_logistic(x, y["good"]), fit_logistic(x, y["toxic"]))


def _log_odds(hits: Column, n: Column, group: int, total: int) -> Column:
    """How much more often a word occurs in texts of the group than in others, at least: two standard errors
    nearer to none, so that a word seen in a few texts says little."""
    inside = (hits + 0.5) / (group + 1.0)
    outside = (n - hits + 0.5) / (total - group + 1.0)
    odds = F.log(inside / outside)
    error = F.sqrt(1 / (hits + 0.5) + 1 / (n - hits + 0.5))
    return F.signum(odds) * F.greatest(F.abs(odds) - 2 * error, F.lit(0.0))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of a chunk each word occurs: all, toxic ones, bad ones."""
    for batch in batches:
        for part in chunks(batch, "text"):
            rows, words = distinct_words(part.column("text"))
            toxic = part.column("toxic").to_numpy() == 1
            bad = part.column("good").to_numpy() == 0
            coded = words.dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            width = len(coded.dictionary)
            yield pa.RecordBatch.from_arrays(
                [
                    coded.dictionary,
                    *(
                        pa.array(np.bincount(codes, w, minlength=width).astype(np.int64))
                        for w in (np.ones(len(rows)), toxic[rows], bad[rows])
                    ),
                ],
                names=["word", "n", "toxic", "bad"],
            )


@shielded
def classify_quality(
    df: DataFrame, model: QualityModel | None, text: str = "text", host: str = "source", path: str = "lang", *,
    prior_rows: tuple[float, float] | None = None, min_score: float = 0.5, max_toxic: float = 0.5,
) -> DataFrame:
    """The columns of ``df`` but its text, the evidence, the rates of host and path, ``score`` and ``kept``.

    ``prior_rows``: how many documents the corpus's rate counts for in a host, and a host's in its paths; estimated if
    not given.
    """
    spark = df.sparkSession
    df = df.drop(*RESULTS)
    others = [f for f in df.schema.fields if f.name != text]
    shared = spark.sparkContext.broadcast(model)
    schema = df.select(*[f"`{f.name}`" for f in others]).schema.add("_good", "double").add("_toxic", "double")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                if shared.value is None:
                    odds = [np.zeros(part.num_rows), np.full(part.num_rows, -30.0)]
                else:
                    odds = shared.value.odds(part.column(text))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in others), *(pa.array(o) for o in odds)], names=schema.names
                )

    at = scratch(spark, "evidence")
    df.mapInArrow(weigh, schema).write.parquet(at)
    rows = spark.read.schema(schema).parquet(at)
    p = lambda odds: 1 / (1 + F.exp(-odds))
    hosts, paths = F.col(host).alias("_host"), F.col(path).alias("_path")
    good = p(F.col("_good"))
    per_path = store(
        rows.groupBy(hosts, paths).agg(F.count("*").alias("_n"), F.sum(good).alias("_k"), F.sum(good * good).alias("_k2")), "paths"
    )
    per_host = store(
        per_path.groupBy("_host").agg(
            F.sum("_n").alias("_hn"), F.sum("_k").alias("_hk"), F.sum("_k2").alias("_hk2"), F.count("*").alias("_paths"),
            F.sum(F.col("_n") * F.col("_n")).alias("_nn"), F.sum(F.col("_k") ** 2 / F.col("_n")).alias("_kk"),
        ).withColumnRenamed("_host", "_of"),
        "hosts",
    )
    n, k = per_host.agg(F.sum("_hn"), F.sum("_hk")).first()
    n, k = n or 0, k or 0.0
    host_prior, path_prior = prior_rows or prior_strengths(per_host)
    joined = rows.join(
        per_path.join(per_host, F.col("_host").eqNullSafe(F.col("_of"))).select("_host", "_path", "_n", "_k", "_hn", "_hk"),
        F.col(host).eqNullSafe(F.col("_host")) & F.col(path).eqNullSafe(F.col("_path")), "left",
    )
    # All rates are of the other documents.
    rate = F.lit(0.5) if n < 2 else (F.lit(k) - good) / (n - 1)
    rate = F.greatest(F.least(rate, F.lit(1 - 1e-6)), F.lit(1e-6))
    host_rate = (F.col("_hk") - good + host_prior * rate) / (F.col("_hn") - 1 + host_prior)
    path_rate = (F.col("_k") - good + path_prior * F.col("host_rate")) / (F.col("_n") - 1 + path_prior)
    within = lambda c: F.greatest(F.least(c, F.lit(1 - 1e-9)), F.lit(1e-9))
    rated = joined.withColumn("host_rate", within(host_rate)).withColumn("path_rate", within(path_rate))
    shift = F.log(F.col("path_rate") / (1 - F.col("path_rate"))) - F.log(rate / (1 - rate))
    return rated.withColumns(
        {"p_good": good, "p_toxic": p(F.col("_toxic")), "score": p(F.col("_good") + shift)}
    ).withColumn("kept", (F.col("score") >= min_score) & (F.col("p_toxic") <= max_toxic)).drop(
        "_good", "_toxic", "_host", "_path", "_n", "_k", "_hn", "_hk"
    )


#: The least and the most documents that a prior may count for.
PRIORS = (1e-3, 1e9)


def prior_strengths(per_host: DataFrame) -> tuple[float, float]:
    """How many documents the corpus's mean counts for in a host, and a host's mean in its paths, by moments.

    It is the variance of documents within a group over the variance of the groups' true means, which is that of
    their observed means less what the documents' own spread makes of it. ``per_host`` has for each host documents (_hn), sum (_hk) and sum of
    squares (_hk2) of their values, paths (_paths), the sum over paths of squared sizes (_nn) and of sum squared by size (_kk).
    """
    s = per_host.agg(
        F.count("*").alias("hosts"), F.sum("_paths").alias("paths"), F.sum("_hn").alias("n"), F.sum("_hk").alias("k"),
        F.sum("_hk2").alias("k2"), F.sum(F.col("_hn") * F.col("_hn")).alias("nn"), F.sum(F.col("_hk") ** 2 / F.col("_hn")).alias("kk"),
        F.sum(F.col("_nn") / F.col("_hn")).alias("path_nn"), F.sum("_kk").alias("path_kk"),
    ).first()
    if not s["n"]:
        return PRIORS[1], PRIORS[1]

    def strength(groups: int, parents: int, inside: float, between: float, size: float) -> float:
        """``inside``, ``between``: squared deviations of documents from their group, of groups from their parent."""
        spread = max(inside, 0.0) / (s["n"] - groups) if s["n"] > groups else 0.0
        extra = between - (groups - parents) * spread
        if extra <= 1e-12 * max(between, 1.0) or size <= 0:
            return PRIORS[1]
        return min(max(spread * size / extra, PRIORS[0]), PRIORS[1])

    return (
        strength(s["hosts"], 1, s["k2"] - s["kk"], s["kk"] - s["k"] ** 2 / s["n"], s["n"] - s["nn"] / s["n"]),
        strength(s["paths"], s["hosts"], s["k2"] - s["path_kk"], s["path_kk"] - s["kk"], s["n"] - s["path_nn"]),
    )
