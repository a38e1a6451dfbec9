"""Learning from toxic examples and unlabelled texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import toxicity as tx
from orrery.llm.queries import QUERIES, load

SF_DIR = "/root/testdata/sf0.01"


def corpus(n: int, share: float, seed: int) -> list[tuple[int, str, int]]:
    rng = random.Random(seed)
    words = [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(100)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 60))]
        bad = rng.random() < share
        if bad:
            text[rng.randrange(len(text))] = rng.choice(["Vilest!", "rotter,"])
        rows.append((i, " ".join(text), int(bad)))
    return rows


def bucketed(texts: list[str]) -> tx.Rows:
    import pyarrow as pa

    rows, words = tx.text_words(pa.array(texts))
    return tx.Rows(words, np.cumsum(np.bincount(rows, minlength=len(texts))))


def test_risk_equals_plain_sums_and_is_held_at_zero():
    p, u = [2.0, -1.0, 0.5], [-3.0, 0.0]
    loss = lambda z: np.log(1 + np.exp(-z))
    toxic, clean = tx.risk_parts(np.array(p), np.array(u), 0.3)
    assert toxic == pytest.approx(0.3 * sum(map(loss, p)) / 3)
    assert clean == pytest.approx(sum(loss(-z) for z in u) / 2 - 0.3 * sum(loss(-z) for z in p) / 3)
    # Far beyond what the data can say the corrected risk is below zero; training then steps back.
    assert tx.risk_parts(np.full(4, 30.0), np.full(4, -30.0), 0.3)[1] < 0


def test_words_are_runs_of_letters_in_any_case():
    assert bucketed(["Vilest! é7vilest"]).words.tolist() == bucketed(["x VILEST é".replace("x ", "")]).words.tolist()
    assert len(bucketed([None, "", "123 .,"]).words) == 0


def test_prior_and_scores_without_any_clean_label(spark):
    rows = corpus(6000, 0.2, 5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    # Only some of the toxic ones are known, and no label says clean.
    labels = spark.createDataFrame([(i, 1) for i, _, bad in rows if bad and i % 3 == 0], "doc_id long, toxic int")
    model = tx.train_toxicity_model(docs, labels)
    assert 0.15 < model.prior < 0.27
    got = {r["doc_id"]: r for r in tx.score_toxicity(docs, model).collect()}
    right = sum(got[i]["predicted"] == bad for i, _, bad in rows)
    assert len(got) == len(rows) and right > 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_samples_are_bounded_also_with_a_hot_text_and_a_hot_id(spark):
    rows = [(7 if i % 3 == 0 else i, "hot vilest text" if i % 3 == 0 else f"other {i}") for i in range(9000)]
    rows += [(7, f"same id {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.select(F.col("text"))
    halves = tx._sample(texts, 500, "test")
    assert 300 < sum(map(len, halves)) < 700
    model = tx.train_toxicity_model(docs, spark.createDataFrame([(7, 1)] * 5, "doc_id long, toxic int"), examples=200, unlabelled=500)
    assert tx.score_toxicity(docs, model).where("score is null").isEmpty()


def test_held_out_accuracy(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in load(spark, SF_DIR, "labels").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op11_toxicity"](spark, SF_DIR).collect()}
    assert len(got) == load(spark, SF_DIR, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(got[i]["score"], t) for i, t in toxic.items() if got[i]["held_out"]]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([b > g for b in bad for g in good]) > 0.85
    assert sum(s >= 0.7 for s in good) <= 0.02 * len(good)


def test_odd_inputs(spark):
    docs = spark.createDataFrame(
        [(None, "vilest", 1.0, "x"), (1, None, 1.0, "x"), (2, "", 1.0, "x"), (3, "a vilest b", 1.0, "x"), (3, "a vilest b", 1.0, "x"),
         (4, "word " * 200_000, 1.0, "x"), (5, "plain words", 1.0, "x")],
        "doc_id long, text string, score double, _toxic string",
    )
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (9, 1), (5, None)], "doc_id long, toxic int")
    model = tx.train_toxicity_model(docs, labels)
    got = tx.score_toxicity(docs, model).collect()
    assert len(got) == 7 and {0 <= r["score"] <= 1 for r in got} == {True} and got[0]["_toxic"] == "x"
    empty = {r["doc_id"]: r["score"] for r in got}
    assert empty[1] == empty[2]
    assert tx.train_toxicity_model(docs, labels.where("false")) is None
    assert {r["score"] for r in tx.score_toxicity(docs, None).collect()} == {0.0}
    none = docs.where("false")
    assert tx.train_toxicity_model(none, labels) is None
    assert tx.score_toxicity(none, model).collect() == []
