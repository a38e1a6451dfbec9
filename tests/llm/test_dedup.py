"""Repeated passages and near duplicates against plain versions, with hot groups and odd rows."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from orrery.llm import ngram_jaccard, substring_dedup
from orrery.llm.components import connected_components
from orrery.llm.text import find_words
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def corpus(seed: int = 5) -> list[tuple[int, str | None]]:
    """Prose, a passage in every third text, copies, near copies, one word over and over, spaces of all kinds."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "naïve", "日本"]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, base = prose(60), prose(150)
    docs: list[str | None] = []
    for i in range(90):
        own = prose(rng.randrange(0, 120))
        docs.append(" ".join(own[:20] + passage + own[20:] if i % 3 == 0 else own))
    for _ in range(60):
        near = list(base)
        for _ in range(rng.randrange(0, 7)):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        docs.append("\n".join(near))
    docs += [" ".join(base)] * 20 + ["De " * 200, "De " * 90, "", None, "one", "one", "ONE", " \t\n", "a b c d", "A b\x0bc  d"]
    docs.append("\u00a0".join(passage))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("hot_least", [1, 256])
def test_substrings_equal_plain_version(spark, hot_least):
    docs = corpus()
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    got = {
        r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest())
        for r in substring_dedup.dedup_substrings(frame, hot_least=hot_least).collect()
    }
    assert got == brute.repeats(docs)
    assert sum(n for _, n, _ in got.values()) > 1000


def test_substrings_across_gathered_parts(spark, monkeypatch):
    docs = corpus(9)
    gathered = substring_dedup._Gathered(4)
    gathered.add(b"x", 1, (7, 0, 0), 3)
    gathered.add(b"x", 1, (5, 2, 0), 3)
    gathered.add(b"x", 1, (5, 2, 0), 3)
    assert gathered.repeats == [(7, 0, 0, 3)] and gathered.first[b"x"] == (5, 2, 0, 3, 1)
    frame = spark.createDataFrame(docs, SCHEMA).repartition(1)
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup_substrings(frame, buckets=3).collect()}
    assert got == {d: n for d, (_, n, _) in brute.repeats(docs).items()}


def test_substrings_of_odd_tables(spark):
    words = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame(
        [(None, words, 1), (1, words, 2), (1, words, 3), (2, None, 4)], "doc_id long, text string, n_words int"
    )
    got = substring_dedup.dedup_substrings(frame).orderBy(F.asc_nulls_last("doc_id")).collect()
    assert [(r["doc_id"], r["n_words"], r["n_removed"]) for r in got] == [(1, 30, 0), (1, 30, 0), (2, 0, 0), (None, 30, 30)]
    assert substring_dedup.dedup_substrings(frame.limit(0)).collect() == []


@pytest.mark.parametrize("doc_id", [None, 4])
def test_substrings_of_many_rows_with_one_id(spark, doc_id):
    """Some thirty pairs of these texts agree in 16 bits of their checksum."""
    passage = " ".join(f"p{i}" for i in range(25))
    own = [" ".join(f"o{k}_{i}" for i in range(30)) for k in range(2000)]
    texts = [f"{passage} {t}" if k % 2 else t for k, t in enumerate(own)]
    frame = spark.createDataFrame([(doc_id, t) for t in texts], SCHEMA).repartition(5)
    got = {r["kept_text"]: r["n_removed"] for r in substring_dedup.dedup_substrings(frame).collect()}
    whole = [t for t, n in got.items() if t.startswith("p0 ")]
    assert len(whole) == 1 and got[whole[0]] == 0
    assert set(got) == {whole[0], *(t for t in own if not whole[0].endswith(t))}
    assert all(n == 25 * (int(t.split("_")[0][1:]) % 2) for t, n in got.items() if t != whole[0])


@pytest.mark.parametrize("seed", [5, 11])
def test_components_equal_plain_version(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK_ROWS", 8)
    docs = corpus(seed)
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    got = {
        r["doc_id"]: (r["n_shingles"], r["component_id"])
        for r in ngram_jaccard.jaccard_components(frame).collect()
    }
    assert got == brute.components(docs)


def test_components_of_odd_tables(spark):
    frame = spark.createDataFrame(
        [(None, "a b c d e f", 1), (1, "A b c d e f", 2), (1, "a b c d e f", 2), (2, None, 3), (None, "z", 4)],
        "doc_id long, text string, label int",
    )
    got = sorted(ngram_jaccard.jaccard_components(frame).collect(), key=str)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == [
        ("1", 2, "1"), ("1", 2, "1"), ("2", 0, "2"), ("None", 1, "None"), ("None", 2, "1"),
    ]
    assert ngram_jaccard.jaccard_components(frame.limit(0)).collect() == []
    kept = ngram_jaccard.keep_representatives(frame)
    assert kept.columns == frame.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.where("text IS NOT NULL").collect())[1:] == [("None", "z")]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "None"]


@pytest.mark.parametrize("top", [50, (1 << 63) - 3])
def test_unlike_texts_of_one_id_or_none_all_stay(spark, top):
    texts = [" ".join(f"t{k}_{i}" for i in range(20)) for k in range(6)]
    near = texts[0] + " one more"
    frame = spark.createDataFrame(
        [(7, texts[0]), (7, texts[1]), (7, texts[1]), (None, texts[2]), (None, texts[3]), (None, near), (top, texts[4]), (3, near)],
        SCHEMA,
    )
    kept = ngram_jaccard.keep_representatives(frame).collect()
    left = [r["text"] for r in kept]
    assert sorted(t for t in left if t not in (texts[0], near)) == texts[1:5] and len(left) == 5
    found = {(r["doc_id"], r["n_links"]): r["component_id"] for r in ngram_jaccard.jaccard_components(frame).collect()}
    assert found[None, 0] is None and found[top, 0] == top and found[None, 2] == 3


@pytest.mark.parametrize("seed", [5, 11])
def test_links_are_counted_within_components(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK_ROWS", 8)
    docs = corpus(seed) + [(500, "p q r s t u v"), (500, "other words that are six here"), (501, "p q r s t u v")]
    docs += [docs[3], docs[3]]
    sets = [brute.shingles(t) for _, t in docs]
    want = sorted(
        (d, len(s), sum(bool(s and o) and 100 * len(s & o) >= 75 * len(s | o) for o in sets) - bool(s))
        for (d, _), s in zip(docs, sets)
    )
    got = ngram_jaccard.jaccard_components(spark.createDataFrame(docs, SCHEMA).repartition(5)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got) == want
    assert max(n for _, _, n in want) > 50
    assert {r["component_id"] for r in got if r["doc_id"] in (500, 501)} == {500}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    got = {r["id"]: r["label"] for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_words_at_borders():
    import pyarrow as pa

    texts = ["ab c", "", "d\u00a0e\x0bf", None, "\tg"]
    words = find_words(pa.array(texts))
    raw = bytes(words.data)
    got = [[] for _ in texts]
    for a, b, row in zip(words.start, words.end, words.row):
        got[row].append(raw[a:b].decode())
    assert got == [brute.words(t) for t in texts]
