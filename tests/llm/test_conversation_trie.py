"""The prefix trie of conversations against a plain one."""

from __future__ import annotations

import random

import pytest

from orrery.llm import conversation_trie as ct
from orrery.llm.queries import QUERIES, load
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(frame) -> list[tuple]:
    return sorted((tuple(r[c] for c in brute.TRIE) for r in frame.collect()), key=str)


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in load(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op13_conversation_trie"](spark, SF_DIR)) == brute.trie(rows, 100, 6)


def made(seed: int, convs: int, turns: int, texts: str) -> list[tuple]:
    """Conversations of few different turns, so that many share beginnings; with repeated, null and equal turns."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        c = rng.choice([c, c, 100 * (c % 4), -c, c + 5000])
        for t in range(rng.randrange(turns)):
            rows.append((c, rng.choice([t, t, None, 0]), rng.choice(["u", None]), rng.choice([*texts, None, "longer text 🙂"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,convs,turns,texts", [(1, 300, 8, "a"), (2, 120, 13, "ab"), (3, 40, 60, "a"), (4, 30, 5, "abcdef")])
@pytest.mark.parametrize("group", [None, 100])
def test_made_conversations(spark, seed, convs, turns, texts, group):
    rows = made(seed, convs, turns, texts)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(ct.prefix_trie(frame, group=group)) == brute.trie(rows, group, 6)


def test_long_conversations_in_sections_and_many_ends(spark, monkeypatch):
    monkeypatch.setattr(ct, "SECTION", 3)
    monkeypatch.setattr(ct, "PIECE_BITS", 2)
    rows = [(c, t, "u", f"t{t if c < 40 or t < 30 else c}") for c in range(45) for t in range(50)]
    rows += [(c, t, "u", f"t{t}") for c in range(1000, 1040) for t in range(7)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert rows_of(ct.prefix_trie(frame)) == brute.trie(rows, None, 6)


def test_odd_tables(spark):
    rows = [(None, 1, "u", "a"), (5, None, None, None), (5, 1, None, ""), (7, 3, "u", "a" * 300_000), (7, 3, "u", "a" * 300_000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", d1 string, section int")
    for group in (None, 100):
        assert rows_of(ct.prefix_trie(frame, group=group)) == brute.trie(rows, group, 6)
    assert rows_of(ct.prefix_trie(frame.where("false"), group=100)) == []
    # Nothing but conversations without turns: a root that is a leaf.
    lone = [(c, 0, "u", "x") for c in (1, 2, 3, 5, 8)]
    assert rows_of(ct.prefix_trie(spark.createDataFrame(lone, SCHEMA), group=100)) == brute.trie(lone, 100, 6)
