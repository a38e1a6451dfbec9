"""Alignment of two tokenizers against plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from orrery.llm import token_alignment as ta
from orrery.llm.packing import tokenizer_path
from orrery.llm.queries import QUERIES, load
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b   c \n d"), (5, "a▁b"), (6, "naïve 漢字 🙂🙂 zażółć"), (7, "<s> <|endoftext|> </s>"),
    (8, "It's  the\tend\r\n\r\n "), (8, "word " * 3000), (None, "word " * 3000), (9, "x" * 5000), (10, "\x00 \x7f\u0085   ." * 9),
]


def plain(texts: list[str | None]) -> list[dict]:
    """Each document on its own with the tokenizers' own libraries, tokens compared one by one."""
    os_a, b = brute.byte_tokenizer(), brute.piece_tokenizer()
    documents, counts = [], Counter()
    for text in texts:
        raw = b" " + (text or "").encode()
        a_ids, a_bytes = os_a(" " + (text or ""))
        b_ids, b_bytes = b(text or "")
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            documents.append(([], [], [], []))
            continue
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        a_start, b_start = a_end - [len(x) for x in a_bytes], b_end - [len(x) for x in b_bytes]
        linked, j = [], 0
        for i in range(len(a_ids)):
            while b_end[j] <= a_start[i]:
                j += 1
            k = j
            while k < len(b_ids) and b_start[k] < a_end[i]:
                linked.append((a_ids[i], b_ids[k]))
                k += 1
        groups, i, j = [], 0, 0
        for cut in sorted(set(a_end.tolist()) & set(b_end.tolist())):
            m, n = np.searchsorted(a_end, cut) + 1, np.searchsorted(b_end, cut) + 1
            groups.append(f"{','.join(map(str, a_ids[i:m]))}|{','.join(map(str, b_ids[j:n]))}")
            i, j = m, n
        documents.append((a_ids, b_ids, groups, linked))
        counts.update(set(linked))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        {
            "n_a": len(a_ids), "n_b": len(b_ids), "n_groups": len(groups), "n_links": len(linked),
            "n_best": sum(counts[p] == best[p[0]] for p in linked), "count_sum": sum(counts[p] for p in linked),
            "groups": ";".join(groups),
        }
        for a_ids, b_ids, groups, linked in documents
    ]


def test_query_equals_plain_version(spark):
    docs = load(spark, SF_DIR, "documents").orderBy("doc_id").collect()
    wanted = plain([d["text"] for d in docs])
    got = {r["doc_id"]: r.asDict() for r in QUERIES["op12_token_alignment"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for d, w in zip(docs, wanted):
        groups = w.pop("groups")
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert got[d["doc_id"]] == {"doc_id": d["doc_id"], "groups_sha256": sha} | w


def odd_rows(rows) -> list[tuple]:
    return sorted(tuple(str(r[c]) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")) for r in rows)


@pytest.mark.parametrize("table_pairs", [ta.TABLE_PAIRS, 300])
def test_odd_texts_in_one_slice_or_many(spark, table_pairs):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in ODD], "doc_id long, text string, pairs int, id string")
    got = ta.align_tokenizers(frame, table_pairs=table_pairs).collect()
    wanted = [{"doc_id": i} | w for (i, _), w in zip(ODD, plain([t for _, t in ODD]))]
    assert odd_rows(got) == odd_rows(wanted)
    by_text = {t: w for (_, t), w in zip(ODD, wanted)}
    assert by_text["a▁b"]["n_a"] == by_text[""]["n_a"] == 0 and by_text[None]["groups"] == ""


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.align_tokenizers(empty).collect() == []


def test_long_texts_are_cut_only_where_tokens_end(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["ab", " ", "  ", "\n", ". ", "né ", "xyzzy ", "7", "' s"]) for _ in range(400)) for _ in range(60)]
    a, b = ta.ByteLevel(tokenizer_path("byte_bpe_50k.json")), ta.Pieces(tokenizer_path("piece_bpe_32k.model"))
    whole = [[x.tolist() for x in t.encode(texts)] for t in (a, b)]
    monkeypatch.setattr(ta, "PART", 20)
    assert max(len(ta.parts(t)) for t in texts) > 10
    assert [[x.tolist() for x in t.encode(texts)] for t in (a, b)] == whole


@pytest.mark.parametrize("lane", [3, 512])
def test_runs_are_skipped_alike_at_any_lane(monkeypatch, lane):
    monkeypatch.setattr(ta, "LANE", lane)
    rng = random.Random(lane)
    for _ in range(200):
        sizes = [rng.choice([1, 2, 30, 700]) for _ in range(rng.randrange(1, 6))]
        stops = np.cumsum(sizes)
        cut = lambda p: np.union1d(np.array([x for x in range(1, stops[-1]) if rng.random() < p], np.int64), stops)
        a, b = cut(rng.choice([0.1, 0.6, 0.95])), cut(rng.choice([0.1, 0.6, 0.95]))
        if rng.random() < 0.3:
            b = a.copy()
        last_a, last_b = ta.align(a, b, stops - sizes)
        common = np.intersect1d(a, b)
        assert a[last_a].tolist() == b[last_b].tolist() == common.tolist()
        of_a, of_b = ta.links(a, b)
        assert list(zip(of_a, of_b)) == [
            (i, j) for i in range(len(a)) for j in range(len(b))
            if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])
        ] if stops[-1] < 100 else True
