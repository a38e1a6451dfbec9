"""Document fingerprints: Merkle trees over paragraphs and sections.

A leaf is a paragraph: a line, cut at the ends of its sentences and after words whose hash says so, one in ``WORDS``; a very
long word is cut where the hash of its last bytes says so. A section closes
after a leaf whose digest says so. So an edit moves the borders around it only, whatever the text. A section's digest covers
its leaves' digests, the root covers the sections'. The written form is the root, then each section's
digest with its leaves' digests, shortened.

Equal roots mean equal texts. Otherwise sections that both trees hold are equal without a look at their leaves,
and the leaves of the other sections are matched; likeness is the share of leaves (of both texts) that match.

Results for odd inputs: a null text is an empty one, whose tree has no leaf; two empty texts are alike (1), an empty and another
are not (0); rows follow each other by id, nulls first, then by a hash of their text, so that repeated rows are each other's
next document; a single row is its own next; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.text import mix, split_words

#: A leaf ends after one word in so many.
WORDS = 4
#: Within a word longer than ``LONG`` bytes it ends after one of ``BYTES`` bytes, by the last ``WINDOW`` of them.
LONG, BYTES, WINDOW = 64, 24, 8
#: A section closes after one leaf in so many.
SECTION = 8
#: Bytes of a leaf's digest that the written form keeps: two different leaves look alike once in 2^32 pairs.
KEPT = 4

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def leaf_ends(data: np.ndarray) -> np.ndarray:
    """Where the leaves of a text's bytes end: after a run of sentence ends, after chosen words and within long words."""
    if not len(data):
        return np.zeros(0, np.int64)
    words = split_words(data, np.array([0, len(data)]))
    ends = _ENDS[data]
    ends[:-1] &= ~ends[1:]
    chosen = words.hashes() % np.uint64(WORDS) == 0
    # The words' ends are places between bytes.
    ends[words.end[chosen] - 1] = True
    for start, end in zip(*(x[words.end - words.start > LONG].tolist() for x in (words.start, words.end))):
        wide = data[start:end].astype(np.uint64)
        window = sum(wide[WINDOW - 1 - k : len(wide) - k] << np.uint64(8 * k) for k in range(WINDOW))
        # A character is never cut.
        whole = np.append(data[start + WINDOW : end] & 0xC0 != 0x80, True)
        ends[start + WINDOW - 1 + np.flatnonzero((mix(window) % np.uint64(BYTES) == 0) & whole)] = True
    ends[-1] = True
    return np.flatnonzero(ends) + 1


def fingerprint(text: str) -> str:
    """root:section=leaf,leaf;section=leaf..."""
    sections: list[str] = []
    root = hashlib.blake2b(digest_size=16)
    leaves: list[bytes] = []
    raw = text.encode("utf-8", "surrogatepass")
    begin, ends = 0, leaf_ends(np.frombuffer(raw, np.uint8)).tolist()
    for end in ends:
        leaves.append(hashlib.blake2b(raw[begin:end], digest_size=8).digest())
        begin = end
        if leaves[-1][7] % SECTION == 0 or end == len(raw):
            digest = hashlib.blake2b(b"".join(leaves), digest_size=16)
            root.update(digest.digest())
            sections.append(digest.hexdigest()[:12] + "=" + ",".join([d[:KEPT].hex() for d in leaves]))
            leaves = []
    return root.hexdigest() + ":" + ";".join(sections)


def likeness(a: str, b: str) -> float:
    """From 0 to 1: twice the leaves that match, by the leaves of both."""
    (root_a, _, tree_a), (root_b, _, tree_b) = a.partition(":"), b.partition(":")
    if root_a == root_b:
        return 1.0
    ours, theirs = Counter(tree_a.split(";")), Counter(tree_b.split(";"))
    # A section has one leaf more than it has commas.
    size = tree_a.count(",") + tree_b.count(",") + tree_a.count("=") + tree_b.count("=")
    same = ours & theirs
    match = sum((s.count(",") + 1) * n for s, n in same.items() if s)
    match += sum((_leaves(ours - same) & _leaves(theirs - same)).values())
    return 2 * match / size if size else 1.0


def _leaves(sections: Counter[str]) -> Counter[str]:
    tally: Counter[str] = Counter()
    for section, times in sections.items():
        for leaf in section.partition("=")[2].split(","):
            if leaf:
                tally[leaf] += times
    return tally


def differing(a: str, b: str) -> list[int]:
    """The sections of ``a`` that ``b`` does not hold: where the texts differ."""
    others = set(b.partition(":")[2].split(";"))
    return [i for i, s in enumerate(a.partition(":")[2].split(";")) if s and s not in others]


def edit(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the start of the one that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row against the row after it; rows marked as copies only follow."""
    last: tuple[int | None, str, str, bool] | None = None
    for batch in batches:
        out = []
        for doc_id, text, copied in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "copied"))):
            print_ = fingerprint(text)
            if last is not None and not last[3]:
                edited = edit(last[1], text)
                of_edited = fingerprint(edited)
                out.append(
                    (
                        last[0], len(last[1]),
                        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), last[2],
                        of_edited, likeness(last[2], of_edited), likeness(last[2], print_),
                    )
                )
            last = (doc_id, text, print_, copied)
        schema = pa.schema(
            [
                ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                ("near_edited", pa.float64()), ("near_next", pa.float64()),
            ]
        )
        columns = list(zip(*out)) if out else [[] for _ in schema]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def compare_with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and the likeness to that and to the next document.

    Texts are shuffled once, into ranges of ids. Only the first row of each range is copied, to the range
    before, so that each range is compared on its own in one pass.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    borders = rows.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0] if shares else []
    cuts = np.unique(np.array(borders or [], np.int64))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        part = np.zeros(len(ids), np.int32)
        part[known] = np.searchsorted(cuts, ids[known].astype("int64").to_numpy(), side="right")
        return pd.Series(part)

    dealt = rows.withColumn("part", part_of("doc_id"))
    # One row per range: at most as many as there are partitions.
    firsts = sorted(
        dealt.groupBy("part").agg(F.min(F.struct("doc_id", "tie")).alias("first")).collect(),
        key=lambda r: r["part"],
    )
    if not firsts:
        return spark.createDataFrame([], RESULT)
    before = [firsts[i - 1]["part"] for i in range(len(firsts))]
    heads = spark.createDataFrame(
        [(r["first"]["doc_id"], r["first"]["tie"], p) for r, p in zip(firsts, before)],
        "head_id long, head_tie long, to_part int",
    )
    copies = rows.join(
        F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    ).select("doc_id", "text", "tie", F.col("to_part").alias("part"), F.lit(True).alias("copied"))
    return (
        dealt.withColumn("copied", F.lit(False)).unionByName(copies)
        .repartitionById(parts, "part")
        .sortWithinPartitions("copied", F.asc_nulls_first("doc_id"), "tie")
        .select("doc_id", "text", "copied")
        .mapInArrow(_compare, RESULT)
    )
