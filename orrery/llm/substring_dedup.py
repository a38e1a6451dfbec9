"""Removal of word sequences that occur earlier in the corpus, found through super-k-mers.

A window is ``window`` consecutive words. Its minimiser is the smallest hash among its runs of ``MER`` words;
consecutive windows with one minimiser form a super-k-mer, which travels as one packed string to the bucket of
its minimiser. Equal windows have equal minimisers, so a bucket sees all occurrences of its windows: sorting them by hash
brings equal ones together, and the words themselves decide.

What keeps buckets even: of equal super-k-mers a task sends the earliest only and notes the others as repeats
at once, so a passage in a third of all documents travels once per task. Minimisers that hold more than a small share of
all super-k-mers are found first (their list is bounded by that share); their windows travel one by one, to the
bucket of the window's own hash. No window is left out.

Results for odd inputs: a null text has no words; a text shorter than a window keeps all of them; rows with a
null id come last; repeated rows are one document and get equal results; rows that share an id but not a text
are told apart by a 64-bit checksum of the text, the smaller one first, and so are rows without an id; an empty table gives no rows; only id
and text are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.components import store
from orrery.llm.text import Words, chunks, find_words, join_words, mix, ngram_hashes, split_words

MER = 4
#: Windows in one super-k-mer at most; a longer run goes on in the next.
LONGEST = 32
#: Bytes of packed strings that a task gathers before it sends them.
GATHER = 32 << 20
LAST_ID = (1 << 63) - 1

PACKED = "bucket int, strings binary, repeats binary"
SPANS = "id long, tie long, start int, windows int"


def _window_minimisers(hashes: np.ndarray, window: int) -> np.ndarray:
    """The smallest hash of ``MER`` words within each window."""
    low = ngram_hashes(hashes, MER)
    wide, span = window - MER + 1, 1
    while 2 * span <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[: len(low) - (wide - span)], low[wide - span :]) if wide > span else low


def _super_kmers(
    words: Words, window: int, hot: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window and number of windows of each super-k-mer, and the hash that deals it out."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(words.start) < window:
        return none
    at = np.flatnonzero(words.row[: len(words.row) - window + 1] == words.row[window - 1 :])
    if not len(at):
        return none
    hashes = words.hashes()
    key = _window_minimisers(hashes, window)[at]
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) != 1) | (key[1:] != key[:-1])
    if len(hot):
        single = np.isin(key, hot)
        key = np.where(single, ngram_hashes(hashes, window)[at], key)
        begins |= single
    runs = np.flatnonzero(begins)
    place = np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))
    runs = np.flatnonzero(place % LONGEST == 0)
    return at[runs], np.diff(np.append(runs, len(at))), key[runs]


def _count_minimisers(window: int, share: float, least: int):
    """What a task holds more than ``share`` of: at most 1 / share rows per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                found = _super_kmers(find_words(part.column("text")), window, keys[:0])[2]
                both = np.concatenate([keys, found])
                weight = np.concatenate([times, np.ones(len(found), np.int64)])
                keys, where = np.unique(both, return_inverse=True)
                times = np.bincount(where, weight, minlength=len(keys)).astype(np.int64)
        total = int(times.sum())
        often = times >= max(least, share * total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(keys[often].view(np.int64), 0)),
                pa.array(np.append(times[often], total)),
                pa.array(np.append(np.zeros(int(often.sum()), bool), True)),
            ],
            names=["key", "times", "total"],
        )

    return count


def hot_minimisers(rows: DataFrame, window: int, buckets: int, least: int) -> np.ndarray:
    """Minimisers with more than half a bucket's even share of all super-k-mers; at most two per bucket."""
    share = 1 / (2 * buckets)
    counted = rows.select("text").mapInArrow(
        _count_minimisers(window, share, max(2, least // 16)), "key long, times long, total boolean"
    ).groupBy("key", "total").agg(F.sum("times").alias("times"))
    most = counted.orderBy(F.desc("total"), F.desc("times")).limit(2 * buckets + 1).collect()
    enough = max(least, share * most[0]["times"]) if most else 0
    hot = [r["key"] for r in most if not r["total"] and r["times"] >= enough]
    return np.sort(np.array(hot, np.int64).view(np.uint64))


class _Gathered:
    """Packed strings of a task by bucket; of equal ones the earliest, the others as repeats."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.first: dict[bytes, tuple[int, int, int, int, int]] = {}
        self.repeats: list[tuple[int, int, int, int]] = []
        self.bytes = 0

    def add(self, text: bytes, bucket: int, key: tuple[int, int, int], windows: int) -> None:
        known = self.first.get(text)
        if known is None:
            self.first[text] = (*key, windows, bucket)
            self.bytes += len(text)
        elif known[:3] > key:
            self.first[text] = (*key, windows, bucket)
            self._repeat(known[:3], windows)
        elif known[:3] < key:
            self._repeat(key, windows)

    def _repeat(self, key: tuple[int, int, int], windows: int) -> None:
        self.repeats.append((key[0], key[2], key[1], windows))

    def rows(self) -> pa.RecordBatch:
        """One row per bucket; the repeats travel along with one of them."""
        press = zstandard.ZstdCompressor(level=3)
        by: dict[int, list[tuple[tuple[int, int, int], bytes]]] = {}
        for text, (id_, start, tie, _, bucket) in self.first.items():
            by.setdefault(bucket, []).append(((id_, start, tie), text))
        strings, repeats = [], []
        for bucket, items in by.items():
            items.sort()
            ids = np.array([k[0] for k, _ in items], np.int64)
            strings.append(
                press.compress(
                    struct.pack("<q", len(items)) + np.diff(ids, prepend=0).tobytes()
                    + np.array([k[1] for k, _ in items], np.int32).tobytes()
                    + np.array([k[2] for k, _ in items], np.int64).tobytes()
                    + b"\n".join([t for _, t in items])
                )
            )
            repeats.append(b"")
        if by:
            repeats[len(self.first) % len(by)] = press.compress(np.array(self.repeats, np.int64).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(by), pa.int32()), pa.array(strings, pa.binary()), pa.array(repeats, pa.binary())],
            names=["bucket", "strings", "repeats"],
        )


def _pack(window: int, buckets: int, hot):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Gathered(buckets)
        for batch in batches:
            for part in chunks(batch, "text"):
                words = find_words(part.column("text"))
                at, count, key = _super_kmers(words, window, hot.value)
                text, begin, end = join_words(words)
                bucket = (mix(key ^ np.uint64(0x5BD1E995)) % np.uint64(buckets)).astype(np.int64)
                row = words.row[at]
                ids, ties = (part.column(c).to_numpy()[row] for c in ("id", "tie"))
                columns = (
                    begin[at], end[at + count + window - 2], bucket, ids, at - words.first[row], ties, count
                )
                for a, b, to, id_, start, tie, n in zip(*(c.tolist() for c in columns)):
                    gathered.add(text[a:b], to, (id_, start, tie), n)
                if gathered.bytes > GATHER:
                    yield gathered.rows()
                    gathered.clear()
        yield gathered.rows()

    return pack


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<q", raw)
    ids = np.cumsum(np.frombuffer(raw, np.int64, n, 8))
    starts = np.frombuffer(raw, np.int32, n, 8 + 8 * n)
    ties = np.frombuffer(raw, np.int64, n, 8 + 12 * n)
    return ids, starts, ties, raw[8 + 20 * n :].split(b"\n")


def _repeated(
    ids: np.ndarray, starts: np.ndarray, ties: np.ndarray, strings: list[bytes], window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans of windows that also start earlier, among the packed strings of one bucket."""
    sizes = np.array([len(s) for s in strings], np.int64)
    text = b"".join(strings)
    words = split_words(np.frombuffer(text, np.uint8), np.concatenate([[0], np.cumsum(sizes)]))
    at = np.flatnonzero(words.row[: len(words.row) - window + 1] == words.row[window - 1 :])
    row = words.row[at]
    start = starts[row] + at - words.first[row]
    hashes = ngram_hashes(words.hashes(), window)[at]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    shared = order[np.append(same, False) | np.append(False, same)]
    shared = shared[np.lexsort((ties[row[shared]], start[shared], ids[row[shared]], hashes[shared]))]
    repeated = np.zeros(len(at), bool)
    seen: dict[bytes, tuple[int, int, int]] = {}
    columns = (
        hashes[shared], words.start[at[shared]], words.end[at[shared] + window - 1], ids[row[shared]],
        start[shared], ties[row[shared]], shared,
    )
    last = None
    for h, a, b, id_, begin, tie, i in zip(*(c.tolist() for c in columns)):
        if h != last:
            seen.clear()
            last = h
        if seen.setdefault(text[a:b], (id_, begin, tie)) != (id_, begin, tie):
            repeated[i] = True
    hit = np.flatnonzero(repeated)
    begins = np.ones(len(hit), bool)
    begins[1:] = (np.diff(hit) != 1) | (np.diff(row[hit]) != 0)
    runs = np.flatnonzero(begins)
    return (
        ids[row[hit[runs]]], ties[row[hit[runs]]], start[hit[runs]], np.diff(np.append(runs, len(hit)))
    )


def _find(window: int):
    def find(table: pa.Table) -> pa.Table:
        parts = [_unpack(b) for b in table.column("strings").to_pylist()]
        found = _repeated(
            *(np.concatenate([p[k] for p in parts]) for k in range(3)), [s for p in parts for s in p[3]], window
        )
        sent = [
            np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.int64).reshape(-1, 4)
            for b in table.column("repeats").to_pylist() if b
        ]
        columns = [
            np.concatenate([own, *(s[:, k] for s in sent)]) for k, own in enumerate(found)
        ]
        return pa.table(
            [pa.array(c.astype(t)) for c, t in zip(columns, ("i8", "i8", "i4", "i4"))],
            names=["id", "tie", "start", "windows"],
        )

    return find


def _remove(window: int):
    """Texts without the words that a span covers."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = find_words(part.column("text"))
                first = words.first
                spans = part.column("spans")
                row = pc.list_parent_indices(spans).to_numpy(zero_copy_only=False)
                flat = pc.list_flatten(spans)
                start, count = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                change = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(change, np.minimum(first[row] + start, first[row + 1]), 1)
                np.add.at(change, np.minimum(first[row] + start + count + window - 1, first[row + 1]), -1)
                kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                text, begin, end = join_words(words, kept)
                left = np.searchsorted(words.row[kept], np.arange(words.rows + 1))
                texts = [
                    text[begin[a] : end[b - 1]] if a < b else b"" for a, b in zip(left.tolist(), left[1:].tolist())
                ]
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), pa.array(n.astype(np.int64)),
                        pa.array((n - np.diff(left)).astype(np.int64)),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=["id", "n_words", "n_removed", "kept_text"],
                )

    return remove


def dedup_substrings(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, window: int = 20, buckets: int | None = None,
    hot_least: int = 256,
) -> DataFrame:
    """Per row: id, words, words removed, and the kept words joined by one space.

    ``buckets`` (eight per shuffle partition) and ``hot_least`` (super-k-mers that a minimiser must have to be
    treated as hot) change where work is done, not the result.
    """
    spark = df.sparkSession
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(text).alias("text"))
    # Few ids as a rule; only their rows need a checksum.
    several = store(
        rows.where(F.col("id") != LAST_ID).groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1")
        .select(F.col("id").alias("_several")),
        "several",
    )
    shared = F.col("_several").isNotNull() | (F.col("id") == LAST_ID)
    rows = rows.join(several, F.col("id") == F.col("_several"), "left").select(
        "id", F.when(shared, F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("tie"), "text"
    )
    hot = spark.sparkContext.broadcast(hot_minimisers(rows, window, buckets, hot_least))
    packed = rows.mapInArrow(_pack(window, buckets, hot), PACKED)
    spans = (
        packed.groupBy("bucket").applyInArrow(_find(window), SPANS)
        .groupBy("id", "tie").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    )
    joined = rows.join(spans, ["id", "tie"], "left").select(
        F.nullif("id", F.lit(LAST_ID)).alias("id"), "text",
        F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,windows:int>>)")).alias("spans"),
    )
    return joined.mapInArrow(
        _remove(window), "id long, n_words long, n_removed long, kept_text string"
    ).withColumnRenamed("id", doc_id)
